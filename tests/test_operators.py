"""Operators on small fixtures, hot keys included."""

import math
import random
import struct
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinionlake import fixed, schemas
from opinionlake.operators import aspects as A
from opinionlake.operators import conform as C
from opinionlake.operators import dedup as U
from opinionlake.operators import distribution as D
from opinionlake.operators import outliers as O
from opinionlake.operators import quality as Q
from opinionlake.operators import tokens as K
from opinionlake.operators.language import detect_language
from opinionlake.operators.quantiles import quantiles, with_ordered_bits


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- conform ----------------------------------------------------------------
def test_conform_casts_orders_and_fills(spark):
    df = spark.createDataFrame([("u", "x1", "2.5")], "url string, score string, num_comments string")
    out = C.conform(df, schemas.SILVER_POST)
    assert out.columns == schemas.SILVER_POST.names
    row = out.first()
    assert (row.url, row.score, row.num_comments, row.author) == ("u", None, 2.5, None)


def test_filter_counts(spark):
    kept, seen = C.filter_counts(spark.range(10).withColumn("x", F.when(F.col("id") < 8, F.col("id"))), F.col("x") > 4)
    assert kept.count() == 3
    assert seen.get == {"kept": 3, "skipped": 7}


def test_language(spark):
    rows = [("the cat of the house",), ("el gato de la casa y los perros",), ("der Hund und die Katze",), ("xyz",), ("",), (None,)]
    got = [r.l for r in spark.createDataFrame(rows, "t string").coalesce(1).select(detect_language(F.col("t")).alias("l")).collect()]
    assert got == ["en", "es", "de", "unknown", "unknown", "unknown"]
    tagged = spark.createDataFrame([("en",), (" ",), (None,), ("es",)], "lang string")
    assert C.keep_language(tagged, "lang").count() == 1
    assert C.keep_language(tagged, "lang", "unknown").count() == 2


# --- duplicates -------------------------------------------------------------
def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("x", 3)], "url string, n int")
    row = U.duplicate_rate(df, "url").first()
    assert (row.total, row.duplicates) == (3, 1)
    assert C.drop_null_keys(U.dedup_first(df, "url", ["n"])).count() == 1


def test_dedup_with_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id").repartition(8)
    first = U.dedup_first(df, "k", ["id"])
    assert plan(first).count("WindowGroupLimit") == 2  # before and after the exchange
    rows = {r.k: r.id for r in first.collect()}
    assert len(rows) == 1 + sum(i % 3 != 0 for i in range(20_000)) and rows[0] == 0
    assert U.dedup_first(first, "k", ["id"]).count() == len(rows)


def test_insert_ignore(spark):
    existing = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    batch = spark.createDataFrame([("b", 1), ("c", 2), ("c", 3), (None, 4)], "k string, n int")
    assert [tuple(r) for r in U.insert_ignore(existing, batch, "k", ["n"]).collect()] == [("c", 2)]
    assert U.insert_counts(existing, batch, "k", ["n"]).first().asDict() == {"processed": 4, "inserted": 1, "skipped": 3}


# --- quantiles and outliers -------------------------------------------------
@pytest.mark.parametrize("kind", ["normal", "heavy", "ties", "close", "bits"])
def test_quantiles_equal_numpy(spark, kind):
    """Values far apart, repeated, and so close that all 64 bits are needed; one group has 90 % of the rows."""
    rng = random.Random(3)
    make = {"normal": lambda: rng.gauss(0, 1), "heavy": lambda: rng.paretovariate(0.5), "ties": lambda: float(rng.randint(0, 5)),
            "close": lambda: 1.0 + rng.randint(-9, 9) * 2.0 ** -53, "bits": lambda: rng.choice([-1, 1]) * 2.0 ** rng.randint(-1074, 1023)}[kind]
    data = [(("hot" if i % 10 else f"g{i % 70}"), make() if i % 11 else None) for i in range(6000)] + [(None, 1.5), (None, 2.5), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(8)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r.g: r for r in quantiles(df, "v", probs, ["g"]).collect()}
    assert set(got) == {g for g, _ in data} - {"none"}
    for group in got:
        values = sorted(v for g, v in data if g == group and v is not None)
        assert got[group].n == len(values)
        # numpy interpolates in another order of operations
        at = [p * (len(values) - 1) for p in probs]
        want = [values[math.floor(x)] + (values[math.ceil(x)] - values[math.floor(x)]) * (x - math.floor(x)) for x in at]
        assert got[group].q == want
        assert got[group].q == pytest.approx(list(np.quantile(values, probs)), rel=1e-9, abs=1e-12)


def test_ordered_bits_are_those_of_the_double(spark):
    rng = random.Random(4)
    values = [struct.unpack("<d", rng.getrandbits(64).to_bytes(8, "little"))[0] for _ in range(3000)]
    values += [s * math.ldexp(1.0, e) * m for e in range(-1074, 1024, 7) for s in (1, -1) for m in (1.0, 1.0 - 2.0 ** -53, 1.0 + 2.0 ** -52)]
    values = [v for v in values if v == v] + [0.0, math.inf, -math.inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in with_ordered_bits(df, "v", "b").collect():
        bits = struct.unpack("<Q", struct.pack("<d", row.v))[0]
        assert row.b % (1 << 64) == (bits ^ (1 << 64) - 1 if bits >> 63 else bits | 1 << 63), row.v


def test_infinite_and_undefined_values(spark):
    df = spark.createDataFrame([(v,) for v in (math.nan, math.inf, -math.inf, 0.0, -0.0, 3.0, math.inf)], "v double")
    q = quantiles(df, "v", [0.0, 1 / 6, 0.5, 2 / 3, 1.0]).first().q
    assert q[:4] == [-math.inf, 0.0, 3.0, math.inf] and math.isnan(q[4])


def test_a_large_group_sends_counts_only(spark):
    """Rows of one group go to as many tasks as there are salts, and each round shuffles counts, not rows."""
    df = spark.range(200_000).select(F.lit("hot").alias("g"), F.xxhash64("id").cast("double").alias("v"))
    row = quantiles(df, "v", [0.5], ["g"]).first()
    values = sorted(r.v for r in df.collect())
    assert row.q == [values[99_999] + (values[100_000] - values[99_999]) * 0.5]


def test_quantiles_edges(spark):
    assert quantiles(spark.createDataFrame([(None,)], "v double"), "v", [0.5]).count() == 0
    assert quantiles(spark.createDataFrame([(4.0,)], "v double"), "v", [0.25, 0.75]).first().q == [4.0, 4.0]


@pytest.mark.parametrize("values, bounds, n", [
    ([2] * 14 + [3] * 5 + [1], None, None),
    ([2] * 15 + [1, 1, 3, 4, 9], (2.0, 2.0), 5),
])
def test_zero_iqr_flags_every_other_value(spark, values, bounds, n):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    row = O.iqr_outliers(df, "v").first()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert (row.lower, row.upper) == (low, high) and row.n_outliers == sum(v < low or v > high for v in values)
    if bounds:
        assert (row.lower, row.upper, row.n_outliers) == (*bounds, n)


def test_cap_keeps_nulls_and_bounds(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(20)] + [("a", 1000.0), ("a", None), ("b", 5.0)], "f string, v double")
    out = O.cap_outliers(df, ["v"], ["f"])
    assert out.count() == 23 and out.filter("v is null").count() == 1
    q1, q3 = np.quantile([*range(20), 1000], [0.25, 0.75])
    assert out.agg(F.max("v")).first()[0] == q3 + 1.5 * (q3 - q1)


def test_impute_with_a_fractional_median(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 3.0), ("a", None), ("b", None)], "f string, v double")
    assert sorted((r.f, r.v) for r in O.impute_median(df, "v", ["f"]).collect() if r.v is not None) == [
        ("a", 2.0), ("a", 2.5), ("a", 3.0)]


# --- tokens -----------------------------------------------------------------
def test_token_rules(spark):
    text = "the team won 3 goals abc123 étoile went ab las injuries clásico"
    df = spark.createDataFrame([("u", text, ""), ("v", None, None), ("w", "", "won")], "url string, body_text_clean string, title_clean string")
    got = {r.url: r for r in K.with_tokens(df).collect()}
    assert got["u"].text_processed == "win étoile injury clásico" and got["u"].token_count == 4
    assert (got["v"].text_processed, got["v"].token_count, got["w"].title_processed) == ("", 0, "win")
    table = spark.createDataFrame([("étoile", "star")], "form string, lemma string")
    small = K.with_tokens(df, lemma_table=table).filter("url = 'u'").first().text_processed
    joined = K._with_joined_lemmas(df, "body_text_clean", "title_clean", table, "url").filter("url = 'u'").first().text_processed
    assert small == joined == "won star went injuries clásico"


def test_bigrams_stay_inside_a_record(spark):
    df = spark.createDataFrame([("a b c",), ("d",), ("",), ("c d",)], "t string")
    got = {r.bigram: r.frequency for r in K.top_bigrams(df, "t").collect()}
    assert got == {"a b": 1, "b c": 1, "c d": 1}


def test_top_terms_break_ties_by_name(spark):
    df = spark.createDataFrame([("b a b a c",)], "t string")
    assert [r.keyword for r in K.top_tokens(df, "t", 2).collect()] == ["a", "b"]


# --- aspects ----------------------------------------------------------------
def test_aspects_words_phrases_and_shared_keywords(spark):
    aspects = {"one": ("barça", "real madrid"), "two": ("madrid",), "three": ("barça", "c.f.")}
    rows = [("BARÇA wins", None), ("barçaé", "Real  Madrid"), ("the real madrid way", "x"), (None, None), ("a c.f.x", "")]
    df = spark.createDataFrame(rows, "body_text string, title string").coalesce(1)
    got = [sorted(r.a) for r in df.select(A.aspects_of([F.col("body_text"), F.col("title")], aspects).alias("a")).collect()]
    assert got == [["one", "three"], ["two"], ["one", "two"], [], ["three"]]


def test_cowords_filter_after_the_pool(spark):
    words = [f"w{chr(97 + i)}x" for i in range(26)]
    text = " ".join(w for i, w in enumerate(words) for _ in range(40 - i))
    df = spark.createDataFrame([("key", "positive", text)], "aspect string, sentiment_label string, text_processed string")
    blocked = words[:20]
    got = [r.word for r in A.aspect_cowords(df, {"key": ("kw",)}, pool=25, blocklist=blocked).orderBy(F.desc("frequency")).collect()]
    assert got == words[20:25]  # the 26th word is outside the pool although only five are left
    assert A.aspect_cowords(df, {"key": ("kw",)}, blocklist=blocked).count() == 6


def test_summary_adds_up_and_std_of_one_is_null(spark):
    rows = [("a", "s1", 0.5, "positive"), ("a", "s1", -0.5, "negative"), ("a", "s2", 0.1, "positive"), ("b", None, 0.0, "neutral")]
    df = spark.createDataFrame(rows, "aspect string, source string, vader_compound double, sentiment_label string")
    got = {(r.aspect, r.source): r for r in A.aspect_summary(df).collect()}
    assert got["a", "all"].n_mentions == got["a", "s1"].n_mentions + got["a", "s2"].n_mentions
    assert got["a", "s2"].compound_std is None and got["a", "s1"].sentiment_mode == "negative"
    assert ("b", None) in got and ("b", "all") in got


def test_snippets_fall_back_to_the_title(spark):
    rows = [("a", f"u{i}", "" if i == 0 else "body " * 100, "title", float(i), "neutral", "s") for i in range(5)]
    df = spark.createDataFrame(rows, "aspect string, url string, body_text string, title string, vader_compound double, sentiment_label string, source string")
    got = A.aspect_snippets(df).collect()
    low = [r for r in got if r.sentiment_pole == "negative"]
    assert [r.vader_compound for r in sorted(low, key=lambda r: r["rank"])] == [0.0, 1.0, 2.0]
    assert {r.text_snippet for r in low if r.vader_compound == 0.0} == {"title"} and max(len(r.text_snippet) for r in got) <= 300


def test_hot_aspect_is_ranked_with_a_partial_limit(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4900, "a").otherwise("b").alias("aspect"), F.col("id").cast("string").alias("url"), F.lit("t").alias("body_text"),
                                  F.lit("t").alias("title"), (F.col("id") / 5000).alias("vader_compound"),
                                  F.lit("neutral").alias("sentiment_label"), F.lit("s").alias("source")).repartition(4)
    assert plan(A.aspect_snippets(df)).count("WindowGroupLimit") == 4


# --- distributions ----------------------------------------------------------
def test_shares(spark):
    rows = [("w1", "positive")] * 3 + [("w1", "negative")] + [("w2", "neutral")]
    df = spark.createDataFrame(rows, "week string, sentiment_label string")
    whole = {(r.week, r.sentiment_label): r.pct for r in D.label_distribution(df, ["week"]).collect()}
    week = {(r.week, r.sentiment_label): r.pct for r in D.label_distribution(df, ["week"], share_within=["week"]).collect()}
    assert whole == {("w1", "positive"): 60.0, ("w1", "negative"): 20.0, ("w2", "neutral"): 20.0}
    assert week == {("w1", "positive"): 75.0, ("w1", "negative"): 25.0, ("w2", "neutral"): 100.0}


def test_volume_fills_observed_periods_only(spark):
    rows = [("2026-01-01", "a"), ("2026-01-03", "b"), (None, "a")]
    df = spark.createDataFrame(rows, "d string, s string").withColumn("ts", F.col("d").cast("timestamp"))
    got = {(r.period, r.source): r.n_records for r in D.volume_by_period(df, "ts", "s", "day", ["a", "b", "c"]).collect()}
    assert got["2026-01-01", "b"] == 0 and got["2026-01-03", "all"] == 1 and got["2026-01-01", "c"] == 0 and len(got) == 8
    assert "CartesianProduct" not in plan(D.volume_by_period(df, "ts", "s", "day"))


def test_trend_delta_needs_two_periods(spark):
    df = spark.createDataFrame([("2026-01-05", "scraping", 0.5)], "d string, source string, v double").withColumn("ts", F.col("d").cast("timestamp"))
    row = D.trend_delta(df, "ts", "v").first()
    assert (row.n_periods, row.delta, row.direction) == (1, None, None)


# --- quality ----------------------------------------------------------------
def test_empty_tables_give_null_rates(spark):
    empty = spark.createDataFrame([], schemas.GOLD_INPUT)
    assert Q.null_rates(empty, ["url"]).first()[0] is None
    assert Q.schema_compliance(empty).first()[0] is None
    assert Q.time_coverage(empty).first().avg_records_per_week is None
    assert Q.schema_compliance(empty.drop("url")).first()[0] is None
    assert Q.histogram(empty, "body_text").count() in (0, 40)


def test_histogram_equals_numpy(spark):
    lengths = [int(x) for x in np.random.default_rng(1).exponential(300, 2000)]
    df = spark.createDataFrame([("x" * n,) for n in lengths], "t string")
    clipped = np.minimum(lengths, np.quantile(lengths, 0.99))
    want = np.histogram(clipped, bins=40)[0]
    assert [r.n for r in Q.histogram(df, "t").orderBy("bin").collect()] == list(want)


def test_top_tokens_equal_counter(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randint(0, 30))) for _ in range(200)]
    counts = Counter(w for t in texts for w in t.split())
    want = sorted(counts.items(), key=lambda p: (-p[1], p[0]))[:5]
    got = K.top_tokens(spark.createDataFrame([(t,) for t in texts], "t string"), "t", 5).collect()
    assert [(r.keyword, r.frequency) for r in got] == want
    assert fixed.LABELS == ("positive", "neutral", "negative")
