"""Language profiles, ending rules and joined word tables."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from opinionlake import fixed
from opinionlake.operators import tokens as K
from opinionlake.operators.distribution import volume_by_period
from opinionlake.operators.language import detect_by_ngrams, detect_language, learn_profiles
from opinionlake.operators.sentiment import starter_rules, with_joined_sentiment, with_sentiment

SF = "/root/testdata/sf0.01"


def test_profiles_know_short_texts_that_they_were_not_learned_from(spark):
    """Accuracy on held-out documents, on texts of twelve words; function words alone miss many of those."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("text IS NOT NULL AND text rlike '\\\\p{L}{3}'")
    learned, held = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    profiles = learn_profiles(learned, most=100)
    short = F.array_join(F.slice(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " "), 1, 12), " ")
    scored = held.select("lang", detect_by_ngrams(short, profiles).alias("by_ngrams"), detect_language(short).alias("by_words"))
    row = scored.agg(F.avg((F.col("lang") == F.col("by_ngrams")).cast("double")).alias("ngrams"),
                     F.avg((F.col("lang") == F.col("by_words")).cast("double")).alias("words")).first()
    print(f"accuracy of profiles {row.ngrams:.3f}, of function words {row.words:.3f}")
    assert row.ngrams >= 0.9 and row.ngrams > row.words


def test_profiles_of_odd_texts(spark):
    labelled = spark.createDataFrame([(1, "the cat", "en"), (2, "le chat noir", "fr"), (3, None, "fr"), (4, "x", None), (5, "12", "en")],
                                     "doc_id long, text string, lang string")
    profiles = learn_profiles(labelled)
    assert set(profiles.weights) == {"en", "fr"} and all(len(w) == 4096 for w in profiles.weights.values())
    texts = spark.createDataFrame([(t,) for t in (None, "", "123 !", "the", "Chat NOIR", "\U0001f600é")], "t string")
    assert [r[0] for r in texts.select(detect_by_ngrams(F.col("t"), profiles)).collect()][:5] == ["unknown", "unknown", "unknown", "en", "fr"]


def test_a_sample_is_bounded(spark):
    labelled = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"), F.lit("en").alias("lang"))
    few, all_ = learn_profiles(labelled, most=10).weights["en"], learn_profiles(labelled, most=1000).weights["en"]
    assert few != all_ and max(few) < max(all_)


LEMMAS = {"walked": "walk", "talked": "talk", "jumped": "jump", "cities": "city", "parties": "party", "stories": "story",
          "cats": "cat", "dogs": "dog", "cars": "car", "went": "go", "bus": "bus"}


def lemma(word):
    """The word by the longest ending on whose edit at least three forms, and half of those with it, agree."""
    edits = {}
    for form, base in LEMMAS.items():
        same = next((i for i, (a, b) in enumerate(zip(form, base)) if a != b), min(len(form), len(base)))
        for n in range(max(len(form) - same, 1), min(len(form) - 1, 5) + 1):
            edits.setdefault(form[-n:], []).append((len(form) - same, base[same:]))
    for n in range(5, 0, -1):
        votes = edits.get(word[-n:], []) if len(word) > n else []
        if votes:
            cut, add = max(sorted(set(votes)), key=votes.count)
            if votes.count((cut, add)) >= 3 and 2 * votes.count((cut, add)) >= len(votes):
                return word[:len(word) - cut] + add if len(word) - cut >= 3 else word
    return word


@pytest.mark.parametrize("joined", [False, True])
def test_endings_are_applied_to_unknown_forms_only(spark, joined):
    table = spark.createDataFrame(list(LEMMAS.items()), "form string, lemma string")
    endings = K.ending_rules(table)
    assert endings["ies"] == "3y" and endings["ed"] == "2"
    words = ["went", "cities", "bus", "hopped", "berries", "trucks", "red", "ties", "unknown", "puppies"]
    docs = spark.createDataFrame([("u", " ".join(words), "")], "url string, body_text_clean string, title_clean string")
    out = K.with_tokens(docs, lemma_table=table, join_lemmas=joined, base_stop=(), lemma_stop=(), min_len=1, endings=endings).first()
    assert out.text_processed.split() == [LEMMAS.get(w, lemma(w)) for w in words]
    without = K.with_tokens(docs, lemma_table=table, join_lemmas=joined, base_stop=(), lemma_stop=(), min_len=1).first()
    assert without.text_processed.split() == [LEMMAS.get(w, w) for w in words]


def test_no_table_gives_no_rule(spark):
    assert K.ending_rules(spark.createDataFrame([], "form string, lemma string")) == {}
    assert K.ending_rules(spark.createDataFrame([("", "a"), ("b", "b"), (None, "c")], "form string, lemma string")) == {}


def test_a_joined_lexicon_scores_like_a_literal_one(spark):
    rules = starter_rules()
    words = [*list(rules.lexicon)[:12], "not", "very", "GREAT", "but", "xyz", "least", "no", "good!", "(bad)"]
    texts = [" ".join(words[(i * 7 + j * j) % len(words)] for j in range(i % 15)) for i in range(120)]
    rows = [(None if i % 50 == 49 else f"u{i // 2}", text, "a title" if i % 3 else None, "scraping" if i % 2 else "reddit")
            for i, text in enumerate([*texts, "p one good\n\nbad two", "", None])]
    df = spark.createDataFrame(rows, "url string, body_text string, title string, source string").repartition(3)
    lexicon = spark.createDataFrame([*rules.lexicon.items(), ("unused", 1.0), (None, 2.0)], "word string, value double")
    shown = ["url", "body_text", "vader_compound", "vader_pos", "vader_neg", "vader_neu", "sentiment_label"]
    literal = sorted(map(str, with_sentiment(df, rules).select(*shown).collect()))
    joined = sorted(map(str, with_joined_sentiment(df, lexicon, replace(rules, lexicon={})).select(*shown).collect()))
    assert joined == literal and len({row.split("vader_compound")[1] for row in literal}) > 10


def test_zero_fill_of_many_groups(spark):
    rows = spark.range(100_000).select(F.concat(F.lit("g"), "id").alias("s"), F.timestamp_seconds(F.col("id") % 3 * 86_400).alias("ts"))
    out = volume_by_period(rows, "ts", "s", "day")
    totals = {r.n_records: r.n for r in out.filter("source <> 'all'").groupBy("n_records").agg(F.count("*").alias("n")).collect()}
    assert totals == {0: 200_000, 1: 100_000} and out.filter("source = 'all'").agg(F.sum("n_records")).first()[0] == 100_000
