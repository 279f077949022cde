"""Column functions against hand-made rows and plain Python."""

import html
import re
import string
import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opinionlake import fixed
from opinionlake.functions import numbers as N
from opinionlake.functions import text as X
from opinionlake.functions import timeparts as TP
from opinionlake.functions.lookup import lookup, member
from opinionlake.plans.governance import format_value, humanize_metric


def one(spark, values, column, schema="x string"):
    rows = spark.createDataFrame([(v,) for v in values], schema).coalesce(1).select(column.alias("y")).collect()
    return [r.y for r in rows]


def python_clean(text, social):
    if text is None or not text.strip():
        return ""
    text = html.unescape(unicodedata.normalize("NFKC", text))
    text = re.sub(r"<[^>]+>", " ", text).lower()
    text = re.sub(r"http\S+|www\S+", "", text)
    if social:
        for pattern in (r"#\w+", r"u/\w+", r"r/\w+"):
            text = re.sub(pattern, "", text)
    text = text.translate(str.maketrans("", "", string.punctuation + fixed.TYPOGRAPHIC_MARKS))
    return re.sub(r"\s+", " ", text).strip()


TEXTS = [
    "&lt;b&gt;Hi&lt;/b&gt; &amp; bye", "don't", "don’t", "see http://x.y #fútbol u/ann r/sub ok", "you/me her/their",
    None, "  ", "", "Ｆｕｌｌ ﬁne №", "a b\tc\n\nd", "“quoted” – dash—end", "<p class='x'>A<br>B</p>", "www.site.com/a b",
    "no change here", "CLÁSICO Barça", "u#abc/x y", "&nbsp;&copy; 2024", "1 < 2 and 3 > 2",
]


@pytest.mark.parametrize("social", [False, True])
def test_clean_text_equals_python(spark, social):
    assert one(spark, TEXTS, X.clean_text(F.col("x"), social)) == [python_clean(t, social) for t in TEXTS]


def test_anchored_social(spark):
    assert one(spark, ["you/me see u/ann"], X.drop_social(F.col("x"), anchored=True)) == ["you/me see "]


def test_body_from_paragraphs(spark):
    short, exact, noisy = "a" * 79, "b" * 80, "Leave a Reply " + "c" * 80
    rows = [[short, exact, noisy], [short], [], None, ["&lt;i&gt;" + "d" * 80, None]]
    got = one(spark, rows, X.body_from_paragraphs(F.col("x")), "x array<string>")
    assert got == [exact, None, None, None, "d" * 80]


def test_first_int_and_meta(spark):
    assert one(spark, ["3 minutes", "n/a", None], X.first_int(F.col("x"))) == [3, None, None]
    maps = ["{'author': 'Ann', 'k': \"it's\"}", "{'author': None, 'k': 'v'}", "not a map", None]
    assert one(spark, maps, X.meta_get(X.meta_from_text(F.col("x")), "author")) == ["Ann", None, None, None]
    assert one(spark, maps, X.meta_get(X.meta_from_text(F.col("x")), "k")) == ["it's", "v", None, None]


def test_word_match_is_unicode_aware(spark):
    texts = ["la barça gana", "CLÁSICO", "barçaé", "barça-x", None]
    assert one(spark, texts, X.any_word(F.col("x"), fixed.ASPECTS["barcelona"])) == [True, False, False, True, None]
    assert one(spark, texts, X.any_word(F.col("x"), fixed.ASPECTS["clasico"])) == [False, True, False, False, None]


def test_spanish_hint_bounds(spark):
    from opinionlake.operators.language import looks_spanish

    three = "x" * 40 + " el la los"
    four = "x" * 40 + " el a la b los c que d"
    short = "el a la b los c que d de"
    assert one(spark, [three, four, short, None], looks_spanish(F.col("x"))) == [
        sum((" " + three + " ").count(h) for h in fixed.SPANISH_HINTS) >= 4, True, False, False]


def test_time_parts(spark):
    stamps = [datetime(2026, 5, 24, 21), datetime(2026, 5, 18), None]
    assert one(spark, stamps, TP.week_label(F.col("x"), fixed.UNDATED), "x timestamp") == [
        "2026-05-18/2026-05-24", "2026-05-18/2026-05-24", "NaT"]
    assert one(spark, stamps, TP.week_label(F.col("x")), "x timestamp")[2] is None
    texts = ["5/3/2026", "2026-03-05T10:00:00Z", "5 March 2026", "soon", None]
    day = F.date_format(TP.coalesce_ts(F.lit(None).cast("string"), F.col("x")), "yyyy-MM-dd")
    assert one(spark, texts, day) == ["2026-03-05", "2026-03-05", "2026-03-05", None, None]
    assert one(spark, ["1779664688.0", "bad", None], F.year(TP.ts_from_epoch(F.col("x")))) == [2026, None, None]


def test_bands(spark):
    scores = [0.05, -0.05, 0.04, 0.2, -0.2, 0.0]
    assert one(spark, scores, N.label(F.col("x"), 0.05), "x double") == [
        "positive", "negative", "neutral", "positive", "negative", "neutral"]
    assert one(spark, scores, N.label(F.col("x"), 0.20), "x double") == [
        "neutral", "neutral", "neutral", "positive", "negative", "neutral"]
    assert one(spark, [10.0, 0.1, 0.0], N.severity(F.col("x")), "x double") == ["bad", "warn", "good"]
    assert one(spark, [0.2, 0.05, -0.05, -0.06], N.verdict_class(F.col("x")), "x double") == [
        "optimistic", "positive_with_criticism", "divided", "critical"]


def test_division_and_casts_never_raise(spark):
    assert one(spark, ["1.5", "abc", ""], N.to_double(F.col("x"))) == [1.5, None, None]
    assert one(spark, [0], N.pct(F.col("x"), F.col("x")), "x int") == [None]


@pytest.mark.parametrize("size", [0, 1, 3, 4, 100, 5000])
def test_lookup_of_any_size(spark, size):
    table = {f"wörd{i}": float(i) for i in range(size)}
    words = ["wörd0", f"wörd{size - 1}", "absent", None]
    want = [table.get(w) for w in words]
    assert one(spark, words, lookup(F.col("x"), table, "double")) == want
    assert one(spark, ["wörd0"], member(F.col("x"), table)) == [size > 0]


def test_kpi_text(spark):
    names = ["total_records", "null_rate_body_text", "outlier_rate_views", "weeks_covered"]
    assert one(spark, names, humanize_metric(F.col("x"))) == [
        "Total records", "Null rate - body text", "Outlier rate - views", "Weeks Covered"]
    rows = [("null_rate_url", "1.5", 1.5), ("total_records", "12345", 12345.0), ("text_length_max", "1234.5", 1234.5),
            ("token_count_mean", "3.14159", 3.14159), ("first_record_date", "2026-01-01", None), ("score", None, None)]
    df = spark.createDataFrame(rows, "m string, t string, n double").coalesce(1)
    got = [r[0] for r in df.select(format_value(F.col("m"), F.col("t"), F.col("n"))).collect()]
    assert got == ["1.50%", "12,345", "1,234", "3.14", "2026-01-01", "N/A"]


def test_other_characters_do_not_change_under_nfkc():
    pattern = re.compile("[" + re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: "\\U%08x" % int(m[1], 16), X.unstable_characters()) + "]")
    for start in range(0x80, 0x110000, 0x400):
        plain = [chr(c) for c in range(start, min(start + 0x400, 0x110000)) if not 0xD800 <= c < 0xE000 and not pattern.search(chr(c))]
        text = "a" + "a".join(plain) + "".join(plain)
        assert unicodedata.normalize("NFKC", text) == text
    assert pattern.search("e\u0301") and pattern.search("ﬁ") and not pattern.search("éüñß")


def test_long_class_is_not_tried_on_the_letters_of_latin_1(spark):
    pattern = re.compile("[" + re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: "\\U%08x" % int(m[1], 16), X.unstable_characters()) + "]")
    assert not pattern.search("".join(map(chr, [*range(0x80), *range(0xC0, 0x100)])))
    texts = ["Él está über Àÿ × ÷", "naïve\u0301 ½ ﬁ é", "日 \xa0 à"]
    assert one(spark, texts, X.rare_characters(F.col("x"))) == ["", "\u0301½ﬁ", "日\xa0"]
    assert one(spark, texts, X.nfkc_unescape(F.col("x"))) == [unicodedata.normalize("NFKC", t) for t in texts]
