"""The scorer against a plain Python statement of the published rules."""

import math
import random
import string

import pytest
from pyspark.sql import functions as F

from opinionlake import fixed
from opinionlake.operators.sentiment import Rules, read_lexicon, score_text, starter_rules, with_joined_sentiment, with_sentiment

RULES = starter_rules()


def plain_score(text, rules=RULES):
    words = []
    for raw in text.split():
        bare = raw.strip(string.punctuation)
        words.append(bare if len(bare) > 2 else raw)
    low = [w.lower() for w in words]
    mixed = 0 < sum(w.isupper() for w in words) < len(words)
    negated = lambda w: w in rules.negators or "n't" in w
    values = []
    for i, word in enumerate(low):
        if word not in rules.lexicon or word in rules.degrees or (word == "kind" and low[i + 1:i + 2] == ["of"]):
            values.append(0.0)
            continue
        v = rules.lexicon[word]
        if word == "no" and i + 1 < len(low) and low[i + 1] in rules.lexicon:
            v = 0.0
        before = low[max(i - 3, 0):i][::-1]
        if "no" in before[:2] or (before[2:3] == ["no"] and before[0] in ("or", "nor")):
            v = rules.lexicon[word] * -0.74
        if words[i].isupper() and mixed:
            v += 0.733 if v > 0 else -0.733
        for d, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i < d or low[i - d] in rules.lexicon:
                continue
            degree = rules.degrees.get(low[i - d])
            if degree is not None:
                s = -degree if v < 0 else degree
                if words[i - d].isupper() and mixed:
                    s += 0.733 if v > 0 else -0.733
                v += s * damp
            near = low[i - d + 1:i]
            if d > 1 and low[i - d] == "never" and ("so" in near or "this" in near):
                v *= 1.25
            elif d > 1 and low[i - d] == "without" and "doubt" in near:
                pass
            elif negated(low[i - d]):
                v *= -0.74
        if i >= 1 and low[i - 1] == "least" and "least" not in rules.lexicon and not (i > 1 and low[i - 2] in ("at", "very")):
            v *= -0.74
        values.append(v)
    if "but" in low:
        turn = low.index("but")
        values = [v * 0.5 if i < turn else v * 1.5 if i > turn else v for i, v in enumerate(values)]
    marks = text.count("?")
    amp = min(text.count("!"), 4) * 0.292 + (0 if marks <= 1 else marks * 0.18 if marks <= 3 else 0.96)
    s, p = sum(values), sum(v + 1 for v in values if v > 0)
    n, u = sum(1 - v for v in values if v < 0), sum(v == 0 for v in values)
    s += amp if s > 0 else -amp if s < 0 else 0
    p, n = (p + amp, n) if p > n else (p, n + amp) if p < n else (p, n)
    total = p + n + u
    return (s / math.sqrt(s * s + 15), p / total, n / total, u / total) if words else (0, 0, 0, 0)


def sentences():
    rng = random.Random(7)
    words = (["good", "bad", "GREAT", "Terrible", "win", "no", "No", "not", "never", "so", "this", "without", "doubt", "very",
              "VERY", "barely", "least", "at", "but", "But", "or", "nor", "isn't", "kind", "of", "the", "match", "love!", "hate?",
              "...", ":)", "fine,", "été"])
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 25))) + rng.choice(["", "!", "!!!!!", "??", "????"]) for _ in range(300)]


def test_scores_equal_plain_rules(spark):
    texts = ["", "good", "not good", "VERY good", "no good", "never so good", "without doubt good", "the least good", "at least good",
             "good but bad", "kind of good", "GOOD", "GOOD day", *sentences()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.s for r in df.select("i", score_text(F.col("t"), RULES).alias("s")).collect()}
    for i, text in enumerate(texts):
        want = plain_score(text)
        for name, expected, digits in zip(("compound", "pos", "neg", "neu"), want, (4, 3, 3, 3)):
            assert got[i][name] == pytest.approx(expected, abs=0.51 * 10 ** -digits), (text, name)


def test_record_scores(spark):
    rows = [
        (1, "good good", None, "reddit"), (2, None, "bad", "reddit"), (3, " ", None, "reddit"), (4, None, None, "scraping"),
        (5, "good\n\nbad\n  \nnothing", "x", "scraping"), (6, "good", None, None), (7, "x" * 1000 + " good", None, "scraping"),
    ]
    df = spark.createDataFrame(rows, "id int, body_text string, title string, source string")
    got = {r.id: r for r in with_sentiment(df, RULES).collect()}
    assert got[1].sentiment_label == "positive" and got[2].sentiment_label == "negative"
    for blank in (3, 4):
        assert (got[blank].vader_compound, got[blank].vader_neu, got[blank].sentiment_label) == (0.0, 1.0, "neutral")
    parts = [round(plain_score(p)[0], 4) for p in ("good", "bad", "nothing")]
    assert got[5].vader_compound == pytest.approx(sum(parts) / 3, abs=1e-4)
    assert got[6].sentiment_label == "positive"
    assert got[7].sentiment_label == "positive"  # the whole article counts
    cut = with_sentiment(df.filter("id = 7"), RULES, max_chars=1000).first()
    assert cut.sentiment_label == "neutral"


def test_read_lexicon(spark, tmp_path):
    (tmp_path / "lex.txt").write_text("superb\t3.1\t0.7\t[3, 3]\nMeh\t-0.5\t0.1\t[0]\nbroken\tx\n")
    rules = read_lexicon(spark, str(tmp_path / "lex.txt"))
    assert rules.lexicon == {"superb": 3.1, "meh": -0.5}
    assert fixed.STARTER_LEXICON["good"] == starter_rules().lexicon["good"]
