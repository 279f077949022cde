"""Aspect matching and the aspect tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opinionlake.fixed import ASPECTS, COWORD_BLOCKLIST, LABELS
from opinionlake.functions.lookup import lookup, member
from opinionlake.functions.numbers import share
from opinionlake.functions.text import any_word, snippet, word_pattern
from opinionlake.operators.dedup import top_per_group
from opinionlake.operators.tokens import processed_tokens

_SINGLE_WORD = re.compile(r"\w+")


def aspects_of(cols: Sequence[Column], aspects: Mapping[str, Iterable[str]] = ASPECTS) -> Column:
    """Array of the aspects any of the texts mentions (whole words, case-insensitive).

    All one-word keywords go through one regex pass that emits only the hits;
    two of them can never overlap, so the result equals one test per aspect.
    Phrases are tested aspect by aspect.
    """
    owners: dict[str, list[str]] = {}
    phrases: dict[str, list[str]] = {}
    for aspect, words in aspects.items():
        for word in words:
            if _SINGLE_WORD.fullmatch(word):
                owners.setdefault(word.lower(), []).append(aspect)
            else:
                phrases.setdefault(aspect, []).append(word)

    found = []
    if owners:
        pattern = F.lit(word_pattern(owners))
        hits = F.concat(*[F.regexp_extract_all(F.coalesce(c, F.lit("")), pattern, F.lit(0)) for c in cols])
        named = F.transform(F.array_distinct(F.transform(hits, F.lower)), lambda w: lookup(w, owners, "array<string>"))
        found.append(F.flatten(F.array_compact(named)))
    for aspect, words in phrases.items():
        matched = F.lit(False)
        for c in cols:
            matched = matched | F.coalesce(any_word(c, words), F.lit(False))
        found.append(F.when(matched, F.array(F.lit(aspect))).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.concat(*found))


def match_aspects(df: DataFrame, cols: Sequence[str] = ("body_text", "title"),
                  aspects: Mapping[str, Iterable[str]] = ASPECTS) -> DataFrame:
    """One row per record and aspect it mentions."""
    return df.withColumn("aspect", F.explode(aspects_of([F.col(c) for c in cols], aspects)))


def aspect_summary(matches: DataFrame, score: str = "vader_compound", label: str = "sentiment_label") -> DataFrame:
    """Mentions, mean, spread and label shares per aspect: all sources together and each source."""
    rows = matches.select("aspect", "source", score, label)
    grouped = rows.groupingSets([["aspect"], ["aspect", "source"]], "aspect", "source").agg(
        F.grouping("source").alias("_all"),
        F.count(F.lit(1)).alias("n_mentions"),
        F.round(F.avg(score), 4).alias("compound_mean"),
        F.round(F.stddev_samp(score), 4).alias("compound_std"),
        *[F.round(share(F.col(label) == name), 2).alias(f"pct_{name}") for name in LABELS],
        F.mode(F.col(label), True).alias("sentiment_mode"),
    )
    source = F.when(F.col("_all") == 1, "all").otherwise(F.col("source"))
    return grouped.select("aspect", source.alias("source"), "n_mentions", "compound_mean", "compound_std",
                          *[f"pct_{name}" for name in LABELS], "sentiment_mode")


def aspect_cowords(matches: DataFrame, aspects: Mapping[str, Iterable[str]] = ASPECTS, pool: int | None = None, k: int = 10,
                   blocklist: Iterable[str] = COWORD_BLOCKLIST, processed: str = "text_processed",
                   label: str = "sentiment_label", min_len: int = 3) -> DataFrame:
    """Words of the records of each aspect and label.

    The ``k`` most frequent of those that are no aspect keyword, not blocked and
    long enough; with ``pool``, only of the ``pool`` most frequent words of all.
    """
    rows = matches.select("aspect", F.col(label).alias("sentiment"), processed)
    counts = (rows.withColumn("word", F.explode(processed_tokens(F.col(processed))))
              .groupBy("aspect", "sentiment", "word").agg(F.count(F.lit(1)).alias("frequency")))
    order = [F.desc("frequency"), F.asc("word")]
    pooled = counts if pool is None else top_per_group(counts, ["aspect", "sentiment"], order, pool).drop("rank")
    own_words = F.coalesce(*[F.when((F.col("aspect") == a) & member(F.lower("word"), words), True)
                             for a, words in aspects.items()], F.lit(False))
    kept = pooled.filter(
        ~own_words & ~member(F.lower("word"), blocklist) & (F.length("word") >= min_len))
    best = top_per_group(kept, ["aspect", "sentiment"], order, k).drop("rank")
    docs = rows.groupBy("aspect", "sentiment").agg(F.count(F.lit(1)).alias("n_docs"))
    return best.join(docs, ["aspect", "sentiment"])


def aspect_snippets(matches: DataFrame, k: int = 3, key: str = "url", score: str = "vader_compound",
                    label: str = "sentiment_label", chars: int = 300, title_chars: int = 120) -> DataFrame:
    """The ``k`` highest and ``k`` lowest scored texts per aspect.

    Texts are cut before the ranking, so no whole body is shuffled.
    """
    text = F.coalesce(F.nullif(F.col("body_text"), F.lit("")), F.col("title"), F.lit(""))
    rows = matches.select(
        "aspect", key, snippet(text, chars).alias("text_snippet"), F.col(score).alias("vader_compound"),
        F.col(label).alias("sentiment_label"), "source",
        F.substring(F.coalesce("title", F.lit("")), 1, title_chars).alias("title"))

    def pole(name: str, direction: Column) -> DataFrame:
        return top_per_group(rows, "aspect", [direction, F.asc(key)], k).withColumn("sentiment_pole", F.lit(name))

    both = pole("positive", F.desc_nulls_last("vader_compound")).unionByName(
        pole("negative", F.asc_nulls_last("vader_compound")))
    return both.select("aspect", "sentiment_pole", "rank", "text_snippet", "vader_compound",
                       "sentiment_label", "source", "title")


def extremes(summary: DataFrame, score: str = "compound_mean") -> DataFrame:
    """The best and the worst aspect over all sources; equal scores go to the first name."""
    rows = summary.filter(F.col("source") == "all")
    return (
        rows.orderBy(F.desc_nulls_last(score), "aspect").limit(1).withColumn("kind", F.lit("best"))
        .unionByName(rows.orderBy(F.asc_nulls_last(score), "aspect").limit(1).withColumn("kind", F.lit("worst")))
        .select("kind", "aspect", score, "n_mentions", "pct_positive", "pct_negative"))


def drilldown(summary: DataFrame, cowords: DataFrame, snippets: DataFrame, aspect: str,
              n_snippets: int = 2, k: int = 10) -> dict[str, DataFrame]:
    """The tables behind one aspect's page."""
    mine = cowords.filter(F.col("aspect") == aspect)
    return {
        "summary": summary.filter((F.col("aspect") == aspect) & (F.col("source") == "all"))
        .withColumns({"pct_positive": F.round("pct_positive", 1), "pct_negative": F.round("pct_negative", 1)}),
        "cowords": top_per_group(mine.filter(F.col("sentiment").isin("positive", "negative")),
                                 ["aspect", "sentiment"], [F.asc("frequency"), F.asc("word")], k).drop("rank"),
        "snippets": snippets.filter((F.col("aspect") == aspect) & (F.col("rank") <= n_snippets)),
    }


