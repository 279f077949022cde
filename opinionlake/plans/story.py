"""The published aggregates of a gold table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from opinionlake import fixed
from opinionlake.operators import aspects as A
from opinionlake.operators import distribution as D
from opinionlake.operators import tokens as K

TABLES = (
    "sentiment_distribution", "sentiment_dist_time", "sentiment_trend", "top_keywords", "top_bigrams",
    "keyword_sentiment", "source_comparison", "volume_trend", "aspect_sentiment", "aspect_cowords", "aspect_snippets",
)


def story_tables(gold: DataFrame, aspects: Mapping[str, Iterable[str]] = fixed.ASPECTS,
                 undated: str | None = fixed.UNDATED) -> dict[str, DataFrame]:
    """The eleven aggregate tables; ``gold`` should be a stored table, it is read once per aggregate."""
    weekly = D.with_week(gold, undated=undated)
    keywords = K.top_tokens(gold, k=50)
    matches = A.match_aspects(gold, aspects=aspects)
    return {
        "sentiment_distribution": D.label_distribution(gold, ["source"]),
        "sentiment_dist_time": D.label_distribution(weekly, ["week"], share_within=["week"]),
        "sentiment_trend": D.score_trend(weekly, ["week", "source"]),
        "top_keywords": keywords,
        "top_bigrams": K.top_bigrams(gold, k=30),
        "keyword_sentiment": K.term_sentiment(gold, K.top_n(keywords, "frequency", 20, "keyword")),
        "source_comparison": D.compare_sources(gold),
        "volume_trend": D.volume(weekly, ["week", "source"]),
        "aspect_sentiment": A.aspect_summary(matches),
        "aspect_cowords": A.aspect_cowords(matches, aspects),
        "aspect_snippets": A.aspect_snippets(matches),
    }


def run_summary(gold: DataFrame, top_keywords: DataFrame, run_ts: str,
                tables: Iterable[str] = TABLES, aspects: Iterable[str] = tuple(fixed.ASPECTS),
                undated: str | None = fixed.UNDATED) -> DataFrame:
    """One row about the run; lists are real arrays."""
    best = K.top_n(top_keywords, "frequency", 1, "keyword").agg(F.max("keyword")).scalar()
    one = D.with_week(gold, undated=undated).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sort_array(F.collect_set("source")).alias("sources"),
        F.size(F.collect_set("week")).alias("weeks_covered"),
        F.coalesce(F.mode(F.col("sentiment_label"), True), F.lit("")).alias("overall_sentiment"),
        F.round(F.avg("vader_compound"), 4).alias("overall_compound"))
    return one.select(
        F.lit(run_ts).alias("pipeline_run_ts"), "total_records", "sources", "weeks_covered",
        F.coalesce(best, F.lit("")).alias("top_keyword"), "overall_sentiment", "overall_compound",
        F.array(*[F.lit(t) for t in tables]).alias("aggregations_saved"),
        F.array(*[F.lit(a) for a in aspects]).alias("aspects_analyzed"))
