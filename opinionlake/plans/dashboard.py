"""The queries behind the dashboards: tables in, tables out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from opinionlake import fixed
from opinionlake.functions.numbers import gauge, polarity, rate_status, severity, signed
from opinionlake.functions.text import shorten
from opinionlake.operators import aspects as A
from opinionlake.operators import distribution as D
from opinionlake.operators import tokens as K
from opinionlake.operators.conform import scope
from opinionlake.operators.outliers import outlier_stats
from opinionlake.operators.quality import null_rates_long
from opinionlake.plans.governance import OUTLIER_CHECKS, governance, kpi_table


def display_label(key: Column, labels: Mapping[str, str]) -> Column:
    """Label by lookup, else the key with a capital first letter."""
    known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    capital = F.concat(F.upper(F.substring(key, 1, 1)), F.lower(F.substring(key, 2, 1_000_000)))
    return F.coalesce(F.try_element_at(known, key), capital)


def governance_view(gold: DataFrame, run_ts: str, source: str = "all") -> DataFrame:
    """KPI table of a scope with a status per KPI."""
    table = kpi_table(governance(scope(gold, source), run_ts))
    number = F.regexp_replace("Value", "[%,]", "").try_cast("double")
    return table.withColumn("status", rate_status(F.col("RawMetric"), number))


def null_view(gold: DataFrame, source: str = "all") -> DataFrame:
    """Null rates of the key fields of a scope, highest first, with their severity."""
    rates = null_rates_long(scope(gold, source), fixed.NULL_CHECKED)
    return (rates.select("column_name", "null_pct", severity(F.col("null_pct")).alias("severity"))
            .orderBy(F.desc("null_pct"), "column_name"))


def outlier_view(gold: DataFrame, source: str = "all") -> DataFrame:
    """Outlier rates of the numeric fields that exist in the scope, highest first."""
    checks = {c: F.col("source") == s for c, s in OUTLIER_CHECKS.items() if source in ("all", s)}
    rates = outlier_stats(gold, checks)
    return rates.select("column_name", "outlier_rate", severity(F.col("outlier_rate")).alias("severity")).orderBy(
        F.desc("outlier_rate"), "column_name")


def volume_view(gold: DataFrame, grain: str = "week", source: str = "all") -> DataFrame:
    return D.volume_by_period(scope(gold, source), "published_at", "source", grain)


def verdict_view(gold: DataFrame) -> DataFrame:
    """Label totals, mean score, its position on the gauge and the verdict class."""
    one = D.label_totals(gold)
    return one.withColumns({"gauge": gauge(F.col("compound")), "compound_text": signed(F.col("compound"))})


def trend_view(gold: DataFrame, grain: str = "week") -> dict[str, DataFrame]:
    return {
        "trend": D.trend(gold, "published_at", "source", "vader_compound", grain),
        "coverage": D.coverage_gap(gold, "published_at", grain),
        "delta": D.trend_delta(gold, "published_at", "vader_compound", grain),
    }


def keyword_view(top_keywords: DataFrame, keyword_sentiment: DataFrame, k: int = 20) -> DataFrame:
    return K.top_terms_scored(top_keywords, keyword_sentiment, k)


def bigram_view(top_bigrams: DataFrame, k: int = 15) -> DataFrame:
    return K.top_n(top_bigrams, "frequency", k, "bigram")


def aspect_view(summary: DataFrame) -> DataFrame:
    """Aspects over all sources with display label and polarity band."""
    return summary.filter(F.col("source") == "all").select(
        "aspect", display_label(F.col("aspect"), fixed.ASPECT_LABELS).alias("label"), "compound_mean",
        polarity(F.col("compound_mean")).alias("band"), "n_mentions", "pct_positive", "pct_negative")


def drilldown_view(summary: DataFrame, cowords: DataFrame, snippets: DataFrame, aspect: str) -> dict[str, DataFrame]:
    parts = A.drilldown(summary, cowords, snippets, aspect)
    parts["snippets"] = parts["snippets"].withColumns({
        "text_snippet": shorten(F.col("text_snippet")), "score_text": signed(F.col("vader_compound"))})
    return parts
