"""Number helpers, bands and value formatting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from opinionlake.fixed import LABELS


def to_double(col: Column) -> Column:
    """Number or null; never an error."""
    return col.try_cast("double")


def pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def share(condition: Column) -> Column:
    """Percentage of rows for which the condition holds (null counts as not)."""
    return F.avg(F.when(condition, F.lit(100.0)).otherwise(F.lit(0.0)))


def clip(col: Column, low: Column, high: Column) -> Column:
    """Keep nulls null; a missing bound does not clip."""
    return F.when(col < low, low).when(col > high, high).otherwise(col)


def severity(rate: Column) -> Column:
    return F.when(rate >= 10, "bad").when(rate > 0, "warn").otherwise("good")


def polarity(score: Column, step: float = 0.05) -> Column:
    return F.when(score >= step, LABELS[0]).when(score <= -step, LABELS[2]).otherwise(LABELS[1])


def label(score: Column, threshold: Column | float) -> Column:
    threshold = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.when(score >= threshold, LABELS[0]).when(score <= -threshold, LABELS[2]).otherwise(LABELS[1])


def verdict_class(score: Column) -> Column:
    return (F.when(score >= 0.2, "optimistic").when(score >= 0.05, "positive_with_criticism")
            .when(score >= -0.05, "divided").otherwise("critical"))


def rate_status(metric: Column, value: Column) -> Column:
    watched = metric.isin("duplicate_rate", "body_text_missing_rate")
    return (F.when(metric == "schema_compliance_rate", "good")
            .when(watched & (F.coalesce(value, F.lit(0.0)) > 0), "bad")
            .when(watched, "good").otherwise("neutral"))


def gauge(score: Column) -> Column:
    """Position of a score in [-1, 1] on a 0..100 scale."""
    return F.round((score + 1) / 2 * 100, 1)


def signed(score: Column) -> Column:
    return F.format_string("%+.3f", score)
