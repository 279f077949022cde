"""Data-quality measures of one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opinionlake import fixed
from opinionlake.functions.numbers import pct, share
from opinionlake.functions.timeparts import week_label
from opinionlake.operators.dedup import dedup_first
from opinionlake.operators.outliers import impute_median
from opinionlake.operators.quantiles import group_lookup, median, quantiles, same_group_join


def null_rate(col: str) -> Column:
    return F.round(share(F.col(col).isNull()), 2)


def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row, one rate per column, one pass."""
    return df.agg(*[null_rate(c).alias(f"null_rate_{c}") for c in cols or df.columns])


def null_rates_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column: nulls, rate and type."""
    cols = list(cols or df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in cols])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), (F.col("_n") - F.col(c)).alias("null_count"),
                               F.round(pct(F.col("_n") - F.col(c), F.col("_n")), 2).alias("null_pct"),
                               F.lit(types[c]).alias("dtype")) for c in cols])
    return counted.select(F.inline(cells))


def flag_rate(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(F.round(share(F.col(flag)), 2).alias(f"{flag}_rate"))


def numeric_stats(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    return df.agg(F.round(F.avg(col), digits).alias(f"{col}_mean"), F.round(F.stddev_samp(col), digits).alias(f"{col}_std"),
                  F.min(col).alias(f"{col}_min"), F.max(col).alias(f"{col}_max"))


def text_length_stats(df: DataFrame, col: str, by: str = "source") -> DataFrame:
    """Length mean, median, min and max over the table (``all``) and per group."""
    lengths = df.select(F.col(by), F.length(col).alias("n")).filter(F.col("n").isNotNull())
    grouped = lengths.groupingSets([[], [by]], by).agg(
        F.grouping(by).alias("_all"), F.round(F.avg("n"), 2).alias("mean"),
        F.round(F.percentile("n", F.lit(0.5)), 2).alias("median"), F.min("n").alias("min"), F.max("n").alias("max"))
    return grouped.select(F.when(F.col("_all") == 1, "all").otherwise(F.col(by)).alias(by), "mean", "median", "min", "max")


def schema_compliant(cols: Sequence[str]) -> Column:
    held = F.lit(True)
    for c in cols:
        held = held & F.col(c).isNotNull()
    return held


def schema_compliance(df: DataFrame, required: Sequence[str] = fixed.REQUIRED) -> DataFrame:
    """Share of rows with every required column filled; null when a column is absent."""
    if not set(required) <= set(df.columns):
        return df.agg(F.lit(None).cast("double").alias("schema_compliance_rate"))
    return df.agg(F.round(share(schema_compliant(required)), 2).alias("schema_compliance_rate"))


def distinct_seen(col: Column) -> Column:
    """Distinct values of a column with a small domain (days, weeks), without a second shuffle."""
    return F.size(F.collect_set(col))


TIME_COLUMNS = ("first_record_date", "last_record_date", "span_days", "weeks_covered", "days_covered",
                "avg_records_per_week", "avg_records_per_day")


def time_columns(ts: str) -> dict[str, Column]:
    """Aggregates of the time coverage; undated rows count in the averages' numerator."""
    rows, first, last = F.count(F.lit(1)), F.min(ts), F.max(ts)
    weeks, days = distinct_seen(week_label(F.col(ts))), distinct_seen(F.to_date(ts))
    span = F.floor((F.unix_micros(last.cast("timestamp")) - F.unix_micros(first.cast("timestamp"))) / 86_400_000_000)
    return dict(zip(TIME_COLUMNS, (
        F.to_date(first).cast("string"), F.to_date(last).cast("string"), span.cast("long"), weeks, days,
        F.round(F.try_divide(rows, weeks), 2), F.round(F.try_divide(rows, days), 2))))


def time_coverage(df: DataFrame, ts: str = "published_at") -> DataFrame:
    return df.agg(*[c.alias(name) for name, c in time_columns(ts).items()])


def compliance_columns(lineage: str, by: str, sources: Sequence[str], expected: int) -> dict[str, Column]:
    # files are many: they are counted by a shuffle, not gathered in a set
    runs = {s: F.count_distinct(F.when(F.col(by) == s, F.col(lineage))) for s in sources}
    out = {f"actual_runs_{s}": n for s, n in runs.items()}
    out["expected_runs_weekly"] = F.lit(expected)
    for s, n in runs.items():
        out[f"ingestion_compliance_{s}"] = F.round(F.least(n * F.lit(100.0) / expected, F.lit(100.0)), 2)
    return out


def ingestion_compliance(df: DataFrame, lineage: str = "bronze_source", by: str = "source",
                         sources: Sequence[str] = fixed.SOURCES, expected: int = fixed.EXPECTED_RUNS) -> DataFrame:
    """Runs seen per source against the expected number, at most 100 %."""
    return df.agg(*[c.alias(name) for name, c in compliance_columns(lineage, by, sources, expected).items()])


def runs(df: DataFrame, lineage: str = "bronze_source", by: str = "source") -> DataFrame:
    return df.groupBy(by, lineage).agg(F.count(F.lit(1)).alias("n")).orderBy(by, lineage)


def describe(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max of text lengths, one row each."""
    stats = df.select(F.length(col).alias("n")).agg(
        F.count("n").cast("double").alias("count"), F.round(F.avg("n"), 4).alias("mean"),
        F.round(F.stddev_samp("n"), 4).alias("std"), F.min("n").cast("double").alias("min"),
        F.percentile("n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.max("n").cast("double").alias("max"))
    quartiles = stats.select("count", "mean", "std", "min", F.get("q", F.lit(0)).alias("25%"),
                             F.get("q", F.lit(1)).alias("50%"), F.get("q", F.lit(2)).alias("75%"), "max")
    return quartiles.unpivot([], quartiles.columns, "statistic", "value")


def short_share(df: DataFrame, col: str, limit: int = fixed.SHORT_CHARS) -> DataFrame:
    """Texts shorter than ``limit``; null texts count in the whole only."""
    short = F.count(F.when(F.length(col) < limit, 1))
    return df.agg(short.alias("n_short"), F.round(pct(short, F.count(F.lit(1))), 2).alias("pct_short"))


def histogram(df: DataFrame, col: str, bins: int = 40, clip_q: float = 0.99) -> DataFrame:
    """Equal-width bins of text lengths clipped at a quantile; empty bins are kept, the last bin is closed."""
    lengths = df.select(F.length(col).alias("n")).filter(F.col("n").isNotNull())
    edges = (lengths.agg(F.min("n").cast("double").alias("lo"), F.percentile("n", F.lit(clip_q)).alias("hi"))
             .select(F.struct("lo", "hi").alias("e")).scalar())
    placed = lengths.withColumn("e", edges).select(
        F.least(F.when(F.col("e.lo") == F.col("e.hi"), F.lit(1)).otherwise(
            F.floor((F.least(F.col("n"), F.col("e.hi")) - F.col("e.lo")) / ((F.col("e.hi") - F.col("e.lo")) / bins)) + 1),
            F.lit(bins)).cast("int").alias("bin"))
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    filled = counts.agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    return (filled.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "m")
            .select("bin", F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).alias("n")))


def batch_metrics_articles(df: DataFrame, value: str = "reading_time_min", key: str = "url",
                           by: str = "bronze_source", order: Sequence[str] = ("row_order",)) -> DataFrame:
    """One row per input file: rows kept, repeats removed, outliers and bounds.

    The first row of a key (``order``) counts and null keys do not; missing values
    are the median of the file, and nothing is capped yet.
    """
    per_key = (df.groupBy(by, key).agg(F.count(F.lit(1)).alias("copies")))
    sizes = per_key.groupBy(by).agg(
        F.sum(F.when(F.col(key).isNotNull(), 1).otherwise(0)).alias("rows"),
        F.sum(F.col("copies") - 1).alias("duplicates"))
    kept = dedup_first(df.filter(F.col(key).isNotNull()).select(by, key, value, *order), [by, key], order)
    kept = impute_median(kept, value, [by], small_domain=True)
    q = quantiles(kept, value, [0.25, 0.75], [by], small_domain=True).select(
        by, F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("q3"))
    bounds = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
              .withColumn("lower", F.col("q1") - fixed.IQR_FACTOR * F.col("iqr"))
              .withColumn("upper", F.col("q3") + fixed.IQR_FACTOR * F.col("iqr")))
    flagged = group_lookup(kept, bounds, [by])
    outliers = flagged.groupBy(by).agg(F.sum(F.when(
        (F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper")), 1).otherwise(0)).alias("n_outliers"))
    out = same_group_join(same_group_join(sizes, bounds, [by]), outliers, [by])
    return out.withColumn("outlier_pct", F.round(pct(F.col("n_outliers"), F.col("rows")), 2))


def batch_metrics_posts(df: DataFrame, duplicates: DataFrame, by: str = "bronze_source") -> DataFrame:
    """One row per input file: rows, repeats removed, empty bodies and medians.

    ``df`` is the cleaned batch with capped numbers; ``duplicates`` holds (file, duplicates).
    """
    stats = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.when(F.col("body_text_missing"), 1).otherwise(0)).alias("empty_bodies"))
    for name in ("score", "num_comments"):  # free numbers: no hash map of all values
        middle = median(df, name, [by]).select(by, F.col("median").alias(f"{name}_median"))
        stats = same_group_join(stats, middle, [by])
    return same_group_join(stats, duplicates, [by])


def batch_duplicates(df: DataFrame, key: str = "url", by: str = "bronze_source") -> DataFrame:
    """Rows beyond the first of each key, per input file; null keys are equal to each other."""
    return (df.groupBy(by, key).agg(F.count(F.lit(1)).alias("copies"))
            .groupBy(by).agg(F.sum(F.col("copies") - 1).alias("duplicates")))
