"""Interquartile bounds, capping, imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opinionlake.fixed import IQR_FACTOR
from opinionlake.functions.numbers import clip, pct
from opinionlake.operators.quantiles import group_lookup, median, quantiles


def iqr_bounds(df: DataFrame, value: str, by: Sequence[str] = (), k: float = IQR_FACTOR,
               small_domain: bool = False) -> DataFrame:
    """Per group: n, q1, q3, iqr, lower, upper."""
    q1, q3 = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    return (quantiles(df, value, [0.25, 0.75], by, small_domain)
            .select(*by, "n", q1.alias("q1"), q3.alias("q3"))
            .withColumn("iqr", F.col("q3") - F.col("q1"))
            .withColumn("lower", F.col("q1") - k * F.col("iqr"))
            .withColumn("upper", F.col("q3") + k * F.col("iqr")))


def cap_outliers(df: DataFrame, values: Sequence[str], by: Sequence[str] = (), small_domain: bool = False) -> DataFrame:
    """Clip each column to the interquartile bounds of its group (a batch, a file).

    The columns are stacked, so the bounds of all of them come from one job.
    """
    stacked = df.select(*by, F.inline(F.array(*[
        F.struct(F.lit(v).alias("_column"), F.col(v).cast("double").alias("_value")) for v in values])))
    bounds = iqr_bounds(stacked, "_value", [*by, "_column"], small_domain=small_domain)
    wide = bounds.groupBy(*by).agg(*[
        F.max(F.when(F.col("_column") == v, F.struct("lower", "upper"))).alias(f"_b_{v}") for v in values])
    if by:
        joined = group_lookup(df, wide, by)
    else:
        joined = df.withColumn("_b", wide.select(F.struct(*wide.columns)).scalar())
    prefix = "" if by else "_b."
    capped = joined.withColumns({v: clip(F.col(v).cast("double"), F.col(f"{prefix}_b_{v}.lower"), F.col(f"{prefix}_b_{v}.upper"))
                                 for v in values})
    return capped.drop(*[f"_b_{v}" for v in values], "_b")


def impute_median(df: DataFrame, value: str, by: Sequence[str] = (), small_domain: bool = False) -> DataFrame:
    """Replace nulls by the median of the group."""
    mid = median(df, value, by, small_domain).select(*by, F.col("median").alias("_median"))
    joined = group_lookup(df, mid, by) if by else df.withColumn("_median", mid.select("_median").scalar())
    return joined.withColumn(value, F.coalesce(F.col(value).cast("double"), F.col("_median"))).drop("_median")


def outlier_stats(df: DataFrame, checks: Mapping[str, Column | None], k: float = IQR_FACTOR) -> DataFrame:
    """One row per checked column: values, outliers, their rate, quartiles and bounds.

    ``checks`` maps a column to the condition that selects its rows.  The columns
    are stacked, so one job serves all of them; a column without values has no row.
    """
    def value(name: str, where: Column | None) -> Column:
        number = F.col(name).cast("double")
        return number if where is None else F.when(where, number)

    stacked = df.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), value(name, where).alias("v")) for name, where in checks.items()
    ]))).filter(F.col("v").isNotNull())
    bounds = iqr_bounds(stacked, "v", ["column_name"], k)
    placed = stacked.join(F.broadcast(bounds.drop("n")), "column_name")
    parts = ["q1", "q3", "iqr", "lower", "upper"]
    return (placed.groupBy("column_name")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.when((F.col("v") < F.col("lower")) | (F.col("v") > F.col("upper")), 1).otherwise(0)).alias("n_outliers"),
                 *[F.max(c).alias(c) for c in parts])
            .select("column_name", "n", "n_outliers", F.round(pct(F.col("n_outliers"), F.col("n")), 2).alias("outlier_rate"), *parts))


def iqr_outliers(df: DataFrame, value: str, where: Column | None = None, k: float = IQR_FACTOR) -> DataFrame:
    """The outlier statistics of one column over the chosen rows."""
    return outlier_stats(df, {value: where}, k).drop("column_name")
