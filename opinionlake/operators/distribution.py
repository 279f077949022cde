"""Counts, shares, trends and comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from opinionlake import fixed
from opinionlake.functions.numbers import pct, share, verdict_class
from opinionlake.functions.timeparts import period_label, week_label


def with_week(df: DataFrame, ts: str = "published_at", undated: str | None = fixed.UNDATED) -> DataFrame:
    return df.withColumn("week", week_label(F.col(ts), undated))


def share_of(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "pct") -> DataFrame:
    """Percentage of ``value`` in its group; use on aggregated tables."""
    total = F.sum(value).over(Window.partitionBy(*by))
    return df.withColumn(name, F.round(pct(F.col(value), total), 2))


def label_distribution(df: DataFrame, by: Sequence[str], label: str = "sentiment_label",
                       share_within: Sequence[str] = ()) -> DataFrame:
    """Rows per group and label, with the share of the grand total or of a group."""
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("count"))
    return share_of(counts, "count", share_within)


def label_share(df: DataFrame, label: str = "sentiment_label", values: Sequence[str] = fixed.LABELS) -> DataFrame:
    """One row: share of each label among the labelled rows."""
    labelled = df.filter(F.col(label).isNotNull())
    return labelled.agg(*[F.round(share(F.col(label) == v), 2).alias(f"sentiment_pct_{v}") for v in values])


def score_trend(df: DataFrame, by: Sequence[str], value: str = "vader_compound", mean: str = "compound_mean",
                digits: int = 4) -> DataFrame:
    """Mean and non-null count of a score per group."""
    return df.groupBy(*by).agg(F.round(F.avg(value), digits).alias(mean), F.count(value).alias("n_records"))


def trend(df: DataFrame, ts: str, by: str, value: str, grain: str = "week", digits: int = 4) -> DataFrame:
    """Mean and row count per period and source: one aggregation, no join."""
    period = F.date_format(ts, "yyyy-MM-dd") if grain == "day" else week_label(F.col(ts), fixed.UNDATED)
    return df.groupBy(period.alias("period"), by).agg(
        F.round(F.avg(value), digits).alias("mean"), F.count(F.lit(1)).alias("n"))


def volume(df: DataFrame, by: Sequence[str], name: str = "n_records") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def volume_by_period(df: DataFrame, ts: str, by: str, grain: str, groups: Sequence[str] | None = None) -> DataFrame:
    """Rows per period and source plus a total, zero where a source is silent in an observed period.

    Every source, however many there are, gets a row for each observed period; the
    counts are joined to those rows by period and source.  Only the observed periods,
    days at most, are gathered in a list.
    """
    rows = df.filter(F.col(ts).isNotNull()).select(period_label(F.col(ts), grain).alias("period"), F.col(by).alias("source"))
    counts = rows.groupBy("period", "source").agg(F.count(F.lit(1)).alias("n"))
    periods = counts.agg(F.collect_set("period")).scalar()
    if groups is None:
        sources = counts.filter(F.col("source").isNotNull()).select("source").distinct()
    else:
        sources = df.sparkSession.createDataFrame([(g,) for g in groups], "source string")
    spine = sources.select("source", F.explode(periods).alias("period"))
    filled = spine.join(counts, ["period", "source"], "left").select("period", "source", F.coalesce("n", F.lit(0)).alias("n_records"))
    total = counts.groupBy("period").agg(F.sum("n").alias("n_records")).select("period", F.lit("all").alias("source"), "n_records")
    return filled.unionByName(total)


def compare_sources(df: DataFrame, by: str = "source", key: str = "url", score: str = "vader_compound",
                    label: str = "sentiment_label", tokens: str = "token_count") -> DataFrame:
    return df.groupBy(by).agg(
        F.count(key).alias("n_records"),
        F.round(F.avg(score), 4).alias("compound_mean"),
        F.round(F.stddev_samp(score), 4).alias("compound_std"),
        *[F.round(share(F.col(label) == v), 4).alias(f"pct_{v}") for v in fixed.LABELS],
        F.round(F.avg(tokens), 4).alias("avg_token_count"))


def count_by(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def label_totals(df: DataFrame, label: str = "sentiment_label", score: str = "vader_compound",
                 by: str = "source", sources: Sequence[str] = fixed.SOURCES) -> DataFrame:
    """One row: total, dominant label and its share, label shares, mean score, rows per source, verdict.

    On equal counts the alphabetically first label dominates.
    """
    def counted(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    wide = df.agg(
        *[counted(F.col(label) == v).alias(v) for v in fixed.LABELS],
        *[counted((F.col(by) == s) & F.col(label).isNotNull()).alias(f"n_{s}") for s in sources],
        F.round(F.avg(score), 3).alias("compound"))
    total = sum((F.col(v) for v in fixed.LABELS), F.lit(0))
    # max over (count, reversed order): the alphabetically first label wins a tie
    ranked = F.array(*[F.struct(F.col(v).alias("n"), F.lit(-i).alias("o"), F.lit(v).alias("label"))
                       for i, v in enumerate(sorted(fixed.LABELS))])
    top = F.array_max(ranked)
    return wide.select(
        total.alias("total"), top["label"].alias("dominant"), F.round(pct(top["n"], total), 1).alias("dominant_pct"),
        *[F.round(pct(F.col(v), total), 1).alias(f"{v}_pct") for v in fixed.LABELS],
        "compound", *[f"n_{s}" for s in sources], verdict_class(F.col("compound")).alias("verdict"))


def coverage_gap(df: DataFrame, ts: str, grain: str = "week", by: str = "source",
                 sources: Sequence[str] = fixed.SOURCES) -> DataFrame:
    """Periods seen per source; flagged when the first source has fewer than the second."""
    period = F.date_format(ts, "yyyy-MM-dd") if grain == "day" else week_label(F.col(ts), fixed.UNDATED)
    seen = (df.select(period.alias("p"), F.col(by).alias("s")).filter(F.col("p").isNotNull()).distinct())
    counts = seen.agg(*[F.count(F.when(F.col("s") == s, 1)).alias(f"n_{s}") for s in sources])
    return counts.withColumn("unequal", F.col(f"n_{sources[0]}") < F.col(f"n_{sources[1]}"))


def trend_delta(df: DataFrame, ts: str, value: str, grain: str = "week", by: str = "source",
                source: str = fixed.ARTICLES, min_periods: int = 2, step: float = fixed.TREND_STEP) -> DataFrame:
    """Last period mean minus first period mean of one source, with its direction."""
    period = F.date_format(ts, "yyyy-MM-dd") if grain == "day" else week_label(F.col(ts), fixed.UNDATED)
    means = (df.filter(F.col(by) == source).groupBy(period.alias("p")).agg(F.avg(value).alias("m"))
             .filter(F.col("p").isNotNull()))
    ends = means.agg(F.count(F.lit(1)).alias("n_periods"), F.max_by("m", "p").alias("last"), F.min_by("m", "p").alias("first"))
    delta = F.when(F.col("n_periods") >= min_periods, F.col("last") - F.col("first"))
    return ends.select("n_periods", F.round(delta, 4).alias("delta"),
                       F.when(delta > step, "up").when(delta < -step, "down").when(delta.isNotNull(), "flat").alias("direction"))


def source_gap(comparison: DataFrame, a: str = fixed.ARTICLES, b: str = fixed.POSTS, by: str = "source",
               points: float = fixed.SOURCE_GAP_POINTS) -> DataFrame:
    """Difference in positive and negative share between two sources, flagged beyond ``points``."""
    def value(source: str, col: str) -> Column:
        return F.max(F.when(F.col(by) == source, F.col(col)))

    gaps = comparison.agg(
        F.round(value(a, "pct_positive") - value(b, "pct_positive"), 1).alias("diff_positive"),
        F.round(value(b, "pct_negative") - value(a, "pct_negative"), 1).alias("diff_negative"))
    more_positive = F.when(F.abs("diff_positive") > points, F.when(F.col("diff_positive") > 0, a).otherwise(b))
    more_negative = F.when(F.abs("diff_negative") > points, F.when(F.col("diff_negative") > 0, b).otherwise(a))
    return gaps.select("diff_positive", "diff_negative", more_positive.alias("more_positive"),
                       more_negative.alias("more_critical"),
                       (more_positive.isNull() & more_negative.isNull()).alias("aligned"))


def pivot_counts(df: DataFrame, row: str, col: str, values: Sequence[str], count: str | None = None) -> DataFrame:
    """Wide table of counts (or of a summed column) with zeros for absent cells."""
    amount = F.sum(count) if count else F.count(F.lit(1))
    return df.groupBy(row).pivot(col, list(values)).agg(amount).na.fill(0, list(values))



def sample_rows(df: DataFrame, key: str, n: int = 1) -> DataFrame:
    """The first ``n`` records by key, for a look at the data."""
    return df.orderBy(key).limit(n)
