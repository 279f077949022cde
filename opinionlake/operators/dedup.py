"""First-row-per-key, duplicate statistics, insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from opinionlake.functions.numbers import pct
from opinionlake.session import stored

Keys = str | Sequence[str]


def _names(key: Keys) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def dedup_first(df: DataFrame, key: Keys, order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key under ``order``.

    Written as row_number() = 1, so Spark keeps one row per key in every map
    task before the shuffle: a key that holds a third of the table costs one row
    per task, not one huge group.
    """
    rank = F.row_number().over(Window.partitionBy(*_names(key)).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def top_per_group(df: DataFrame, by: Keys, order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group with their rank (partial top-k before the shuffle)."""
    position = F.row_number().over(Window.partitionBy(*_names(by)).orderBy(*order))
    return df.withColumn(rank, position).filter(F.col(rank) <= k)


def key_counts(df: DataFrame, key: Keys) -> DataFrame:
    """One row: all rows and distinct keys, a null key counting as one key."""
    per_key = df.groupBy(*_names(key)).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
    )


def duplicate_rate(df: DataFrame, key: Keys) -> DataFrame:
    """Rows beyond the first of each key, as a count and as a percentage."""
    extra = F.col("rows") - F.col("distinct_keys")
    return key_counts(df, key).select(
        F.col("rows").alias("total"),
        extra.alias("duplicates"),
        F.round(pct(extra, F.col("rows")), 2).alias("duplicate_rate"),
    )


def dedup_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row totals of two tables and the share removed between them."""
    n_after = after.agg(F.count(F.lit(1)).alias("n")).scalar()
    totals = before.agg(F.count(F.lit(1)).alias("records_before_dedup")).withColumn("records_after_dedup", n_after)
    removed = F.greatest(F.col("records_before_dedup") - F.col("records_after_dedup"), F.lit(0))
    return totals.withColumn("duplicates_removed", removed).withColumn(
        "duplicate_rate", F.round(pct(F.col("duplicates_removed"), F.col("records_before_dedup")), 2))


def insert_ignore(existing: DataFrame, new: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """The rows of ``new`` whose key the table does not hold; the first row of a repeated key wins.

    The first rows are stored once.  Only the key column of ``existing`` is read.
    It is first cut down to keys that occur in the batch; Spark broadcasts the batch
    keys when their measured size allows it and shuffles both sides otherwise, so
    neither side has to be small.  The result of that cut is never larger than the
    batch.  ``sources.keyed`` opens fewer files of a stored table.
    """
    fresh = stored(dedup_first(new.filter(F.col(key).isNotNull()), key, order), "fresh")
    batch_keys = fresh.select(key)
    present = existing.select(key).join(batch_keys, key, "left_semi").distinct()
    return fresh.join(present, key, "left_anti")


def insert_counts(existing: DataFrame, new: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """One row: rows that would be inserted and rows that would be skipped."""
    inserted = insert_ignore(existing, new, key, order).agg(F.count(F.lit(1))).scalar()
    return (new.agg(F.count(F.lit(1)).alias("processed")).withColumn("inserted", inserted)
            .withColumn("skipped", F.col("processed") - F.col("inserted")))
