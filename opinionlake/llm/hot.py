"""Joins of rows with one record per key, where a few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SHARE = 1000


def attach(rows: DataFrame, records: DataFrame, on: str, copies: str) -> DataFrame:
    """Left join of ``rows`` with the one record of each key; ``copies`` is the number of rows of the key.

    A key with over a thousandth of all rows is hot.  There are fewer than a thousand
    of them, so their records are broadcast and their rows stay where they are; all
    other rows meet their records in a shuffle in which no key is large.  A null key
    meets no record.
    """
    total = records.agg(F.sum(copies).alias("n")).first().n or 0
    hot = F.col(copies) * SHARE > F.lit(total)
    few = F.broadcast(records.filter(hot))
    rest = rows.join(few.select(on), on, "left_anti")
    known = rest.filter(F.col(on).isNotNull()).join(records.filter(~hot), on, "left")
    added = [f for f in records.schema.fields if f.name != on]
    none = rest.filter(F.col(on).isNull()).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    return rows.join(few, on, "inner").unionByName(known).unionByName(none)
