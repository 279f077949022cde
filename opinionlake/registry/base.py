"""What a registered query is, and how it reads a table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from opinionlake.session import scratch_folder as scratch


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


# Text tables: every row costs far more CPU than IO.
_TEXT_TABLES = ("documents", "pages", "conversations")
# Into how many tasks text tables are dealt; unset, as on a cluster, a table is read as it is stored.
DEAL = "spark.opinionlake.dealTextTables"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table.

    The small test files are single row groups, which only one task can read; who
    runs them on many cores may ask for their rows to be dealt out (``DEAL``).
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get(DEAL, None)
    return df.repartition(int(parts)) if parts and name in _TEXT_TABLES else df
