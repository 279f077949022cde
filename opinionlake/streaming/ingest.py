"""Structured Streaming: new files only, insert-if-absent, weekly windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from opinionlake.functions.timeparts import week_label
from opinionlake.schemas import BRONZE_PAGE_TEXT, BRONZE_POST
from opinionlake.sources.keyed import BUCKETS, insert_absent


def stream_posts(spark: SparkSession, path: str, max_files: int | None = None, lines: bool = True) -> DataFrame:
    """Post files as they arrive, JSON lines or arrays; the checkpoint remembers files, so late ones are read too."""
    return _stream(spark, path, BRONZE_POST, max_files, lines)


def stream_pages(spark: SparkSession, path: str, max_files: int | None = None, lines: bool = True) -> DataFrame:
    return _stream(spark, path, BRONZE_PAGE_TEXT, max_files, lines)


def _stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None, lines: bool) -> DataFrame:
    reader = spark.readStream.schema(schema).option("multiLine", not lines)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_file_block(reader.json(path))


def with_file_block(stream: DataFrame) -> DataFrame:
    """File name and split start; the row number is added per batch (a stream cannot number rows)."""
    return stream.select("*", F.col("_metadata.file_name").alias("bronze_source"),
                         F.col("_metadata.file_block_start").alias("_file_block"))


def insert_batch(target: str, key: str, order: Sequence[str], transform: Callable[[DataFrame], DataFrame] | None = None,
                 buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that adds the rows whose key the table lacks.

    Every batch owns the folder ``run_ts=batch_<id>``, in the layout of any other
    stored table, so a table of ``write_table`` can be added to.  Only files of the
    table's key index that may hold a key of the batch are opened.  A batch that is
    repeated after a lost executor or driver compares with the other complete runs
    only and overwrites its own, so the table ends up the same.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if "_file_block" in batch.columns:
            position = F.struct("_file_block", F.monotonically_increasing_id())
            batch = batch.withColumn("row_order", position).drop("_file_block")
        rows = transform(batch) if transform else batch
        root, _, table = target.rstrip("/").rpartition("/")
        insert_absent(rows, root, table, f"batch_{batch_id:012d}", key, order, buckets)

    return write


def run_insert(stream: DataFrame, target: str, checkpoint: str, key: str = "url",
               order: Sequence[str] = ("bronze_source", "row_order"),
               transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Process everything that is there, then stop."""
    query = (stream.writeStream.foreachBatch(insert_batch(target, key, order, transform))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def weekly_counts(stream: DataFrame, ts: str = "published_at", by: str = "source", value: str | None = None,
                  late: str = "7 days", mean: str = "compound_mean") -> DataFrame:
    """Rows (and the mean of a score) per Monday week and source, with a bound on lateness."""
    aggregates = [F.count(F.lit(1)).alias("n_records")]
    if value:
        aggregates.append(F.round(F.avg(value), 4).alias(mean))
    # windows count from 1970-01-01, a Thursday: four days later starts them on Mondays
    windows = F.window(ts, "7 days", startTime="4 days").alias("w")
    return (stream.withWatermark(ts, late).groupBy(windows, by).agg(*aggregates)
            .select(week_label(F.col("w.start")).alias("week"), by, *[a for a in ["n_records", *([mean] if value else [])]]))


def dedup_stream(stream: DataFrame, key: str = "url", ts: str = "published_at", late: str = "7 days") -> DataFrame:
    """One row per key within the lateness bound; use run_insert for keys that may return at any time."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def run_dedup(stream: DataFrame, target: str, checkpoint: str, key: str = "url", ts: str = "published_at", late: str = "7 days") -> None:
    """Append the first row of each key to a folder of Parquet files, process what is there, then stop.

    A key is remembered until the stream's time has passed its row by ``late``; rows
    that are later than that are dropped.  Keys and files are kept below
    ``checkpoint``, so a stopped or lost run goes on where it was.
    """
    query = (dedup_stream(stream, key, ts, late).writeStream.format("parquet").outputMode("append")
             .option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
