"""Key index of a stored table: which files may hold a key.

Every run of a table has its keys in files of their own, one for each bucket of a hash
of the key, and a Bloom filter for each of those files.  A batch asks the filters
of the buckets that its keys fall into and opens only the files that may hold one of
them; a filter never misses a key that is there.  Keys and filters are written before
the run, so a run that is complete has them, and what a failed run left is not read.

Null keys are not stored.  A filter has at most ``MOST_BITS`` bits; a larger file is
only asked for more often than needed.  ``buckets`` belongs to the table: choose it so
that a bucket of the whole table's keys suits one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from opinionlake.operators.dedup import dedup_first
from opinionlake.session import stored
from opinionlake.sources import runlog
from opinionlake.sources.tables import complete_runs, read_runs, table_path, write_table

BUCKETS = 16
HASHES = 7
BITS_PER_KEY = 10
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 26
ASKED_AT_ONCE = 1 << 16
_FILTERS = "bucket int, n long, bits long, filter binary"
_U = np.uint64


def _keys_path(root: str, table: str, run: str) -> str:
    return f"{table_path(root, table)}/_keys/run_ts={run}"


def _filters_path(root: str, table: str, run: str) -> str:
    return f"{table_path(root, table)}/_filters/run_ts={run}"


def _hashed(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """Key, its bucket and two hashes; null keys are left out."""
    first, second = F.xxhash64(key), F.xxhash64(F.col(key), F.lit(1))
    return rows.filter(F.col(key).isNotNull()).select(
        key, F.pmod(F.xxhash64(F.col(key), F.lit(2)), F.lit(buckets)).cast("int").alias("bucket"), first.alias("h1"), second.alias("h2"))


def _positions(h1: np.ndarray, h2: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers of each key: a row for each hash."""
    turns = np.arange(HASHES, dtype=_U)[:, None]
    return (h1.view(_U)[None, :] + turns * (h2.view(_U) | _U(1))[None, :]) & _U(bits - 1)


def _bits_for(keys: int) -> int:
    return min(max(1 << math.ceil(math.log2(max(BITS_PER_KEY * keys, 1))), LEAST_BITS), MOST_BITS)


def _filter_rows(hashed: DataFrame) -> DataFrame:
    """One filter for each bucket; a task holds the filter of one bucket at a time."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, n, made = None, 0, np.zeros(0, np.uint8)

        def close() -> pa.RecordBatch:
            row = {"bucket": bucket, "n": n, "bits": len(made), "filter": np.packbits(made, bitorder="little").tobytes()}
            return pa.RecordBatch.from_pylist([row], pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("bits", pa.int64()), ("filter", pa.binary())]))

        for batch in batches:
            buckets, sizes, h1, h2 = (c.to_numpy() for c in batch.columns)
            cuts = [0, *(np.flatnonzero(buckets[1:] != buckets[:-1]) + 1).tolist(), len(buckets)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if buckets[a] != bucket:
                    if bucket is not None:
                        yield close()
                    bucket, n, made = int(buckets[a]), 0, np.zeros(_bits_for(int(sizes[a])), np.uint8)
                made[_positions(h1[a:b], h2[a:b], len(made)).ravel()] = 1
                n += b - a
        if bucket is not None:
            yield close()

    sizes = hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    sized = hashed.join(F.broadcast(sizes), "bucket")  # one row for each bucket
    return (sized.select("bucket", "size", "h1", "h2").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _FILTERS))


def index_run(rows: DataFrame, root: str, table: str, run: str, key: str, buckets: int = BUCKETS) -> None:
    """Store keys and filters of a run, to be called before the run is written."""
    spark, keys = rows.sparkSession, _keys_path(root, table, run)
    hashed = _hashed(rows.select(key), key, buckets)
    hashed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(keys)
    written = spark.read.schema(T.StructType([f for f in hashed.schema.fields if f.name != "bucket"] + [hashed.schema["bucket"]])).parquet(keys)
    _filter_rows(written).write.mode("overwrite").parquet(_filters_path(root, table, run))


def index_missing(spark: SparkSession, root: str, table: str, key: T.StructField, runs: list[str], buckets: int = BUCKETS) -> None:
    """Index the runs that were written without an index; each is read once."""
    for run in runs:
        if not runlog.exists(spark, f"{_filters_path(root, table, run)}/_SUCCESS"):
            rows = read_runs(spark, root, table, [run], T.StructType([key]))
            index_run(rows, root, table, run, key.name, buckets)


def files_to_open(asked: DataFrame, root: str, table: str, runs: list[str], key: str, buckets: int = BUCKETS) -> list[str]:
    """Folders of keys, one for a run's bucket, that may hold one of the asked keys."""
    spark = asked.sparkSession
    hashed = stored(_hashed(asked.select(key), key, buckets).select("bucket", "h1", "h2"), "asked_keys")
    # a bucket's keys go to its filters in lots of bounded size
    lots = max(1, math.ceil(hashed.count() / buckets / ASKED_AT_ONCE))
    lot = F.pmod(F.col("h1"), F.lit(lots)).alias("lot")
    packed = hashed.groupBy("bucket", lot).agg(F.collect_list("h1").alias("h1"), F.collect_list("h2").alias("h2"))
    filters = (spark.read.option("basePath", f"{table_path(root, table)}/_filters").schema(f"{_FILTERS}, run_ts string")
               .parquet(*[_filters_path(root, table, run) for run in runs]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for row in range(batch.num_rows):
                bits, packed_filter = batch.column("bits")[row].as_py(), batch.column("filter")[row].as_buffer()
                h1, h2 = (batch.column(c)[row].values.to_numpy() for c in ("h1", "h2"))
                at = _positions(h1, h2, bits)
                held = np.frombuffer(packed_filter, np.uint8)[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8) & 1
                hit.append(bool(held.all(axis=0).any()))
            yield pa.RecordBatch.from_arrays([batch.column("run_ts"), batch.column("bucket")], names=["run_ts", "bucket"]).filter(pa.array(hit, pa.bool_()))

    found = filters.join(packed, "bucket").mapInArrow(run, "run_ts string, bucket int").distinct().orderBy("run_ts", "bucket").collect()
    return [f"{_keys_path(root, table, r.run_ts)}/bucket={r.bucket}" for r in found]


def known_keys(asked: DataFrame, root: str, table: str, runs: list[str], key: str, buckets: int = BUCKETS) -> DataFrame:
    """Keys in the files that may hold an asked one; no other file is opened."""
    spark, schema = asked.sparkSession, T.StructType([asked.schema[key]])
    index_missing(spark, root, table, asked.schema[key], runs, buckets)
    paths = files_to_open(asked, root, table, runs, key, buckets) if runs else []
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def insert_absent(rows: DataFrame, root: str, table: str, run: str, key: str, order: list, buckets: int = BUCKETS) -> None:
    """Write as one run the rows whose key no other complete run has; the first row of a repeated key wins.

    Repeating a run compares with the others only and overwrites what it wrote.
    """
    spark = rows.sparkSession
    others = [r for r in complete_runs(spark, root, table) if r != run]
    fresh = stored(dedup_first(rows.filter(F.col(key).isNotNull()), key, order), "fresh")
    known = known_keys(fresh, root, table, others, key, buckets)
    new = fresh.join(known.join(fresh.select(key), key, "left_semi").distinct(), key, "left_anti")
    index_run(new, root, table, run, key, buckets)
    write_table(new.drop("row_order"), root, table, run, key)
