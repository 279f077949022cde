"""Append-only log of a table's runs.

A run is there when the log says so: one small file in ``<table>/_log`` names the
data files of the run, their schema, row count, key range and counters.  The name of a log file
begins with the run, so one listing of the log tells all complete runs, and only the
entries that a reader wants are opened.  Entries are written under another name and
renamed, never changed; a repeated run appends an entry and the last one counts.  What
a lost run left behind is named by no entry and read by nobody.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

FOLDER = "_log"


def _open(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def file_names(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names and sizes of the data files of a folder; none if it does not exist."""
    path, fs = _open(spark, folder)
    if not fs.exists(path):
        return {}
    listed = [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(path) if s.isFile()]
    return {name: size for name, size in listed if not name.startswith(("_", "."))}


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _open(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _open(spark, path)
    return fs.exists(hadoop)


def remove_files(spark: SparkSession, folder: str, names: list[str]) -> None:
    for name in names:
        path, fs = _open(spark, f"{folder}/{name}")
        fs.delete(path, False)


def _put(spark: SparkSession, path: str, text: str) -> None:
    hidden, fs = _open(spark, f"{path.rpartition('/')[0]}/.{path.rpartition('/')[2]}.tmp")
    stream = fs.create(hidden, True)
    stream.write(text.encode())
    stream.close()
    if not fs.rename(hidden, spark._jvm.org.apache.hadoop.fs.Path(path)):
        raise IOError(f"could not commit {path}")


def _get(spark: SparkSession, path: str) -> str:
    hadoop, fs = _open(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass(frozen=True)
class Entry:
    """One committed run."""

    run_ts: str
    committed: int
    rows: int | None
    bytes: int
    files: list[str]
    columns: int
    schema: str
    key: str | None = None
    key_min: str | None = None
    key_max: str | None = None
    counters: dict[str, int] = field(default_factory=dict)

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


SCHEMA = ("run_ts string, committed long, rows long, bytes long, files array<string>, columns int, schema string, "
          "key string, key_min string, key_max string, counters map<string,long>")


def commit(spark: SparkSession, base: str, run_ts: str, files: Mapping[str, int], schema: T.StructType, rows: int | None,
           key: str | None = None, low: str | None = None, high: str | None = None, counters: Mapping[str, int] | None = None) -> Entry:
    """Append the entry that makes a run visible."""
    entry = Entry(run_ts, time.time_ns() // 1000, rows, sum(files.values()), sorted(files), len(schema.fields), schema.json(),
                  key, low, high, dict(counters or {}))
    _put(spark, f"{base}/{FOLDER}/{run_ts}.{entry.committed:020d}.json", json.dumps(asdict(entry)))
    return entry


def _newest(spark: SparkSession, base: str) -> dict[str, str]:
    """The last log file of each run, from one listing."""
    found: dict[str, str] = {}
    for name in sorted(file_names(spark, f"{base}/{FOLDER}")):
        run, _, _ = name.rsplit(".", 2)
        found[run] = max(name, found.get(run, ""))
    return found


def has_log(spark: SparkSession, base: str) -> bool:
    return exists(spark, f"{base}/{FOLDER}")


def logged_runs(spark: SparkSession, base: str) -> list[str]:
    return sorted(_newest(spark, base))


def entry(spark: SparkSession, base: str, run_ts: str) -> Entry:
    """The entry of one run; only its file is opened."""
    return Entry(**json.loads(_get(spark, f"{base}/{FOLDER}/{_newest(spark, base)[run_ts]}")))


def entries(spark: SparkSession, base: str) -> DataFrame:
    """The last entry of every run as a table, read by tasks."""
    names = _newest(spark, base)
    if not names:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json([f"{base}/{FOLDER}/{name}" for name in names.values()])


def runs_between(spark: SparkSession, base: str, low, high, kind: str) -> list[str]:
    """Runs whose key range, read as ``kind``, meets [low, high], or that have none."""
    inside = (F.col("key_min").cast(kind) <= F.lit(high).cast(kind)) & (F.col("key_max").cast(kind) >= F.lit(low).cast(kind))
    return sorted(r.run_ts for r in entries(spark, base).filter(inside | F.col("key_min").isNull() & (F.col("key").isNull() | (F.col("rows") > 0))).select("run_ts").collect())
