"""Snapshot tables: one folder per table, one ``run_ts`` partition per run, and a log that says which runs there are."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from opinionlake.functions.timeparts import day_label, week_label
from opinionlake.sources import runlog

# Most rows and characters of one JSON array; a row that is longer alone is an array of its own.
ARRAY_ROWS = 10_000
ARRAY_CHARS = 16_000_000


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def write_table(df: DataFrame, root: str, table: str, run_ts: str, key: str | None = None, counters: Mapping[str, Column] | None = None,
                seen: Mapping[str, Observation] | None = None) -> str:
    """Write one run of a table and commit it to the table's log.

    The rows, the range of ``key`` and the ``counters`` (names to aggregates) are
    counted by the job that writes; ``seen`` are observations of operators
    in ``df``, which that job fills too.  All of them are stored with the run.  A
    run that is repeated replaces its files only after its new entry is committed, so a
    lost commit leaves the old rows; other runs are untouched.
    """
    spark, base = df.sparkSession, table_path(root, table)
    path = f"{base}/run_ts={run_ts}"
    adopt_runs(spark, root, table)
    rows = df.drop("run_ts")
    counted = Observation()
    ends = [F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high")] if key else []
    named = [c.cast("long").alias(f"counter_{name}") for name, c in (counters or {}).items()]
    older = runlog.file_names(spark, path)
    rows.observe(counted, F.count(F.lit(1)).alias("rows"), *ends, *named).write.mode("append").parquet(path)
    found = counted.get
    values = {name: int(found[f"counter_{name}"] or 0) for name in counters or {}}
    for prefix, observation in (seen or {}).items():
        values |= {f"{prefix}.{name}": int(value or 0) for name, value in observation.get.items()}
    files = {name: size for name, size in runlog.file_names(spark, path).items() if name not in older}
    runlog.commit(spark, base, run_ts, files, rows.schema, found["rows"], key, found.get("low"), found.get("high"), values)
    runlog.remove_files(spark, path, list(older))
    return path


def adopt_runs(spark: SparkSession, root: str, table: str) -> None:
    """Commit the complete runs of a table that has no log yet; their rows are not counted."""
    base = table_path(root, table)
    if runlog.has_log(spark, base):
        return
    for run in _unlogged_runs(spark, base):
        path = f"{base}/run_ts={run}"
        runlog.commit(spark, base, run, runlog.file_names(spark, path), spark.read.parquet(path).schema, None)


def write_tables(tables: Mapping[str, DataFrame], root: str, run_ts: str) -> dict[str, str]:
    return {name: write_table(df, root, name, run_ts) for name, df in tables.items()}


append_silver = write_table


def write_bronze(df: DataFrame, root: str, table: str, run_ts: str) -> str:
    """Bronze records as JSON lines under the run's folder."""
    path = f"{table_path(root, table)}/run_ts={run_ts}"
    df.drop("run_ts").write.mode("overwrite").json(path)
    return path


def write_json_arrays(df: DataFrame, path: str) -> str:
    """All rows as JSON arrays, one per file.

    Tasks write their own rows in arrays of bounded size, so there are more files
    when there are more rows, and no rows are shuffled.
    """
    most_rows, most_chars = ARRAY_ROWS, ARRAY_CHARS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # an array grows as UTF-8 in the one buffer that Arrow then takes over: no row is held twice
        held, rows, chars = bytearray(b"["), 0, 0

        def packed() -> pa.RecordBatch:
            held.extend(b"]")
            ends = pa.array([0, len(held)], pa.int32()).buffers()[1]
            return pa.RecordBatch.from_arrays([pa.StringArray.from_buffers(1, ends, pa.py_buffer(held))], names=["value"])

        for batch in batches:
            for row in batch.column(0):
                value = row.as_py()
                if rows and (rows >= most_rows or chars + len(value) > most_chars):
                    yield packed()
                    held, rows, chars = bytearray(b"["), 0, 0
                if rows:
                    held.extend(b",")
                held.extend(value.encode())
                rows += 1
                chars += len(value)
        if rows:
            yield packed()

    arrays = df.select(F.to_json(F.struct(*df.columns)).alias("value")).mapInArrow(run, "value string")
    arrays.write.mode("overwrite").option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header; lists and maps are written as JSON text."""
    flat = df.select(*[
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name)
        for f in df.schema.fields])
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def read_runs(spark: SparkSession, root: str, table: str, runs: list[str], schema: T.StructType | None = None) -> DataFrame:
    """The given runs with their stamp as text, from the files and the schemas that the log names; no footer is merged."""
    base = table_path(root, table)
    if not runlog.has_log(spark, base):
        reader = spark.read.schema(T.StructType([*schema.fields, T.StructField("run_ts", T.StringType())])) if schema is not None else spark.read.option("mergeSchema", True)
        found = reader.option("basePath", base).parquet(*[f"{base}/run_ts={run}" for run in runs])
        return found.withColumn("run_ts", F.col("run_ts").cast("string"))
    known = runlog.entries(spark, base).filter(F.col("run_ts").isin(runs)).orderBy("run_ts").select("run_ts", "files", "schema").collect()
    fields: dict[str, T.StructField] = {}
    for run in known:  # a column has the type of the newest run
        fields |= {f.name: T.StructField(f.name, f.dataType) for f in T.StructType.fromJson(json.loads(run.schema)).fields}
    wanted = T.StructType([f for f in (schema.fields if schema is not None else fields.values()) if f.name != "run_ts"]).add("run_ts", "string")
    files = [f"{base}/run_ts={run.run_ts}/{name}" for run in known for name in run.files]
    return spark.read.schema(wanted).option("basePath", base).parquet(*files) if files else spark.createDataFrame([], wanted)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All complete runs; the stamp stays text."""
    runs = complete_runs(spark, root, table)
    if not runs:
        raise FileNotFoundError(f"no run of {table} under {root}")
    return read_runs(spark, root, table, runs)


def _unlogged_runs(spark: SparkSession, base: str) -> list[str]:
    return sorted(name[7:] for name in runlog.folder_names(spark, base)
                  if name.startswith("run_ts=") and runlog.exists(spark, f"{base}/{name}/_SUCCESS"))


def complete_runs(spark: SparkSession, root: str, table: str) -> list[str]:
    """Stamps of the complete runs in order, from the log; a table without one is listed by folder.  No data is read."""
    base = table_path(root, table)
    return runlog.logged_runs(spark, base) if runlog.has_log(spark, base) else _unlogged_runs(spark, base)


def latest_run(spark: SparkSession, root: str, table: str) -> str | None:
    """Stamp of the newest complete run."""
    return max(complete_runs(spark, root, table), default=None)


def latest(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest complete run of a table; an empty table when there is none.

    One entry of the log is opened, and only that run's files are read.
    """
    run, base = latest_run(spark, root, table), table_path(root, table)
    if run is None:
        if schema is None:
            raise FileNotFoundError(f"no run of {table} under {root}")
        return spark.createDataFrame([], schema)
    if not runlog.has_log(spark, base):
        return spark.read.parquet(f"{base}/run_ts={run}")
    found = runlog.entry(spark, base, run)
    files = [f"{base}/run_ts={run}/{name}" for name in found.files]
    return spark.read.schema(found.struct()).parquet(*files) if files else spark.createDataFrame([], found.struct())


def run_counts(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows, columns, bytes, key range and counters of every run, from the log alone."""
    return runlog.entries(spark, table_path(root, table)).select(
        "run_ts", "rows", "columns", "bytes", "key_min", "key_max", "counters")


def dedup_counts(spark: SparkSession, root: str, before: str, after: str) -> DataFrame:
    """Rows of the newest runs of two tables and the share removed between them, from their logs."""
    def newest(table: str) -> Column:
        return runlog.entries(spark, table_path(root, table)).agg(F.max_by("rows", "run_ts")).scalar()

    totals = spark.range(1).select(newest(before).alias("records_before_dedup"), newest(after).alias("records_after_dedup"))
    removed = F.greatest(F.col("records_before_dedup") - F.col("records_after_dedup"), F.lit(0))
    return totals.withColumn("duplicates_removed", removed).withColumn(
        "duplicate_rate", F.round(F.try_divide(F.col("duplicates_removed") * 100.0, F.col("records_before_dedup")), 2))


def with_day_and_week(gold: DataFrame, ts: str = "published_at") -> DataFrame:
    """Gold base as the trend queries want it."""
    return gold.withColumns({"day": day_label(F.col(ts)), "week": week_label(F.col(ts), "NaT")})


def schema_table(df: DataFrame) -> DataFrame:
    """Column names and types with the row count."""
    cells = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("dtype"))
                      for f in df.schema.fields])
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(cells), "rows")
