"""Schema conformance, filters and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from opinionlake.functions.text import meta_get


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    Absent columns become typed nulls; text that cannot be read as the wanted
    type becomes null.
    """
    def column(field: T.StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        have = df.schema[field.name].dataType
        col = F.col(f"`{field.name}`")
        if have != field.dataType:
            col = col.try_cast(field.dataType) if isinstance(have, T.StringType) else col.cast(field.dataType)
        return col.alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def union_sources(*dfs: DataFrame) -> DataFrame:
    """Union by name; columns one side lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def tag_source(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("source", F.lit(source))


def with_lineage(df: DataFrame, name: str = "bronze_source") -> DataFrame:
    """Name of the file each row was read from."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def drop_null_keys(df: DataFrame, key: str = "url") -> DataFrame:
    return df.dropna(subset=[key])


def keep_language(df: DataFrame, lang: str, wanted: str = "en") -> DataFrame:
    return df.filter(F.coalesce(F.nullif(F.trim(F.col(lang)), F.lit("")), F.lit("unknown")) == wanted)


def scope(df: DataFrame, source: str = "all", by: str = "source") -> DataFrame:
    return df if source in (None, "", "all") else df.filter(F.col(by) == source)


def dated(df: DataFrame, ts: str) -> DataFrame:
    return df.filter(F.col(ts).isNotNull())


def meta_fields(df: DataFrame, meta: str, fields: dict[str, str]) -> DataFrame:
    """Add one column per ``{name: metadata key}``."""
    return df.withColumns({name: meta_get(F.col(meta), key) for name, key in fields.items()})


def fill_unmatched(df: DataFrame, label: str = "sentiment_mode", score: str = "compound_mean") -> DataFrame:
    return df.na.fill({label: "neutral", score: 0.0})


def filter_counts(df: DataFrame, predicate: Column, name: str = "filter") -> tuple[DataFrame, Observation]:
    """Filter, and count kept and skipped rows in the same job that reads the result."""
    seen = Observation(name)
    passed = F.coalesce(predicate, F.lit(False))
    # the flag is a column so that the filter stays above the counting node
    flagged = df.withColumn("_passed", passed).observe(
        seen,
        F.sum(F.when(F.col("_passed"), 1).otherwise(0)).alias("kept"),
        F.sum(F.when(F.col("_passed"), 0).otherwise(1)).alias("skipped"),
    )
    return flagged.filter("_passed").drop("_passed"), seen


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach counters that are filled by the job that reads ``df`` next; ``write_table`` stores them with the run."""
    seen = Observation(name)
    columns = [F.count(F.lit(1)).alias("rows")] + [m.alias(k) for k, m in metrics.items()]
    return df.observe(seen, *columns), seen
