"""Bronze and silver sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinionlake import schemas
from opinionlake.fixed import FIRST_RUN, POST_SITE
from opinionlake.functions.text import meta_from_text, post_url
from opinionlake.operators.conform import conform, keep_language
from opinionlake.operators.dedup import dedup_first
from opinionlake.operators.language import detect_language
from opinionlake.sources.tables import complete_runs, read_runs

_STAMP = r"(\d{8}_\d{6})"


def file_stamp(name: Column) -> Column:
    """``yyyymmdd_hhmmss`` out of a file name; a fixed first stamp when there is none."""
    found = F.regexp_extract(name, _STAMP, 1)
    return F.when(found == "", FIRST_RUN).otherwise(found)


def family(name: Column) -> Column:
    """File name without run stamp and suffix."""
    return F.regexp_replace(name, r"_\d{8}_\d{6}\.parquet$", "")


def with_file_position(df: DataFrame) -> DataFrame:
    """Add the file name and the row's position in its file.

    The position is the start of the file split, then the row number in the
    split, so it also holds for a large file that several tasks read.
    """
    return df.select("*", F.col("_metadata.file_name").alias("bronze_source"),
                     F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("row_order"))


def read_posts(spark: SparkSession, path: str | list[str], lines: bool = True) -> DataFrame:
    """Post records from JSON lines, as ``write_bronze`` writes them, or from JSON arrays (``lines=False``).

    Fields that older files lack are null.
    """
    return with_file_position(spark.read.schema(schemas.BRONZE_POST).option("multiLine", not lines).json(path))


def read_pages(spark: SparkSession, path: str | list[str], fmt: str = "json", lines: bool = True) -> DataFrame:
    """Page records from JSON lines, JSON arrays (``lines=False``) or the CSV form."""
    if fmt == "json":
        raw = spark.read.schema(schemas.BRONZE_PAGE_TEXT).option("multiLine", not lines).json(path)
    elif fmt == "csv":
        raw = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path))
    else:
        raise ValueError(f"unsupported format: {fmt}")
    return parse_pages(with_file_position(raw))


def parse_pages(raw: DataFrame) -> DataFrame:
    """Lists and the metadata map out of their text forms (JSON, or a Python literal)."""
    def column(name: str, dtype) -> Column:
        if name not in raw.columns:
            return F.lit(None).cast(dtype).alias(name)
        text = F.col(name)
        kind = dtype.simpleString()
        if kind == "array<string>":
            return F.from_json(text, dtype, {"allowSingleQuotes": "true"}).alias(name)
        if kind == "map<string,string>":
            return meta_from_text(text).alias(name)
        return text.alias(name)

    return raw.select(*[column(f.name, f.dataType) for f in schemas.BRONZE_PAGE.fields],
                      *[c for c in ("bronze_source", "row_order") if c in raw.columns],
                      *([F.col("all_meta").isNotNull().alias("_has_meta")] if "all_meta" in raw.columns else []))


def unparsed_metas(pages: DataFrame) -> DataFrame:
    """One row: pages whose metadata text could not be read."""
    return pages.agg(F.count(F.when(F.col("_has_meta") & F.col("all_meta").isNull(), 1)).alias("unparsed"))


def read_silver(spark: SparkSession, path: str, prefix: str, schema=None) -> DataFrame:
    """All silver files of one source; an empty table when there is none.

    Only complete runs are read.  A declared schema fills the columns that older
    runs lack; without one the columns of all runs are merged.
    """
    runs = complete_runs(spark, path, prefix)
    if not runs:
        if schema is None:
            raise FileNotFoundError(f"no run of {prefix} under {path}")
        return spark.createDataFrame([], schema)
    table = read_runs(spark, path, prefix, runs, schema)
    return conform(table, schema) if schema is not None else table


def read_silver_files(spark: SparkSession, path: str, prefix: str, schema=None) -> DataFrame:
    """Same for a flat folder of ``<prefix>_<stamp>.parquet`` files."""
    table = (spark.read.option("mergeSchema", True).option("pathGlobFilter", f"{prefix}_*.parquet").parquet(path))
    return conform(table, schema) if schema is not None else table


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder: name, family, size in KB, modification time."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
             .load(path).select("path", "length", "modificationTime"))
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("file"), family(name).alias("family"),
                        F.round(F.col("length") / 1024, 1).alias("size_kb"), F.col("modificationTime").alias("modified"))


def inventory_totals(inv: DataFrame) -> DataFrame:
    return inv.agg(F.count(F.lit(1)).alias("files"), F.countDistinct("family").alias("families"))


# --- API payload ------------------------------------------------------------
def flatten_payload(payload: DataFrame, query: str, retrieved_at: str, site: str = POST_SITE,
                    wanted: str | None = "en", order: tuple[str, ...] = ("bronze_source",)) -> DataFrame:
    """Nested API answers to post records: absolute url, first per url in a batch, wanted language only."""
    posts = payload.select(*order, F.posexplode("data.children").alias("position", "child")).select(
        *order, "position", "child.data.*")
    records = posts.withColumns({
        "url": post_url(F.col("permalink"), F.col("url"), site),
        "title": F.coalesce("title", F.lit("")), "selftext": F.coalesce("selftext", F.lit("")),
        "api_query": F.lit(query), "retrieved_at": F.lit(retrieved_at)})
    first = dedup_first(records, [*order, "url"], ["position"])
    text = F.trim(F.concat_ws(" ", "title", "selftext"))
    tagged = first.withColumn("lang", detect_language(text))
    kept = keep_language(tagged, "lang", wanted) if wanted else tagged
    return kept.select(*[f.name for f in schemas.BRONZE_POST.fields], *order, F.col("position").alias("row_order"))


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    return with_file_position(spark.read.schema(schemas.API_PAYLOAD).option("multiLine", True).json(path))


# --- incremental discovery --------------------------------------------------
def pending(df: DataFrame, mark: str, lineage: str = "bronze_source", latest_only: bool = False) -> DataFrame:
    """Rows of files newer than the mark; ``latest_only`` keeps the newest of those files."""
    stamped = df.withColumn("_stamp", file_stamp(F.col(lineage))).filter(F.col("_stamp") > mark)
    if latest_only:
        newest = stamped.agg(F.max(F.struct("_stamp", lineage)).alias("m")).select(F.col(f"m.{lineage}")).scalar()
        stamped = stamped.filter(F.col(lineage) == newest)
    return stamped.drop("_stamp")


class NoSourceFile(FileNotFoundError):
    """There is no file at all, new or old."""


def pending_paths(spark: SparkSession, folder: str, mark: str, pattern: str = "*.json", latest_only: bool = False,
                  by_folder: bool = False) -> list[str]:
    """Paths of files whose stamp is newer than the mark, from the listing alone; no file is opened.

    An empty list means that nothing is new.  Without any file ``NoSourceFile`` is
    raised.  The list has one name per new file.  ``by_folder`` takes the stamp from
    anywhere in the path, for runs that have a folder each.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
             .load(folder).select("path"))
    stamped = files.withColumn("stamp", file_stamp(F.col("path") if by_folder else F.element_at(F.split("path", "/"), -1)))
    found = stamped.filter(F.col("stamp") > mark).orderBy("stamp", "path").collect()
    if not found and not files.limit(1).count():
        raise NoSourceFile(f"no {pattern} under {folder}")
    return [row["path"] for row in (found[-1:] if latest_only else found)]


def save_mark(spark: SparkSession, root: str, name: str, mark: str) -> None:
    """Store the mark of a source; to be called after its batch is saved.  Marks never go back."""
    known = read_mark(spark, root, name)
    value = max(mark, known)
    spark.createDataFrame([(name, value)], "source string, mark string").coalesce(1).write.mode("overwrite").parquet(
        f"{root.rstrip('/')}/marks/source={name}/mark={value}")


def read_mark(spark: SparkSession, root: str, name: str) -> str:
    """The highest stored mark of a source; a fixed first one when there is none."""
    try:
        stored = spark.read.schema("source string, mark string").option("recursiveFileLookup", True).parquet(
            f"{root.rstrip('/')}/marks/source={name}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return FIRST_RUN
    return stored.agg(F.max("mark")).first()[0] or FIRST_RUN


def high_mark(df: DataFrame, lineage: str = "bronze_source") -> DataFrame:
    """One row: the highest file stamp in the batch."""
    return df.agg(F.coalesce(F.max(file_stamp(F.col(lineage))), F.lit(FIRST_RUN)).alias("mark"))
