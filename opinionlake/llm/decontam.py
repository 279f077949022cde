"""Benchmark decontamination by a prefix-filtered set join.

A window is ten consecutive words of an item (all words of a shorter item).  Its
shingles of three words are ordered by how often they occur in the corpus.  A
document can hold the window only if it holds every shingle, so a prefix of one,
the rarest, finds all candidates; its place gives the window's start, which must
lie inside the document.  A candidate counts if all its shingles stand at their
places, which is exact containment of the window.

Words are runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after lower-casing A-Z; a null text
has none.  Rows are told apart by document id and text: equal rows get equal
results, rows that share only the id are judged alone.  Without items, or with
items that have no words, nothing is hit; an empty documents table gives no rows.  The
words of an item without an id are hit like any other's, but it is neither counted nor
listed.  Texts are read whole, however long; an array of a text's words is held in its
row.  ``clean`` carries columns of any name and type, ``decontaminate`` reads id and text.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
# Shingles of the items are broadcast up to this size; beyond it Spark joins by shuffle.
BROADCAST_BYTES = 48 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
_ROW = ["_r1", "_r2"]


def _words(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    # lower() would change letters beyond A-Z too, so it is for texts that have none
    lowered = F.when(F.octet_length(whole) == F.length(whole), F.lower(whole)).otherwise(
        F.translate(whole, string.ascii_uppercase, string.ascii_lowercase))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def row_keys(key: str, text: str) -> dict[str, Column]:
    """128 bits that tell rows apart by id and text."""
    return {"_r1": F.xxhash64(F.col(key), F.col(text)), "_r2": F.xxhash64(F.lit(1), F.col(text), F.col(key))}


def _shingles(words: Column, n: int) -> Column:
    """The shingles of ``n`` words with their places."""
    at = lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(n)])
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(0), F.size(words) - n), lambda i: F.struct(i.alias("pos"), at(i).alias("shingle"))))


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows with their words, and the items that have them one by one: (window, words, item)."""
    split = items.select(F.col(key).alias("item"), _words(F.col(text)).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (WINDOW_WORDS - 1)))
    each = split.select("item", F.explode(F.transform(starts, lambda s: F.slice("words", s, WINDOW_WORDS))).alias("words"))
    return each.select(F.array_join("words", " ").alias("window"), "words", "item").distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """Every window's shingles with their places: (window, n_words, need, pos, shingle)."""
    size = F.size("words")
    shingles = F.when(size >= SHINGLE_WORDS, _shingles(F.col("words"), SHINGLE_WORDS)).otherwise(
        F.array(F.struct(F.lit(0).alias("pos"), F.col("window").alias("shingle"))))
    one = windows.select("window", "words").distinct()
    return one.select("window", size.alias("n_words"), F.size(shingles).alias("need"), F.inline(shingles))


def occurrences(spark: SparkSession, docs: DataFrame, items: DataFrame, root: str, key: str = "doc_id", text: str = "text",
                item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Windows found in documents: (_r1, _r2, start, n_words, window, item)."""
    item_windows(items, item_key, item_text).write.mode("overwrite").parquet(f"{root}/windows")
    windows = spark.read.parquet(f"{root}/windows")
    shingles = window_shingles(windows)
    vocabulary = shingles.select("shingle", F.least("n_words", F.lit(SHINGLE_WORDS)).alias("size")).distinct()
    sizes = vocabulary.groupBy("size").agg(F.sum(F.octet_length("shingle") + 64).alias("bytes")).collect()
    small = sum(row["bytes"] for row in sizes) <= BROADCAST_BYTES

    source = docs.select(*[column.alias(name) for name, column in row_keys(key, text).items()], _words(F.col(text)).alias("words"))
    found = None
    for n in sorted(row["size"] for row in sizes) or [SHINGLE_WORDS]:
        wanted = vocabulary.filter(F.col("size") == n).select("shingle")
        placed = source.select(*_ROW, F.size("words").alias("length"), F.inline(_shingles(F.col("words"), n)))
        part = placed.join(F.broadcast(wanted) if small else wanted, "shingle")
        found = part if found is None else found.unionByName(part)
    found.write.mode("overwrite").parquet(f"{root}/hits")
    hits = spark.read.schema("shingle string, _r1 long, _r2 long, length int, pos int").parquet(f"{root}/hits")

    counts = hits.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    rarest = Window.partitionBy("window").orderBy("n", "shingle", "pos")
    # a window with a shingle that occurs nowhere cannot be found: the left join's null marks it
    prefix = (shingles.join(counts, "shingle", "left")
              .withColumn("_all", F.count("n").over(Window.partitionBy("window")) == F.col("need"))
              .withColumn("_rank", F.row_number().over(rarest)).filter("_all AND _rank = 1")
              .select("shingle", "window", F.col("n_words").alias("span"), "need", F.col("pos").alias("offset")))
    start = F.col("pos") - F.col("offset")
    candidates = (hits.join(prefix, "shingle").withColumn("start", start)
                  .filter((F.col("start") >= 0) & (F.col("start") + F.col("span") <= F.col("length")))
                  .select(*_ROW, "start", "span", "need", "window"))
    places = shingles.select("window", F.col("pos").alias("offset"), "shingle")
    needed = candidates.join(places, "window").select(
        *_ROW, (F.col("start") + F.col("offset")).alias("pos"), "shingle", "start", "span", "need", "window")
    # an equal row's hits are listed twice, so each place counts once
    there = hits.select(*_ROW, "pos", "shingle").distinct()
    verified = (needed.distinct().join(there, [*_ROW, "pos", "shingle"], "left_semi")
                .groupBy(*_ROW, "start", "span", "need", "window").agg(F.count(F.lit(1)).alias("_n")).filter("_n = need"))
    return verified.select(*_ROW, "start", F.col("span").alias("n_words"), "window")


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame, root: str, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: ``key`` and ``RESULTS``; intermediate tables go below ``root``."""
    occurrences(spark, docs, items, root, key, text, item_key, item_text).write.mode("overwrite").parquet(f"{root}/found")
    found = spark.read.parquet(f"{root}/found")
    windows = spark.read.parquet(f"{root}/windows")
    # words covered by the union of the windows: each adds what reaches beyond all earlier ones
    spans = found.groupBy(*_ROW, "start").agg(F.max(F.col("start") + F.col("n_words")).alias("end"))
    before = Window.partitionBy(*_ROW).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0)))
    covered = (spans.withColumn("_new", F.greatest(F.col("end") - reach, F.lit(0)))
               .groupBy(*_ROW).agg(F.sum("_new").alias("n_hit")))
    pairs = found.select(*_ROW, "window").distinct().join(windows.select("window", "item"), "window").select(*_ROW, "item").distinct()
    named = F.sort_array(F.collect_list(F.col("item").cast("string")))
    listed = pairs.groupBy(*_ROW).agg(F.count("item").alias("n_items"), F.sha2(F.array_join(named, ","), 256).alias("items_sha256"))
    rows = docs.select(F.col(key), *[column.alias(name) for name, column in row_keys(key, text).items()],
                       F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(_WORD_ANY_CASE)).cast("long").alias("n_words"))
    joined = rows.join(covered.join(listed, _ROW), _ROW, "left")
    return joined.select(
        key, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame, root: str, key: str = "doc_id", text: str = "text",
          item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without a window of any item, with all their columns."""
    hit = occurrences(spark, docs, items, root, key, text, item_key, item_text).select(*_ROW).distinct()
    # whole rows travel as one struct, so no column of theirs can clash
    keyed = docs.select(F.struct(*docs.columns).alias("document"), *[column.alias(name) for name, column in row_keys(key, text).items()])
    return keyed.join(hit, _ROW, "left_anti").select("document.*")
