"""Sources, sinks, incremental reading and streaming over data derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from opinionlake import fixed
from opinionlake.functions.text import is_blank
from opinionlake.operators.conform import keep_language, observed
from opinionlake.operators.dedup import dedup_first, insert_counts, insert_ignore
from opinionlake.operators.html import extract_pages
from opinionlake.plans.silver import silver_articles, silver_posts
from opinionlake.registry.base import Query, scratch, table
from opinionlake.registry.views import sql_clean, values
from opinionlake.session import stored
from opinionlake.sources import readers as R
from opinionlake.sources import runlog
from opinionlake.sources import tables as S
from opinionlake.streaming import ingest as I


def _bronze_posts(spark, sf):
    """Raw post records out of documents and events; scores are text and partly unreadable."""
    e = table(spark, sf, "events").select("event_id", "ts", "event_type", "value", "props")
    d = table(spark, sf, "documents").join(e, F.col("event_id") == F.col("doc_id") * 10, "left")
    return d.select(
        F.lit("q").alias("api_query"), F.concat(F.lit("https://posts.example/"), F.md5(F.col("text").cast("binary"))).alias("url"),
        F.lit("").alias("permalink"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("selftext"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("author"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("score"),
        F.get_json_object("props", "$.k").alias("num_comments"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string").alias("created_utc"),
        F.col("source").alias("subreddit"), F.lit("2024-02-01T00:00:00").alias("retrieved_at"), "lang", "doc_id")


def bronze_roundtrip(spark, sf):
    """Bronze posts written as JSON and read back with the declared schema."""
    root = scratch(spark, "bronze")
    S.write_bronze(_bronze_posts(spark, sf), root, "posts", "20240201_000000")
    back = R.read_posts(spark, f"{root}/posts", lines=True)
    return back.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("urls"), F.sum(F.length("selftext")).alias("chars"),
        F.count(F.col("score").try_cast("double")).alias("scores"), F.count("author").alias("authors"))


def lineage_positions(spark, sf):
    """Every row read back has a file name and a position of its own in that file."""
    root = scratch(spark, "lineage")
    S.write_bronze(_bronze_posts(spark, sf).select("url", "lang", "title").repartition(3), root, "posts", "20240201_000000")
    back = R.read_posts(spark, f"{root}/posts")
    named = F.when(F.endswith("bronze_source", F.lit(".json")) & ~F.contains("bronze_source", F.lit("/")), 1)
    return back.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count(named).alias("named"),
                                    F.countDistinct("bronze_source", "row_order").alias("positions"))


def silver_posts_table(spark, sf):
    """Bronze posts to silver: dedup per batch, capping per batch, cleaning."""
    bronze = _bronze_posts(spark, sf).withColumns({"bronze_source": F.concat("lang", F.lit(".json")), "row_order": F.col("doc_id")})
    out = silver_posts(bronze, ["row_order"])
    return out.select("url", "title", "author", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"),
                      "body_text_clean", "body_text_missing", F.round("score", 4).alias("score"),
                      F.round("num_comments", 4).alias("num_comments"), "subreddit", "source", "bronze_source")


def _bronze_articles(spark, sf):
    """Page records out of documents: metadata map, paragraphs by line."""
    e = table(spark, sf, "events").select("event_id", "ts", "event_type")
    d = table(spark, sf, "documents").join(e, F.col("event_id") == F.col("doc_id") * 10, "left")
    iso = F.when(F.col("event_type") != "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    minutes = F.when(F.col("event_type") != "error", F.concat(F.ceil(F.col("n_chars") / 1000).cast("string"), F.lit(" minutes")))
    meta = F.map_filter(F.create_map(
        F.lit(fixed.META_TITLE), F.substring_index("text", "\n", 1), F.lit(fixed.META_PUBLISHED), iso,
        F.lit(fixed.META_READING_TIME), minutes), lambda k, v: v.isNotNull())
    return d.select(
        F.concat(F.lit("https://news.example/"), F.md5(F.col("text").cast("binary"))).alias("url"), meta.alias("all_meta"),
        F.split("text", "\n").alias("p_all_texts"), F.date_format("ts", "d/M/yyyy").alias("published_time"),
        F.concat("source", F.lit(".json")).alias("bronze_source"), F.col("doc_id").alias("row_order"))


def silver_articles_table(spark, sf):
    out = silver_articles(_bronze_articles(spark, sf), ["row_order"])
    return out.select("url", "title", "author", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"),
                      F.round("reading_time_min", 4).alias("reading_time_min"), "body_text", "body_text_missing", "source", "bronze_source")


def csv_roundtrip(spark, sf):
    """Page records written as CSV (lists and maps as text) and read back."""
    path = scratch(spark, "csv")
    pages = extract_pages(table(spark, sf, "pages")).drop("time_all")
    S.write_csv(pages, path)
    back = R.read_pages(spark, path, "csv")
    return back.select("url", F.size("all_hrefs").cast("long").alias("n_hrefs"), F.size("h1_all_texts").cast("long").alias("n_h1"),
                       F.array_join("all_classes", " ").alias("classes"))


def latest_snapshot(spark, sf):
    """Two runs of a table; the newest one is read."""
    root = scratch(spark, "runs")
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    S.write_table(counts.withColumn("n", F.col("n") * 2), root, "counts", "20240101_000000")
    S.write_table(counts, root, "counts", "20240108_000000")
    return S.latest(spark, root, "counts")


def snapshot_inventory(spark, sf):
    """Families and runs of the stored aggregate tables."""
    root = scratch(spark, "inventory")
    e = table(spark, sf, "events")
    tables = {"by_type": e.groupBy("event_type").count(), "by_user": e.groupBy("user_id").count()}
    for run in ("20240101_000000", "20240108_000000"):
        S.write_tables(tables, root, run)
    return S.run_counts(spark, root, "by_user").select("run_ts", "rows", F.col("columns").alias("schema_cols"))


def logged_dedup(spark, sf):
    """Row totals before and after the deduplication, from the logs of two stored tables."""
    root = scratch(spark, "logged")
    posts = _bronze_posts(spark, sf).select("url", "lang", "doc_id")
    S.write_table(posts, root, "before", "20240101_000000", "url")
    S.write_table(dedup_first(posts, "url", ["doc_id"]), root, "after", "20240101_000000", "url")
    return S.dedup_counts(spark, root, "before", "after")


def runs_by_key_range(spark, sf):
    """Runs of consecutive events; the log tells which of them hold a wanted range of ids, and only those are read."""
    root = scratch(spark, "ranges")
    rows = table(spark, sf, "events").select("event_id", "event_type")
    first, last = rows.agg(F.min("event_id"), F.max("event_id")).first()
    part = F.floor((F.col("event_id") - first) * 6 / (last - first + 1))
    for number in range(6):
        S.write_table(rows.filter(part == number), root, "events", f"2024010{number + 1}_000000", "event_id")
    low, high = first, first + (last - first) // 3
    runs = runlog.runs_between(spark, S.table_path(root, "events"), low, high, "long")
    wanted = S.read_runs(spark, root, "events", runs).filter(F.col("event_id").between(low, high))
    return wanted.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def run_counters(spark, sf):
    """Titles, bodies and rows of each language, counted by the job that writes the table and stored with the run."""
    root = scratch(spark, "counters")
    posts = _bronze_posts(spark, sf)
    held, counted = observed(posts, "presence", bodies=F.count(F.when(~is_blank(F.col("selftext")), 1)), titles=F.count("title"))
    by_lang = {f"rows_{lang}": F.count(F.when(F.col("lang") == lang, 1)) for lang in ("de", "en", "es", "fr")}
    S.write_table(held, root, "posts", "20240201_000000", "url", by_lang, {"presence": counted})
    return S.run_counts(spark, root, "posts").select("rows", F.explode("counters").alias("counter", "n"))


def file_stamps(spark, sf):
    name = F.when(F.col("event_type") == "error", F.concat("event_type", F.lit(".parquet"))).otherwise(
        F.concat("event_type", F.lit("_"), F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit(".parquet")))
    return table(spark, sf, "events").select("event_id", R.file_stamp(name).alias("stamp"), R.family(name).alias("family"))


def _daily_files(spark, sf):
    return table(spark, sf, "events").withColumn("file", F.concat(F.lit("posts_"), F.date_format("ts", "yyyyMMdd"), F.lit("_000000.json")))


def pending_files(spark, sf):
    return R.pending(_daily_files(spark, sf), "20240110_000000", "file").groupBy("file").agg(F.count(F.lit(1)).alias("n"))


def pending_latest(spark, sf):
    return R.pending(_daily_files(spark, sf), "20240110_000000", "file", latest_only=True).groupBy("file").agg(F.count(F.lit(1)).alias("n"))


def high_mark(spark, sf):
    return R.high_mark(_daily_files(spark, sf), "file")


def flatten_payload(spark, sf):
    """API answers, one per conversation, to post records."""
    turns = table(spark, sf, "conversations")
    child = F.struct(F.struct(
        F.col("role").alias("title"), F.col("text").alias("selftext"),
        F.concat(F.lit("/c/"), F.col("conv_id"), F.lit("/"), F.col("role")).alias("permalink"), F.lit("x").alias("url"),
        F.lit("u").alias("author"), F.col("turn").cast("string").alias("score"), F.lit("0").alias("num_comments"),
        F.lit("0").alias("created_utc"), F.lit("s").alias("subreddit")).alias("data"))
    payload = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", child.alias("child")))).alias("c")).select(
        "conv_id", F.struct(F.transform("c", lambda x: x["child"]).alias("children")).alias("data"))
    out = R.flatten_payload(payload, "q", "now", "https://site.example", "en", ("conv_id",))
    return out.select("conv_id", "url", "title", "score", F.length("selftext").cast("long").alias("chars"))


def _split(spark, sf):
    """Stored English documents, and all documents as a batch that overlaps them and repeats keys."""
    d = table(spark, sf, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("key"), "lang")
    return d.filter(F.col("lang") == "en"), d


def insert_new(spark, sf):
    existing, batch = _split(spark, sf)
    return insert_ignore(existing, batch, "key", ["doc_id"]).select("doc_id", "lang")


def insert_outcome(spark, sf):
    existing, batch = _split(spark, sf)
    return insert_counts(existing, batch, "key", ["doc_id"])


# --- streaming --------------------------------------------------------------
_BLOCK_DAYS = 6


def stream_first_events(spark, sf):
    """Events arrive in blocks of days with repeats and late ones; a key is forgotten a block after its event.

    Ids divisible by 5 come again one block later (dropped) and those divisible by 7 seven
    blocks later (a new event by then).  Ids divisible by 11 arrive five blocks late (dropped).
    """
    root = scratch(spark, "first_events")
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    start = e.agg(F.date_trunc("day", F.min("ts"))).scalar()
    e = e.withColumn("block", F.floor(F.date_diff("ts", start) / _BLOCK_DAYS).cast("int"))

    def again(divisor: int, blocks: int):
        moved = F.col("ts") + F.make_dt_interval(F.lit(blocks * _BLOCK_DAYS))
        return e.filter(F.col("event_id") % divisor == 0).withColumns({"ts": moved, "block": F.col("block") + blocks})

    on_time = e.withColumn("block", F.col("block") + F.when(F.col("event_id") % 11 == 0, 5).otherwise(0))
    arriving = stored(on_time.unionByName(again(5, 1)).unionByName(again(7, 7)), "arriving")
    for block in range(arriving.agg(F.max("block")).first()[0] + 1):  # files are taken in the order of their arrival
        arriving.filter(F.col("block") == block).drop("block").coalesce(1).write.mode("append").parquet(f"{root}/in")
    files = spark.readStream.schema("event_id long, ts timestamp, event_type string").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    I.run_dedup(files, f"{root}/out", f"{root}/checkpoint", "event_id", "ts", f"{_BLOCK_DAYS} days")
    return spark.read.parquet(f"{root}/out").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"), F.countDistinct("event_id", "ts").alias("events"))


_EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
                        T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])


def stream_weekly_volume(spark, sf):
    """Events replayed as files through the windowed stream; every window is written on the final pass."""
    root = scratch(spark, "stream")
    rows = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    rows.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(_EVENTS).parquet(f"{root}/in")
    weekly = I.weekly_counts(stream, "ts", "event_type", "value", mean="mean_value")

    def keep(batch, _):
        batch.write.mode("overwrite").parquet(f"{root}/out")

    query = (weekly.writeStream.outputMode("complete").foreachBatch(keep)
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out").withColumn("mean_value", F.round("mean_value", 3))


def stream_insert(spark, sf):
    """Documents arriving in two rounds with repeated keys; the table keeps the first of each key."""
    root = scratch(spark, "insert")
    posts = _bronze_posts(spark, sf)
    for lang in ("en", "fr", "de", "es"):
        (posts.filter(F.col("lang") == lang).select("url", "title", "selftext", "lang").write.json(f"{root}/in/{lang}"))
        files = spark.readStream.schema("url string, title string, selftext string, lang string").json(f"{root}/in/*")
        I.run_insert(I.with_file_block(files), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("urls"))


def bronze_stream_roundtrip(spark, sf):
    """What ``write_bronze`` wrote, streamed back; each text is inserted once, under its first language."""
    root = scratch(spark, "bronze_stream")
    S.write_bronze(_bronze_posts(spark, sf).drop("doc_id"), root, "posts", "20240201_000000")
    I.run_insert(I.stream_posts(spark, f"{root}/posts"), f"{root}/out", f"{root}/checkpoint", order=("lang", "bronze_source", "row_order"))
    return spark.read.parquet(f"{root}/out").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("selftext")).alias("chars"))


def posts_from_json_array(spark, sf):
    """Posts stored as one JSON array per file."""
    root = scratch(spark, "arrays")
    S.write_json_arrays(_bronze_posts(spark, sf).select("url", "selftext", "lang"), root)
    return R.read_posts(spark, root, lines=False).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("selftext")).alias("chars"))


def pages_from_json(spark, sf):
    """Page records written as JSON lines and read back; lists travel as text."""
    root = scratch(spark, "page_json")
    pages = table(spark, sf, "pages")
    keyed = pages.withColumn("url", F.concat_ws("|", "page_id", "url"))
    records = extract_pages(keyed).drop("time_all")
    flat = records.withColumns({f.name: F.to_json(f.name) for f in records.schema.fields if f.dataType.simpleString().startswith(("array", "map"))})
    S.write_bronze(flat, root, "pages", "20240201_000000")
    back = R.read_pages(spark, f"{root}/pages")
    return back.select(F.substring_index("url", "|", 1).cast("long").alias("page_id"), F.size("all_hrefs").cast("long").alias("n_hrefs"))


def insert_into_stored(spark, sf):
    """A table of ``write_table`` that a batch adds to: no key comes twice."""
    root = scratch(spark, "stored")
    rows = _bronze_posts(spark, sf).select("url", "title", "doc_id", "lang")
    S.write_table(dedup_first(rows.filter("lang = 'en'"), "url", ["doc_id"]), root, "posts", "20240101_000000")
    I.insert_batch(f"{root}/posts", "url", ["doc_id"])(rows, 0)
    return S.read_table(spark, root, "posts").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("url").alias("keys"))


def mark_advances(spark, sf):
    """Daily files newer than the stored mark are read, then the mark moves on."""
    root = scratch(spark, "marks")
    daily = _daily_files(spark, sf).select("event_id", F.regexp_extract("file", r"(\d{8}_\d{6})", 1).alias("run_ts"))
    daily.write.partitionBy("run_ts").json(f"{root}/events")
    R.save_mark(spark, root, "events", "20240110_000000")
    paths = [p for p in R.pending_paths(spark, f"{root}/events", R.read_mark(spark, root, "events"), by_folder=True)]
    new = spark.read.schema("event_id long").json(paths).withColumn("stamp", R.file_stamp(F.input_file_name()))
    counts = new.groupBy("stamp").agg(F.count(F.lit(1)).alias("n"))
    R.save_mark(spark, root, "events", counts.agg(F.max("stamp")).first()[0])
    return counts.withColumn("mark", F.lit(R.read_mark(spark, root, "events")))


def stored_files(spark, sf):
    """The inventory of a stored table, and its newest complete run by the declared schema."""
    root = scratch(spark, "files")
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).coalesce(1)
    for run in ("20240101_000000", "20240108_000000"):
        S.write_table(counts, root, "counts", run)
    files = R.inventory(spark, f"{root}/counts").withColumn("family", F.lit("counts"))
    totals = files.agg(F.count(F.lit(1)).alias("runs"), F.countDistinct("family").alias("families"))
    return totals.withColumn("rows", R.read_silver(spark, root, "counts", counts.schema).agg((F.count(F.lit(1)) / 2).cast("long")).scalar())


def filter_counters(spark, sf):
    """What a language filter keeps and what it skips."""
    posts = table(spark, sf, "documents")
    kept = keep_language(posts, "lang", "en").agg(F.count(F.lit(1))).scalar()
    return posts.agg(F.count(F.lit(1)).alias("n")).select(kept.alias("kept"), (F.col("n") - kept).alias("skipped"))


_PROFILES = values([(lang, w) for lang, ws in fixed.LANGUAGE_PROFILES.items() for w in ws])
_POSTS = f"""
raw AS (SELECT d.*, e.ts, e.event_type, e.value, e.props, 'https://posts.example/' || md5(d.text) AS url,
    CASE WHEN e.event_type = 'error' THEN NULL ELSE e.value END AS score, CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS k
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id * 10)"""


def _cap(col: str, name: str) -> str:
    lo, hi = f"{name}1 - 1.5 * ({name}3 - {name}1)", f"{name}3 + 1.5 * ({name}3 - {name}1)"
    return f"round(CASE WHEN {col} < {lo} THEN {lo} WHEN {col} > {hi} THEN {hi} ELSE {col} END, 4)"


QUERIES = [
    Query("bronze_roundtrip", bronze_roundtrip, f"""WITH {_POSTS}
SELECT lang, count(*) AS n, count(DISTINCT url) AS urls, sum(length(text)) AS chars, count(score) AS scores,
  count(CASE WHEN event_type <> 'click' THEN 1 END) AS authors FROM raw GROUP BY lang"""),
    Query("lineage_positions", lineage_positions, "SELECT lang, count(*) AS n, count(*) AS named, count(*) AS positions FROM documents GROUP BY lang"),
    Query("silver_posts", silver_posts_table, f"""WITH {_POSTS},
kept AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY lang, url ORDER BY doc_id) = 1),
q AS (SELECT lang, quantile_cont(score, 0.25) AS s1, quantile_cont(score, 0.75) AS s3, quantile_cont(k, 0.25) AS k1, quantile_cont(k, 0.75) AS k3
  FROM kept GROUP BY lang)
SELECT url, split_part(text, chr(10), 1) AS title, CASE WHEN event_type <> 'click' THEN event_type ELSE 'Unknown' END AS author,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS published_at, {sql_clean('text')} AS body_text_clean,
  NOT regexp_matches(text, '\\S') AS body_text_missing, {_cap('score', 's')} AS score, {_cap('k', 'k')} AS num_comments,
  source AS subreddit, 'reddit' AS source, lang || '.json' AS bronze_source FROM kept JOIN q USING (lang)"""),
    Query("silver_articles", silver_articles_table, f"""WITH {_POSTS},
kept AS (SELECT *, CASE WHEN event_type <> 'error' THEN ceil(n_chars / 1000.0) END AS r FROM raw
  QUALIFY row_number() OVER (PARTITION BY source, url ORDER BY doc_id) = 1),
f AS (SELECT *, coalesce(r, quantile_cont(r, 0.5) OVER (PARTITION BY source)) AS rt FROM kept),
q AS (SELECT source, quantile_cont(rt, 0.25) AS s1, quantile_cont(rt, 0.75) AS s3 FROM f GROUP BY source),
b AS (SELECT *, nullif(array_to_string(list_filter(list_transform(string_split(text, chr(10)),
  lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))), lambda x: length(x) >= 80), ' '), '') AS body FROM f)
SELECT 'https://news.example/' || md5(text) AS url, split_part(text, chr(10), 1) AS title, 'Unknown' AS author,
  CASE WHEN event_type <> 'view' THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S')
       ELSE strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') END AS published_at,
  {_cap('rt', 's')} AS reading_time_min, body AS body_text, body IS NULL AS body_text_missing, 'scraping' AS source,
  source || '.json' AS bronze_source FROM b JOIN q USING (source)"""),
    Query("csv_roundtrip", csv_roundtrip, """
SELECT url, len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS n_hrefs, len(regexp_extract_all(html, '<h1>[^<]+</h1>')) AS n_h1,
  array_to_string(list_sort(list_distinct(regexp_extract_all(html, 'class="([^" ]+)"', 1))), ' ') AS classes FROM pages"""),
    Query("latest_snapshot", latest_snapshot, "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"),
    Query("snapshot_inventory", snapshot_inventory, """
SELECT r AS run_ts, (SELECT count(DISTINCT user_id) FROM events) AS rows, 2 AS schema_cols
FROM (VALUES ('20240101_000000'), ('20240108_000000')) v(r)"""),
    Query("logged_dedup", logged_dedup, """
SELECT count(*) AS records_before_dedup, count(DISTINCT text) + max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS records_after_dedup,
  count(*) - records_after_dedup AS duplicates_removed, round((count(*) - records_after_dedup) * 100.0 / count(*), 2) AS duplicate_rate FROM documents"""),
    Query("runs_by_key_range", runs_by_key_range, """
SELECT event_type, count(*) AS n FROM events, (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events)
WHERE event_id BETWEEN lo AND lo + CAST(floor((hi - lo) / 3) AS BIGINT) GROUP BY event_type"""),
    Query("run_counters", run_counters, """
SELECT (SELECT count(*) FROM documents) AS rows, counter, n FROM (
  SELECT 'rows_' || v.lang AS counter, count(d.lang) AS n FROM (VALUES ('de'), ('en'), ('es'), ('fr')) v(lang) LEFT JOIN documents d ON d.lang = v.lang GROUP BY v.lang
  UNION ALL SELECT 'presence.rows', count(*) FROM documents
  UNION ALL SELECT 'presence.bodies', count(*) FILTER (WHERE regexp_matches(text, '\\S')) FROM documents
  UNION ALL SELECT 'presence.titles', count(text) FROM documents)"""),
    Query("stream_first_events", stream_first_events, """
WITH e AS (SELECT event_type, event_id, event_id % 11 <> 0 OR event_id % 5 = 0 AS seen, event_id % 7 = 0 AS again FROM events)
SELECT event_type, count(*) FILTER (WHERE seen) + count(*) FILTER (WHERE again) AS n, count(*) FILTER (WHERE seen OR again) AS ids,
  count(*) FILTER (WHERE seen) + count(*) FILTER (WHERE again) AS events FROM e GROUP BY event_type"""),
    Query("file_stamps", file_stamps, """
SELECT event_id, CASE WHEN event_type = 'error' THEN '00000000_000000' ELSE strftime(date_trunc('second', ts), '%Y%m%d_%H%M%S') END AS stamp,
  CASE WHEN event_type = 'error' THEN 'error.parquet' ELSE event_type END AS family FROM events"""),
    Query("pending_files", pending_files, """
SELECT 'posts_' || strftime(ts, '%Y%m%d') || '_000000.json' AS file, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-11' GROUP BY 1"""),
    Query("pending_latest", pending_latest, """
SELECT 'posts_' || strftime(ts, '%Y%m%d') || '_000000.json' AS file, count(*) AS n FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY 1"""),
    Query("high_mark", high_mark, "SELECT strftime(max(ts), '%Y%m%d') || '_000000' AS mark FROM events"),
    Query("flatten_payload", flatten_payload, f"""WITH first AS (SELECT *, trim(role || ' ' || text) AS t FROM conversations
  QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) = 1),
w AS (SELECT conv_id, role, unnest(regexp_extract_all(lower(t), '\\p{{L}}+')) AS w FROM first),
h AS (SELECT conv_id, role, lang, count(*) AS n FROM w JOIN (VALUES {_PROFILES}) p(lang, word) ON word = w GROUP BY ALL),
best AS (SELECT conv_id, role, lang FROM h QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY n DESC, lang) = 1)
SELECT conv_id, 'https://site.example/c/' || conv_id || '/' || role AS url, role AS title, CAST(turn AS VARCHAR) AS score, length(text) AS chars
FROM first JOIN best USING (conv_id, role) WHERE lang = 'en'"""),
    Query("insert_ignore", insert_new, """
SELECT doc_id, lang FROM (SELECT * FROM documents WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1) d
WHERE NOT EXISTS (SELECT 1 FROM documents e WHERE e.lang = 'en' AND e.text = d.text)"""),
    Query("insert_outcome", insert_outcome, """
SELECT count(*) AS processed, count(DISTINCT text) FILTER (WHERE NOT en) AS inserted, count(*) - count(DISTINCT text) FILTER (WHERE NOT en) AS skipped
FROM (SELECT text, EXISTS (SELECT 1 FROM documents e WHERE e.lang = 'en' AND e.text = d.text) AS en FROM documents d)"""),
    Query("stream_weekly_volume", stream_weekly_volume, """
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') || '/' || strftime(date_trunc('week', ts) + INTERVAL 6 DAY, '%Y-%m-%d') AS week,
  event_type, count(*) AS n_records, round(round(avg(value), 4), 3) AS mean_value FROM events GROUP BY ALL"""),
    Query("stream_insert", stream_insert, """
SELECT lang, count(DISTINCT text) AS n, count(DISTINCT text) AS urls FROM (SELECT lang, text FROM documents
  QUALIFY rank() OVER (PARTITION BY text ORDER BY list_position(['en', 'fr', 'de', 'es'], lang)) = 1) GROUP BY lang"""),
    Query("bronze_stream_roundtrip", bronze_stream_roundtrip, """
SELECT lang, count(DISTINCT text) AS n, sum(length(text)) AS chars FROM (SELECT min(lang) AS lang, text FROM documents GROUP BY text) GROUP BY lang"""),
    Query("posts_from_json_array", posts_from_json_array, "SELECT lang, count(*) AS n, sum(length(text)) AS chars FROM documents GROUP BY lang"),
    Query("pages_from_json", pages_from_json, """
SELECT page_id, len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS n_hrefs FROM pages"""),
    Query("insert_into_stored", insert_into_stored, "SELECT count(DISTINCT text) AS rows, count(DISTINCT text) AS keys FROM documents"),
    Query("mark_advances", mark_advances, """
SELECT strftime(CAST(ts AS DATE), '%Y%m%d') || '_000000' AS stamp, count(*) AS n, (SELECT strftime(max(ts), '%Y%m%d') || '_000000' FROM events) AS mark
FROM events WHERE ts >= TIMESTAMP '2024-01-11' GROUP BY ALL"""),
    Query("stored_files", stored_files, "SELECT 2 AS runs, 1 AS families, count(DISTINCT event_type) AS rows FROM events"),
    Query("filter_counters", filter_counters, """
SELECT count(*) FILTER (lang = 'en') AS kept, count(*) FILTER (lang <> 'en' OR lang IS NULL) AS skipped FROM documents"""),
]
