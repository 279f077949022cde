"""Files in, tables out: readers, silver, gold, snapshots, streaming."""

import json

import pytest
from pyspark.sql import functions as F

from opinionlake import fixed, schemas
from opinionlake.operators.sentiment import starter_rules
from opinionlake.operators.quality import batch_duplicates, batch_metrics_articles, batch_metrics_posts
from opinionlake.plans import dashboard as B
from opinionlake.plans import story
from opinionlake.plans.gold import gold_base, unify
from opinionlake.plans.governance import governance, governance_columns, kpi_table
from opinionlake.plans.silver import silver_articles, silver_posts, typed_articles
from opinionlake.sources import keyed as K
from opinionlake.sources import readers as R
from opinionlake.sources import runlog
from opinionlake.sources import tables as S
from opinionlake.streaming import ingest as I


def post(i, **over):
    base = {"api_query": "q", "url": f"https://p/{i}", "permalink": f"/p/{i}", "title": f"Title {i}", "selftext": f"good text {i}",
            "author": "ann", "score": i, "num_comments": 1, "created_utc": 1779664688.0 + i, "subreddit": "s", "retrieved_at": "2026-05-24T21:00:00"}
    return {**base, **over}


def write_json(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(records, ensure_ascii=False), encoding="utf-8")


@pytest.fixture
def bronze(tmp_path):
    """Two files of posts: the first lacks ``lang``; repeats inside and across files."""
    folder = tmp_path / "posts"
    first = [post(i, selftext="" if i % 5 < 2 else f"text {i} &amp; more") for i in range(25)]
    write_json(folder, "posts_20260524_211808.json", first)
    second = [post(i, lang="en") for i in range(20, 30)] + [post(29, lang="en", title="later"), post(30, lang="en", url=None, author=None)]
    write_json(folder, "posts_20260525_000015.json", second)
    return str(folder)


def test_posts_to_silver(spark, bronze):
    raw = R.read_posts(spark, bronze, lines=False)
    assert raw.count() == 37 and raw.filter("lang is null").count() == 25
    out = silver_posts(raw, ["row_order"])
    assert out.schema.names == schemas.SILVER_POST.names and out.count() == 35
    per_file = {r.bronze_source: r for r in batch_metrics_posts(out, batch_duplicates(raw)).collect()}
    one, two = per_file["posts_20260524_211808.json"], per_file["posts_20260525_000015.json"]
    assert (one.rows, one.duplicates, one.empty_bodies, one.score_median, one.num_comments_median) == (25, 0, 10, 12.0, 1.0)
    assert (two.rows, two.duplicates) == (10, 1)
    assert out.filter("url = 'https://p/29' and bronze_source like '%000015%'").first().title == "Title 29"


def test_golden_bounds(spark, bronze):
    """Quartiles 1 and 4 give bounds -3.5 and 8.5: the shape of a recorded batch."""
    scores = [1] * 7 + [2] * 7 + [3] * 4 + [4] * 3 + [50, 60, 70, 80]
    raw = spark.createDataFrame([(f"u{i}", "f", i, str(s), "0") for i, s in enumerate(scores)],
                                "url string, bronze_source string, row_order int, score string, num_comments string")
    for c in ("selftext", "title", "author", "created_utc", "subreddit"):
        raw = raw.withColumn(c, F.lit(None).cast("string"))
    out = silver_posts(raw, ["row_order"])
    assert out.agg(F.max("score")).first()[0] == 8.5 and out.filter("score = 8.5").count() == 4


def page(i, minutes="3 minutes", **over):
    meta = {fixed.META_TITLE: f"Title {i}", "author": "Ann", fixed.META_PUBLISHED: "2026-05-20T10:00:00+00:00", fixed.META_READING_TIME: minutes}
    base = {"url": f"https://n/{i}", "p_all_texts": ["short", "x" * 85, "Posted by " + "y" * 90], "all_meta": str(meta), "published_time": "20/5/2026"}
    return {**base, **over}


def test_pages_to_silver_from_json_and_csv(spark, tmp_path):
    records = [page(i, f"{2 if i < 14 else 3} minutes") for i in range(18)] + [
        page(18, "9 minutes"), page(19, None), page(0), {"url": "https://n/bad", "error": "timeout", "status": "error"},
        page(20, all_meta="{'author': None, 'og:title': 'N'}"), page(21, all_meta="{broken")]
    write_json(tmp_path / "pages", "pages_20260409_000909.json", records)
    pages = R.read_pages(spark, str(tmp_path / "pages"), lines=False)
    out = silver_articles(pages, ["row_order"])
    rows = {r.url: r for r in out.collect()}
    assert len(rows) == 23 and rows["https://n/0"].body_text == "x" * 85
    assert rows["https://n/bad"].author == "Unknown" and rows["https://n/bad"].body_text_missing
    assert rows["https://n/20"].title == "N" and str(rows["https://n/20"].published_at.date()) == "2026-05-20"
    assert rows["https://n/21"].title is None
    assert R.unparsed_metas(pages).first().unparsed == 1
    assert rows["https://n/19"].reading_time_min == 2.0
    metrics = batch_metrics_articles(typed_articles(pages)).first()
    assert (metrics.rows, metrics.duplicates) == (23, 1)
    S.write_csv(pages.drop("bronze_source", "row_order", "_has_meta"), str(tmp_path / "csv"))
    again = silver_articles(R.read_pages(spark, str(tmp_path / "csv"), "csv"), ["row_order"])
    assert {r.url: r.body_text for r in again.collect()} == {u: r.body_text for u, r in rows.items()}
    with pytest.raises(ValueError):
        R.read_pages(spark, str(tmp_path), "xml")


def test_incremental_reading(spark, bronze):
    raw = R.read_posts(spark, bronze, lines=False)
    assert R.pending(raw, "20260524_211808").count() == 12
    assert R.pending(raw, fixed.FIRST_RUN, latest_only=True).count() == 12
    assert R.pending(raw, "20260525_000015").count() == 0
    assert R.high_mark(raw).first().mark == "20260525_000015"
    names = spark.createDataFrame([("a_20260101_101010.parquet",), ("plain.parquet",)], "n string").coalesce(1)
    assert [tuple(r) for r in names.select(R.file_stamp(F.col("n")), R.family(F.col("n"))).collect()] == [
        ("20260101_101010", "a"), (fixed.FIRST_RUN, "plain.parquet")]


def test_payload(spark, tmp_path):
    def child(title, text, permalink):
        return {"data": {"title": title, "selftext": text, "permalink": permalink, "url": "https://raw", "author": None,
                         "score": 3, "num_comments": 0, "created_utc": 1.0, "subreddit": "s"}}
    write_json(tmp_path / "api", "api.json", {"data": {"children": [
        child("the start of the day", "it is", "/a"), child("again", "for the", "/a"), child("el gato de la casa", "los perros", "/b"),
        child("on the way to the end", None, None), child(None, None, "/c")]}})
    out = R.flatten_payload(R.read_payload(spark, str(tmp_path / "api")), "q", "now").orderBy("row_order").collect()
    assert [(r.url, r.title, r.lang) for r in out] == [
        (fixed.POST_SITE + "/a", "the start of the day", "en"), ("https://raw", "on the way to the end", "en")]


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    assert S.latest(spark, root, "t", schemas.SILVER_POST).count() == 0
    with pytest.raises(FileNotFoundError):
        S.latest(spark, root, "t")
    for run, n in (("20260101_000000", 5), ("20260108_000000", 3), ("20260108_000000", 4)):  # the last run is repeated
        S.write_table(spark.range(n), root, "t", run)
    (tmp_path / "t" / "run_ts=20260115_000000").mkdir()  # a run that never finished
    assert S.latest(spark, root, "t").count() == 4 and S.latest_run(spark, root, "t") == "20260108_000000"
    assert {r.run_ts: r.n for r in S.read_table(spark, root, "t").groupBy("run_ts").agg(F.count("*").alias("n")).collect()} == {
        "20260101_000000": 5, "20260108_000000": 4}
    inv = R.inventory(spark, f"{root}/t")
    assert R.inventory_totals(inv).first().files == inv.count() > 0


def test_a_lost_commit_leaves_the_old_state(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    S.write_table(spark.range(5), root, "t", "1", "id", {"even": F.count(F.when(F.col("id") % 2 == 0, 1))})

    def lost(*_, **__):
        raise IOError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(runlog, "commit", lost)
        with pytest.raises(IOError):
            S.write_table(spark.range(100), root, "t", "1", "id")
        with pytest.raises(IOError):
            S.write_table(spark.range(100), root, "t", "2", "id")
    assert S.complete_runs(spark, root, "t") == ["1"] and S.latest(spark, root, "t").count() == 5
    assert S.read_table(spark, root, "t").count() == 5
    row = S.run_counts(spark, root, "t").first()
    assert (row.rows, row["columns"], row.key_min, row.key_max, row.counters) == (5, 1, "0", "4", {"even": 3})
    S.write_table(spark.range(7), root, "t", "1")  # repeated: the last entry counts, and what was left is cleaned away
    assert S.latest(spark, root, "t").count() == 7 and spark.read.parquet(f"{root}/t/run_ts=1").count() == 7


def test_the_log_answers_without_listing_runs(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for run in range(4):
        S.write_table(spark.range(run * 10, run * 10 + 10), root, "t", f"r{run}", "id")
    S.write_table(spark.range(0), root, "t", "r4", "id")

    def never(*_):
        raise AssertionError("runs were listed")

    monkeypatch.setattr(runlog, "folder_names", never)
    assert S.complete_runs(spark, root, "t") == [f"r{i}" for i in range(5)]
    assert S.latest(spark, root, "t").count() == 0
    assert {r.run_ts: r.rows for r in S.run_counts(spark, root, "t").collect()} == {**{f"r{i}": 10 for i in range(4)}, "r4": 0}
    assert runlog.runs_between(spark, f"{root}/t", 9, 21, "long") == ["r0", "r1", "r2"]
    found = S.read_runs(spark, root, "t", ["r1"])
    assert found.count() == 10 and all("run_ts=r1" in f for f in found.inputFiles())


def test_tables_without_a_log_are_adopted(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/t/run_ts=001")
    (tmp_path / "t" / "run_ts=002").mkdir()
    assert S.complete_runs(spark, root, "t") == ["001"] and S.latest(spark, root, "t").count() == 3
    S.write_table(spark.range(4).withColumn("x", F.lit("y")), root, "t", "003")
    assert S.complete_runs(spark, root, "t") == ["001", "003"]
    assert {(r.run_ts, r.n, r.x) for r in S.read_table(spark, root, "t").groupBy("run_ts").agg(F.count("*").alias("n"), F.count("x").alias("x")).collect()} == {
        ("001", 3, 0), ("003", 4, 4)}
    assert S.dedup_counts(spark, root, "t", "t").first().records_before_dedup == 4


def test_gold_and_everything_after(spark, bronze, tmp_path):
    posts = silver_posts(R.read_posts(spark, bronze, lines=False), ["row_order"])
    articles = spark.createDataFrame([("https://n/1", "Mourinho signs a deal", "Ann", "z" * 90, "scraping", "n.json", 3.0)],
                                     "url string, title string, author string, body_text string, source string, bronze_source string, reading_time_min double")
    root = str(tmp_path / "gold")
    S.write_table(gold_base([posts, articles], starter_rules()), root, "gold_base", "20260601_000000")
    gold = S.latest(spark, root, "gold_base")
    assert gold.schema.names == schemas.GOLD_BASE.names and gold.count() == 31
    assert gold.filter("url = 'https://p/20'").first().bronze_source == "posts_20260524_211808.json"  # earliest file wins
    row = governance(gold, "r", before=unify(posts, articles)).first().asDict()
    assert list(row) == governance_columns() and len(row) == 63
    assert (row["records_before_dedup"], row["duplicates_removed"], row["actual_runs_reddit"]) == (36, 5, 2)
    assert governance(gold.filter("source = 'none'"), "r").first().total_records == 0
    table = kpi_table(governance(gold, "r")).collect()
    assert table[0].Category == "Core" and len(table) == 62
    tables = story.story_tables(gold)
    assert tuple(tables) == story.TABLES
    S.write_tables(tables, root, "20260601_000000")
    read = {name: S.latest(spark, root, name) for name in tables}
    assert {r.aspect for r in read["aspect_sentiment"].collect()} == {"mourinho", "transfers"}
    assert B.aspect_view(read["aspect_sentiment"]).filter("aspect = 'transfers'").first().label == "Fichajes"
    assert B.keyword_view(read["top_keywords"], read["keyword_sentiment"]).count() > 0
    summary = story.run_summary(gold, read["top_keywords"], "r").first()
    assert summary.total_records == 31 and summary.sources == ["reddit", "scraping"] and summary.weeks_covered == 2
    assert S.with_day_and_week(gold).filter("published_at is null").first().week == fixed.UNDATED


# --- streaming --------------------------------------------------------------
def test_stream_inserts_each_key_once(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    write_json(source, "a_20260102_000000.json", [post(1), post(2), post(2, title="repeat")])
    I.run_insert(I.stream_posts(spark, str(source), lines=False), target, state)
    write_json(source, "b_20260101_000000.json", [post(2, title="late"), post(3)])  # older stamp, still read
    I.run_insert(I.stream_posts(spark, str(source), lines=False), target, state)
    rows = {r.url: r.title for r in spark.read.parquet(target).collect()}
    assert rows == {f"https://p/{i}": f"Title {i}" for i in (1, 2, 3)} and spark.read.parquet(target).count() == 3


def test_repeated_batch_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "out")
    write = I.insert_batch(target, "url", ["n"])
    first = spark.createDataFrame([("a", 1), ("b", 2)], "url string, n int")
    second = spark.createDataFrame([("b", 3), ("c", 4)], "url string, n int")
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        write(batch, number)
    assert sorted((r.url, r.n) for r in spark.read.parquet(target).collect()) == [("a", 1), ("b", 2), ("c", 4)]


def test_batches_extend_a_stored_table(spark, tmp_path):
    root = str(tmp_path)
    S.write_table(spark.createDataFrame([("a", 1), ("b", 2)], "url string, n int"), root, "posts", "20260101_000000")
    (tmp_path / "posts" / "run_ts=20260102_000000").mkdir()  # a run that never finished
    I.insert_batch(f"{root}/posts", "url", ["n"])(spark.createDataFrame([("a", 9), ("c", 4), (None, 5)], "url string, n int"), 0)
    assert sorted((r.url, r.n) for r in S.read_table(spark, root, "posts").collect()) == [("a", 1), ("b", 2), ("c", 4)]
    assert sorted(r.url for r in R.read_silver(spark, root, "posts", schemas.SILVER_POST).collect()) == ["a", "b", "c"]
    assert R.read_silver(spark, root, "none", schemas.SILVER_POST).count() == 0


def test_a_batch_opens_only_files_that_may_hold_its_keys(spark, tmp_path):
    root = str(tmp_path)
    for run in range(3):
        rows = spark.range(run * 1000, run * 1000 + 1000).select(F.concat(F.lit("k"), "id").alias("url"), "id")
        K.insert_absent(rows, root, "posts", f"2026010{run}_000000", "url", ["id"], buckets=8)
    runs = S.complete_runs(spark, root, "posts")
    asked = spark.createDataFrame([("k1500",), ("new",), ("k1500",)], "url string")
    known = K.known_keys(asked, root, "posts", runs, "url", 8)
    opened = known.inputFiles()
    # 24 key files: the one that holds the key, and few others by chance
    assert 1 <= len(opened) <= 3 and any("run_ts=20260101_000000" in f for f in opened)
    assert "k1500" in {r.url for r in known.collect()}
    scan = known._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<url:string>" in scan and all("/_keys/" in f for f in opened)
    # nothing is missed: all old keys are found, whatever the batch
    every = spark.range(0, 3000, 7).select(F.concat(F.lit("k"), "id").alias("url"), "id")
    K.insert_absent(every, root, "posts", "20260109_000000", "url", ["id"], buckets=8)
    table = S.read_table(spark, root, "posts")
    assert table.count() == 3000 and table.filter("run_ts = '20260109_000000'").count() == 0


def test_filters_and_lots_of_any_size(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    monkeypatch.setattr(K, "MOST_BITS", 1 << 10)  # too small a filter is only asked in vain
    monkeypatch.setattr(K, "ASKED_AT_ONCE", 16)
    first = spark.range(5000).select(F.col("id").alias("k"))
    K.insert_absent(first.unionByName(first.limit(3)).unionByName(spark.createDataFrame([(None,)], "k long")), root, "t", "1", "k", ["k"], 4)
    K.insert_absent(spark.range(4000, 6000).select(F.col("id").alias("k")), root, "t", "2", "k", ["k"], 4)
    K.insert_absent(spark.range(0).select(F.col("id").alias("k")), root, "t", "3", "k", ["k"], 4)
    counts = {r.run_ts: r.n for r in S.read_table(spark, root, "t").groupBy("run_ts").agg(F.count("*").alias("n")).collect()}
    assert counts == {"1": 5000, "2": 1000}


def test_a_failed_run_leaves_no_keys(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("a", 1)], "url string, n int")
    K.index_run(rows, root, "t", "1", "url")  # lost before the rows were written
    K.insert_absent(rows, root, "t", "2", "url", ["n"])
    assert S.read_table(spark, root, "t").count() == 1


def test_bronze_round_trip_keeps_every_row(spark, tmp_path):
    rows = spark.createDataFrame([(f"u{i}", "t") for i in range(20)], "url string, title string").repartition(2)
    path = S.write_bronze(rows, str(tmp_path), "posts", "20260101_000000")
    assert R.read_posts(spark, path).count() == 20
    I.run_insert(I.stream_posts(spark, path), str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_new_files_are_chosen_from_the_listing(spark, bronze, tmp_path):
    root = str(tmp_path / "lake")
    assert R.read_mark(spark, root, "posts") == fixed.FIRST_RUN
    paths = R.pending_paths(spark, bronze, "20260524_211808")
    assert [p.rsplit("/", 1)[1] for p in paths] == ["posts_20260525_000015.json"]
    plan = R.read_posts(spark, paths, lines=False)
    assert len(plan.inputFiles()) == 1  # the other file is not even opened
    R.save_mark(spark, root, "posts", "20260525_000015")
    R.save_mark(spark, root, "posts", "20260524_000000")  # an older batch does not set the mark back
    assert R.read_mark(spark, root, "posts") == "20260525_000015"
    assert R.pending_paths(spark, bronze, R.read_mark(spark, root, "posts")) == []
    with pytest.raises(R.NoSourceFile):
        R.pending_paths(spark, bronze, "", pattern="*.csv")


def test_weekly_stream_equals_batch(spark, tmp_path):
    rows = spark.range(2000).select(
        (F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1500)).alias("published_at"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), (F.col("id") / 100).alias("v"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = (I.weekly_counts(stream, value="v").writeStream.outputMode("complete").format("memory").queryName("weekly")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    from opinionlake.operators.distribution import with_week
    want = with_week(rows).groupBy("week", "source").agg(F.count("*").alias("n"), F.round(F.avg("v"), 4).alias("m")).collect()
    got = spark.table("weekly").collect()
    assert {(r.week, r.source, r.n_records, r.compound_mean) for r in got} == {(r.week, r.source, r.n, r.m) for r in want}


def test_stream_dedup(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "url string, n int").withColumn("published_at", F.lit("2026-01-01").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = I.dedup_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("deduped").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("deduped").count() == 2


def test_a_stopped_dedup_stream_goes_on_where_it_was(spark, tmp_path):
    source, target, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def arrive(*rows):
        frame = spark.createDataFrame([(key, f"2026-01-{day:02d} 12:00:00", n) for key, day, n in rows], "url string, ts string, n int")
        frame.select("url", F.col("ts").cast("timestamp").alias("published_at"), "n").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema("url string, published_at timestamp, n int").option("maxFilesPerTrigger", 1).parquet(source)
        I.run_dedup(stream, target, state, late="2 days")
        return sorted((r.url, r.n) for r in spark.read.parquet(target).collect())

    arrive(("a", 1, 1), ("a", 1, 2), ("b", 1, 3))
    assert [u for u, _ in run()] == ["a", "b"]
    arrive(("a", 2, 4), ("c", 3, 5))  # the key is remembered over the restart
    assert [u for u, _ in run()] == ["a", "b", "c"]
    arrive(("d", 20, 6))
    arrive(("e", 20, 7))  # the bound is that of the batch before
    arrive(("old", 5, 8))
    arrive(("a", 21, 9), ("d", 21, 10))  # the first key is forgotten by now
    assert [(u, n) for u, n in run() if n > 4] == [("a", 9), ("c", 5), ("d", 6), ("e", 7)]
    assert len(run()) == 6  # nothing new


def test_json_arrays_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    from opinionlake.registry import ingest

    monkeypatch.setattr(ingest, "scratch", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(S, "ARRAY_ROWS", 5, raising=False)
    monkeypatch.setattr(S, "ARRAY_CHARS", 20_000, raising=False)
    sf = "/root/testdata/sf0.001"
    assert ingest.posts_from_json_array(spark, sf).agg(F.sum("n")).first()[0] == spark.read.parquet(f"{sf}/documents.parquet").count()
    files = [path.read_text(encoding="utf-8") for path in (tmp_path / "arrays").glob("part-*")]
    assert all(1 <= len(json.loads(f)) <= 5 and (len(f) < 20_010 or len(json.loads(f)) == 1) for f in files)
    assert len(files) >= 40


def test_views_and_readers_of_flat_files(spark, tmp_path):
    rows = [("u1", "2026-01-05 10:00:00", "a", 0.4), ("u2", "2026-01-06 10:00:00", "b", -0.2), ("u3", "2026-01-14 10:00:00", "a", 0.1)]
    gold = spark.createDataFrame(rows, "url string, ts string, source string, vader_compound double").withColumn(
        "published_at", F.col("ts").cast("timestamp"))
    volume = {(r.period, r.source): r.n_records for r in B.volume_view(gold).collect()}
    assert volume == {("2026-01-05", "a"): 1, ("2026-01-05", "b"): 1, ("2026-01-05", "all"): 2,
                      ("2026-01-12", "a"): 1, ("2026-01-12", "b"): 0, ("2026-01-12", "all"): 1}
    assert B.volume_view(gold, source="b").count() == 2
    trend = B.trend_view(gold.withColumn("source", F.when(F.col("source") == "a", fixed.ARTICLES).otherwise(fixed.POSTS)))
    assert trend["trend"].count() == 3 and trend["delta"].first().delta == pytest.approx(-0.3) and trend["coverage"].count() == 1
    for stamp, n in (("20260101_000000", 2), ("20260108_000000", 3)):
        spark.range(n).select(F.concat(F.lit(f"{stamp}-"), "id").alias("url")).coalesce(1).write.parquet(str(tmp_path / stamp))
        next((tmp_path / stamp).glob("part-*")).rename(tmp_path / f"posts_{stamp}.parquet")
    (tmp_path / "flat").mkdir()
    for file in tmp_path.glob("posts_*"):
        file.rename(tmp_path / "flat" / file.name)
    assert R.read_silver_files(spark, str(tmp_path / "flat"), "posts").count() == 5
    full = R.read_silver_files(spark, str(tmp_path / "flat"), "posts", schemas.SILVER_POST)
    assert full.schema.names == schemas.SILVER_POST.names and full.count() == 5


def test_pages_arrive_as_a_stream(spark, tmp_path):
    write_json(tmp_path / "in", "pages_20260101_000000.json", [{"url": "https://n/1", "all_meta": "{}"}, {"url": "https://n/1"}])
    pages = I.stream_pages(spark, str(tmp_path / "in"), lines=False)
    I.run_insert(pages, str(tmp_path / "out"), str(tmp_path / "state"), transform=R.parse_pages)
    rows = S.read_table(spark, str(tmp_path), "out").collect()
    assert [(r.url, r.all_meta) for r in rows] == [("https://n/1", {})]
