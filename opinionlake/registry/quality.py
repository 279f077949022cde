"""Quality measures, outliers, duplicates, governance."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinionlake import fixed
from opinionlake.functions import numbers as N
from opinionlake.functions import text as X
from opinionlake.functions import timeparts as TP
from opinionlake.operators import conform as C
from opinionlake.operators import dedup as U
from opinionlake.operators import outliers as O
from opinionlake.operators import quality as Q
from opinionlake.operators.quantiles import quantiles
from opinionlake.plans import dashboard as B
from opinionlake.plans import governance as G
from opinionlake.registry.base import Query, table
from opinionlake.registry.views import gold, gold_sql, quoted, records, records_sql, stored_gold
from opinionlake.schemas import GOLD_INPUT, SILVER_ARTICLE, SILVER_POST
from opinionlake.session import stored

RUN = "20240201_000000"


def _long(df, *names):
    return df.withColumns({n: F.col(n).cast("long") for n in names})


# --- projections ------------------------------------------------------------
def typed_records(spark, sf):
    """Numbers and dates out of text that is partly unreadable."""
    e = table(spark, sf, "events")
    score = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    epoch = F.when(F.col("event_type") != "view", F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string"))
    return e.select(
        "event_id", N.to_double(score).alias("score"),
        F.date_format(TP.ts_from_epoch(epoch), "yyyy-MM-dd HH:mm:ss").alias("published_at"),
        X.fill_author(F.when(F.col("event_type") != "click", F.col("event_type"))).alias("author"),
        X.blank_if_null(F.when(F.col("event_type") == "click", F.lit("x"))).alias("body"))


def union_sources(spark, sf):
    """Both silver schemas united: filled cells per source and column."""
    rows = records(spark, sf)
    posts = C.conform(rows.filter(F.col("source") == fixed.POSTS), SILVER_POST)
    articles = C.conform(rows.filter(F.col("source") == fixed.ARTICLES), SILVER_ARTICLE)
    united = C.conform(C.union_sources(posts, articles), GOLD_INPUT)
    return united.groupBy("source").agg(*[F.count(c).alias(f"n_{c}") for c in ("url", "author", "body_text", "score", "reading_time_min")])


def meta_columns(spark, sf):
    """Fields of a metadata map, from JSON and from the older text form."""
    e = table(spark, sf, "events")
    as_text = F.replace(F.replace("props", F.lit('"'), F.lit("'")), F.lit("}"), F.lit(", 'gone': None}"))
    out = C.meta_fields(e.withColumn("m", F.from_json("props", "map<string,string>")), "m", {"k": "k", "absent": "absent"})
    return out.select("event_id", "k", "absent", X.meta_get(X.meta_from_text(as_text), "k").alias("k_text"))


def scope_counts(spark, sf):
    rows = C.drop_null_keys(C.dated(records(spark, sf), "published_at"), "author")
    return C.scope(rows, fixed.ARTICLES).agg(F.count(F.lit(1)).alias("n"))


# --- duplicates -------------------------------------------------------------
def _hashed(spark, sf):
    """Documents under a 256-bit hash of their text, so no text is a shuffle key."""
    return table(spark, sf, "documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("text_key"))


def dedup_first(spark, sf):
    return U.dedup_first(_hashed(spark, sf), "text_key", ["doc_id"]).select("doc_id", "lang", "source")


def duplicate_stats(spark, sf):
    return U.duplicate_rate(_hashed(spark, sf), "text_key")


def dedup_stats(spark, sf):
    rows = records(spark, sf)
    return U.dedup_stats(rows, U.dedup_first(rows, "url", ["doc_id"]))


def top_per_source(spark, sf):
    return U.top_per_group(table(spark, sf, "documents").select("source", "doc_id", "n_chars"), "source",
                           [F.desc("n_chars"), F.asc("doc_id")], 3).withColumn("rank", F.col("rank").cast("long"))


# --- nulls, flags, compliance ----------------------------------------------
def null_rates(spark, sf):
    return Q.null_rates(records(spark, sf), _NULLABLE)


_NULLABLE = ("url", "author", "published_at", "body_text", "score", "num_comments", "reading_time_min")


def null_rates_long(spark, sf):
    return Q.null_rates_long(records(spark, sf), _NULLABLE).drop("dtype")


def missing_body(spark, sf):
    return Q.flag_rate(records(spark, sf), "body_text_missing")


def schema_compliance(spark, sf):
    return Q.schema_compliance(records(spark, sf))


def ingestion_compliance(spark, sf):
    return Q.ingestion_compliance(records(spark, sf))


def runs(spark, sf):
    return Q.runs(records(spark, sf))


def time_coverage(spark, sf):
    e = table(spark, sf, "events").select(F.when(F.col("event_type") != "error", F.col("ts").cast("timestamp")).alias("ts"))
    return _long(Q.time_coverage(e, "ts"), "weeks_covered", "days_covered")


# --- lengths ----------------------------------------------------------------
def token_stats(spark, sf):
    return _long(Q.numeric_stats(gold(spark, sf), "token_count"), "token_count_min", "token_count_max")


def text_length_stats(spark, sf):
    return _long(Q.text_length_stats(table(spark, sf, "documents"), "text", "lang"), "min", "max")


def text_describe(spark, sf):
    out = Q.describe(table(spark, sf, "documents"), "text")
    return out.withColumn("value", F.round("value", 4))


def short_text_share(spark, sf):
    return Q.short_share(records(spark, sf), "body_text", 400)


def length_histogram(spark, sf):
    return Q.histogram(table(spark, sf, "documents"), "text")


# --- quantiles and outliers -------------------------------------------------
def price_quantiles(spark, sf):
    """Exact quantiles of a free number, by bracketing."""
    q = quantiles(table(spark, sf, "lineitem"), "l_extendedprice", [0.1, 0.5, 0.9], ["l_returnflag"])
    return q.select("l_returnflag", "n", *[F.round(F.get("q", F.lit(i)), 4).alias(f"q{i}") for i in range(3)])


def iqr_outliers(spark, sf):
    out = O.iqr_outliers(table(spark, sf, "events"), "value", F.col("event_type") == "purchase")
    return out.select("n", "n_outliers", "outlier_rate", *[F.round(c, 4).alias(c) for c in ("q1", "q3", "iqr", "lower", "upper")])


def cap_outliers(spark, sf):
    capped = O.cap_outliers(table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("double")),
                            ["value", "k"], ["event_type"])
    return capped.select("event_id", F.round("value", 4).alias("value"), F.round("k", 4).alias("k"))


def cap_outliers_global(spark, sf):
    capped = O.cap_outliers(table(spark, sf, "lineitem"), ["l_extendedprice"])
    return capped.select("l_orderkey", "l_linenumber", F.round("l_extendedprice", 4).alias("price"))


def impute_median(spark, sf):
    gaps = table(spark, sf, "events").withColumn("value", F.when(F.col("user_id") > 10, F.col("value")))
    return O.impute_median(gaps, "value", ["event_type"]).select("event_id", F.round("value", 4).alias("value"))


def outlier_rates(spark, sf):
    return B.outlier_view(stored_gold(spark, sf))


def batch_metrics(spark, sf):
    rows = records(spark, sf).filter(F.col("source") == fixed.ARTICLES)
    # repeats differ in their value, so it matters which one counts
    varied = rows.withColumn("reading_time_min", F.when(F.col("doc_id") % 7 != 0, F.col("reading_time_min") + F.col("doc_id") % 5))
    return Q.batch_metrics_articles(varied, order=["doc_id"])


def batch_metrics_posts(spark, sf):
    # the narrow columns are stored once: bounds, medians and counts each read them
    rows = stored(records(spark, sf).filter(F.col("source") == fixed.POSTS).select(
        "bronze_source", "url", "doc_id", "body_text_missing", "score", "num_comments"), "posts")
    kept = O.cap_outliers(U.dedup_first(rows, ["bronze_source", "url"], ["doc_id"]), ["score", "num_comments"], ["bronze_source"])
    return Q.batch_metrics_posts(kept, Q.batch_duplicates(rows)).withColumns(
        {c: F.round(c, 4) for c in ("score_median", "num_comments_median")})


# --- governance -------------------------------------------------------------
def governance_row(spark, sf):
    return _plain_gov(G.governance(stored_gold(spark, sf), RUN, before=records(spark, sf)))


def governance_scoped(spark, sf):
    return _plain_gov(G.governance(C.scope(gold(spark, sf, dedup=False), fixed.POSTS), RUN))


def governance_by_source(spark, sf):
    """The KPIs of all records and of every source found; titles with a D are a source of their own, those with an E have none."""
    rows = stored_gold(spark, sf)
    named = F.when(F.startswith("title", F.lit("D")), "forum").when(~F.startswith("title", F.lit("E")), F.col("source"))
    return _plain_gov(G.source_records(rows.withColumn("source", named)))


def _plain_gov(df):
    return df.withColumns({f.name: F.col(f.name).cast("long") for f in df.schema.fields if f.dataType.simpleString() == "int"})


def kpi_table(spark, sf):
    return G.kpi_table(G.governance(stored_gold(spark, sf), RUN, before=records(spark, sf)))


def kpi_names(spark, sf):
    """Category, readable name and raw name of every KPI of a scope."""
    return B.governance_view(stored_gold(spark, sf), RUN, fixed.ARTICLES).select("Category", "KPI", "RawMetric", "status")


def kpi_matrix(spark, sf):
    return G.kpi_matrix(G.kpis_long(G.governance(stored_gold(spark, sf), RUN)))


def null_view(spark, sf):
    return B.null_view(gold(spark, sf), fixed.POSTS)


def _gov_sql(before: bool, src: str = "gold") -> str:
    def rate(condition: str) -> str:
        return f"round(avg(CASE WHEN {condition} THEN 100.0 ELSE 0 END), 2)"

    hints = " + ".join(f"(length(sp) - length(replace(sp, '{h}', ''))) // {len(h)}" for h in fixed.SPANISH_HINTS)
    spanish = f"(coalesce(length(body_text), 0) >= 40 AND ({hints}) >= 4)"
    parts = [f"'{RUN}' AS pipeline_run_ts", "count(*) AS total_records"]
    parts += [f"count(*) FILTER (WHERE source = '{s}') AS records_{s}" for s in fixed.SOURCES]
    parts += [f"{rate('body_text_missing')} AS body_text_missing_rate",
              f"{rate(' AND '.join(f'{c} IS NOT NULL' for c in fixed.REQUIRED))} AS schema_compliance_rate"]
    if before:
        parts += ["(SELECT count(*) FROM records) AS records_before_dedup", "count(*) AS records_after_dedup",
                  "(SELECT count(*) FROM records) - count(*) AS duplicates_removed",
                  "round(((SELECT count(*) FROM records) - count(*)) * 100.0 / (SELECT count(*) FROM records), 2) AS duplicate_rate"]
    else:
        parts += ["NULL AS records_before_dedup", "NULL AS records_after_dedup", "NULL AS duplicates_removed",
                  "round((count(*) - count(DISTINCT url)) * 100.0 / count(*), 2) AS duplicate_rate"]
    weeks, days = "count(DISTINCT date_trunc('week', published_at))", "count(DISTINCT CAST(published_at AS DATE))"
    parts += ["strftime(min(published_at), '%Y-%m-%d') AS first_record_date", "strftime(max(published_at), '%Y-%m-%d') AS last_record_date",
              "CAST(floor((epoch_us(max(published_at)) - epoch_us(min(published_at))) / 86400000000) AS BIGINT) AS span_days",
              f"{weeks} AS weeks_covered", f"{days} AS days_covered",
              f"round(count(*) / {weeks}, 2) AS avg_records_per_week", f"round(count(*) / {days}, 2) AS avg_records_per_day",
              f"{rate(spanish)} AS pct_likely_spanish", f"round(100 - avg(CASE WHEN {spanish} THEN 100.0 ELSE 0 END), 2) AS pct_likely_english"]
    parts += [f"{rate(f'{c} IS NULL')} AS null_rate_{c}" for c in fixed.NULL_CHECKED]
    parts += ["round(avg(token_count), 2) AS token_count_mean", "round(stddev_samp(token_count), 2) AS token_count_std",
              "min(token_count) AS token_count_min", "max(token_count) AS token_count_max"]
    for suffix, where in [("", "TRUE")] + [(f"_{s}", f"source = '{s}'") for s in fixed.SOURCES]:
        n = "length(body_text_clean)"
        parts += [f"round(avg({n}) FILTER (WHERE {where}), 2) AS text_length_mean{suffix}",
                  f"round(quantile_cont({n}, 0.5) FILTER (WHERE {where}), 2) AS text_length_median{suffix}",
                  f"min({n}) FILTER (WHERE {where}) AS text_length_min{suffix}", f"max({n}) FILTER (WHERE {where}) AS text_length_max{suffix}"]
    parts += [f"""{rate(f"sentiment_label = '{v}'")} AS sentiment_pct_{v}""" for v in fixed.LABELS]
    parts += ["round(avg(vader_compound), 4) AS compound_mean", "round(stddev_samp(vader_compound), 4) AS compound_std"]
    for c, s in G.OUTLIER_CHECKS.items():
        parts += [f"(SELECT outlier_rate FROM out_{c}) AS outlier_rate_{c}", f"(SELECT round(lo, 2) FROM out_{c}) AS outlier_iqr_lower_{c}",
                  f"(SELECT round(hi, 2) FROM out_{c}) AS outlier_iqr_upper_{c}"]
    for s in fixed.SOURCES:
        n = f"count(DISTINCT CASE WHEN source = '{s}' THEN bronze_source END)"
        parts += [f"{n} AS actual_runs_{s}", f"round(least({n} * 100.0 / 7, 100), 2) AS ingestion_compliance_{s}"]
    parts += ["7 AS expected_runs_weekly"]
    return f"SELECT {", ".join(parts)} FROM (SELECT *, ' ' || lower(body_text) || ' ' AS sp FROM {src})"


def _outlier_ctes(src: str = "gold") -> str:
    return ",".join(f"""
b_{c} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {src} WHERE source = '{s}'),
out_{c} AS (SELECT any_value(q1 - 1.5 * (q3 - q1)) AS lo, any_value(q3 + 1.5 * (q3 - q1)) AS hi, count({c}) AS n,
  round(count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100.0 / nullif(count({c}), 0), 2) AS outlier_rate
  FROM (SELECT {c} FROM {src} WHERE source = '{s}') CROSS JOIN b_{c})""" for c, s in G.OUTLIER_CHECKS.items())


def _gov_by_source_sql() -> str:
    """KPIs per scope: every row stands for itself in its source and in the whole."""
    def rate(condition: str) -> str:
        return f"round(avg(CASE WHEN {condition} THEN 100.0 ELSE 0 END), 2)"

    hints = " + ".join(f"(length(sp) - length(replace(sp, '{h}', ''))) // {len(h)}" for h in fixed.SPANISH_HINTS)
    spanish = f"(coalesce(length(body_text), 0) >= 40 AND ({hints}) >= 4)"
    weeks, days, n = "count(DISTINCT date_trunc('week', published_at))", "count(DISTINCT CAST(published_at AS DATE))", "length(body_text_clean)"
    keys, runs = "count(DISTINCT url) + max(CASE WHEN url IS NULL THEN 1 ELSE 0 END)", "count(DISTINCT bronze_source)"
    count = {v: f"count(*) FILTER (WHERE sentiment_label = '{v}')" for v in fixed.LABELS}
    best = f"greatest({', '.join(count.values())})"
    parts = ["CASE WHEN NOT is_total THEN any_value(source) END AS source", "is_total", "count(*) AS total_records", f"{rate('body_text_missing')} AS body_text_missing_rate",
             f"{rate(' AND '.join(f'{c} IS NOT NULL' for c in fixed.REQUIRED))} AS schema_compliance_rate",
             f"round((count(*) - ({keys})) * 100.0 / count(*), 2) AS duplicate_rate",
             "strftime(min(published_at), '%Y-%m-%d') AS first_record_date", "strftime(max(published_at), '%Y-%m-%d') AS last_record_date",
             "CAST(floor((epoch_us(max(published_at)) - epoch_us(min(published_at))) / 86400000000) AS BIGINT) AS span_days",
             f"{weeks} AS weeks_covered", f"{days} AS days_covered",
             f"round(count(*) / {weeks}, 2) AS avg_records_per_week", f"round(count(*) / {days}, 2) AS avg_records_per_day",
             f"{rate(spanish)} AS pct_likely_spanish", f"round(100 - avg(CASE WHEN {spanish} THEN 100.0 ELSE 0 END), 2) AS pct_likely_english",
             *[f"{rate(f'{c} IS NULL')} AS null_rate_{c}" for c in fixed.NULL_CHECKED],
             "round(avg(token_count), 2) AS token_count_mean", "round(stddev_samp(token_count), 2) AS token_count_std",
             "min(token_count) AS token_count_min", "max(token_count) AS token_count_max", f"round(avg({n}), 2) AS text_length_mean",
             f"round(quantile_cont({n}, 0.5), 2) AS text_length_median", f"min({n}) AS text_length_min", f"max({n}) AS text_length_max",
             "round(avg(vader_compound), 4) AS compound_mean", "round(stddev_samp(vader_compound), 4) AS compound_std",
             f"{runs} AS actual_runs", "7 AS expected_runs_weekly", f"round(least({runs} * 100.0 / 7, 100), 2) AS ingestion_compliance",
             *[f"round({c} * 100.0 / count(sentiment_label), 2) AS sentiment_pct_{v}" for v, c in count.items()],
             "CASE " + " ".join(f"WHEN {count[v]} = {best} THEN '{v}'" for v in sorted(fixed.LABELS)) + " END AS dominant",
             f"round({best} * 100.0 / count(sentiment_label), 1) AS dominant_pct",
             "CASE WHEN round(avg(vader_compound), 3) >= 0.2 THEN 'optimistic' WHEN round(avg(vader_compound), 3) >= 0.05 THEN 'positive_with_criticism' "
             "WHEN round(avg(vader_compound), 3) >= -0.05 THEN 'divided' ELSE 'critical' END AS verdict"]
    for c in G.OUTLIER_CHECKS:
        low, high = f"{c}_1 - 1.5 * ({c}_3 - {c}_1)", f"{c}_3 + 1.5 * ({c}_3 - {c}_1)"
        parts += [f"round(count(*) FILTER (WHERE {c} < {low} OR {c} > {high}) * 100.0 / nullif(count({c}), 0), 2) AS outlier_rate_{c}",
                  f"round(any_value({low}), 2) AS outlier_iqr_lower_{c}", f"round(any_value({high}), 2) AS outlier_iqr_upper_{c}"]
    quartiles = ", ".join(f"quantile_cont({c}, 0.{25 * k}) OVER (PARTITION BY scope) AS {c}_{k}" for c in G.OUTLIER_CHECKS for k in (1, 3))
    return f"""SELECT {', '.join(parts)} FROM (SELECT *, {quartiles}, ' ' || lower(body_text) || ' ' AS sp FROM (
  SELECT *, total AS is_total, CASE WHEN total THEN 't' ELSE coalesce('s' || source, 'n') END AS scope
  FROM (SELECT * REPLACE (CASE WHEN starts_with(title, 'D') THEN 'forum' WHEN NOT starts_with(title, 'E') THEN source END AS source) FROM gold),
    (VALUES (true), (false)) v(total))) GROUP BY scope, is_total"""


def _category(metric: str) -> str:
    return f"""CASE WHEN {metric} IN ({quoted(fixed.KPI_CORE)}) THEN 'Core' WHEN {metric} LIKE 'null\\_rate\\_%' ESCAPE '\\' THEN 'Completeness'
  WHEN {metric} LIKE 'outlier\\_rate\\_%' ESCAPE '\\' THEN 'Quality'
  WHEN regexp_matches({metric}, '^(ingestion_|actual_runs_|expected_runs_)') THEN 'Ingestion'
  WHEN regexp_matches({metric}, '^(text_length_|token_count_)') THEN 'Text'
  WHEN regexp_matches({metric}, '^(sentiment_pct_|compound_)') THEN 'Distribution' ELSE 'Other' END"""


def _readable(metric: str) -> str:
    known = " ".join(f"WHEN {metric} = '{name}' THEN '{text}'" for name, text in fixed.KPI_NAMES.items())
    return f"""CASE {known} WHEN {metric} LIKE 'null!_rate!_%' ESCAPE '!' THEN 'Null rate - ' || replace(replace({metric}, 'null_rate_', ''), '_', ' ')
  WHEN {metric} LIKE 'outlier!_rate!_%' ESCAPE '!' THEN 'Outlier rate - ' || replace(replace({metric}, 'outlier_rate_', ''), '_', ' ')
  ELSE array_to_string(list_transform(string_split({metric}, '_'), lambda w: upper(w[1]) || lower(w[2:])), ' ') END"""


def _kpi_sql() -> str:
    names = [c for c in G.governance_columns() if c != "pipeline_run_ts"]
    number = "TRY_CAST(v AS DOUBLE)"
    cells = " UNION ALL ".join(f"SELECT '{n}' AS metric, CAST({n} AS VARCHAR) AS v FROM gov" for n in names)
    return f"""SELECT {_category('metric')} AS "Category", {_readable('metric')} AS "KPI", metric AS "RawMetric", CASE
  WHEN v IS NULL THEN 'N/A' WHEN {number} IS NULL THEN v
  WHEN regexp_matches(metric, '_rate$|^null_rate_|^outlier_rate_|^ingestion_compliance_') THEN printf('%.2f%%', {number})
  WHEN metric IN ({quoted(fixed.KPI_WHOLE_NUMBERS)}) OR abs({number}) >= 1000 THEN format('{{:,d}}', CAST(round_even({number}, 0) AS BIGINT))
  ELSE printf('%.2f', {number}) END AS "Value" FROM ({cells})"""


QUERIES = [
    Query("typed_records", typed_records, """
SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS score,
  CASE WHEN event_type <> 'view' THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS published_at,
  CASE WHEN event_type <> 'click' THEN event_type ELSE 'Unknown' END AS author,
  CASE WHEN event_type = 'click' THEN 'x' ELSE '' END AS body FROM events"""),
    Query("union_sources", union_sources, records_sql("""
SELECT source, count(url) AS n_url, count(author) AS n_author, count(body_text) AS n_body_text, count(score) AS n_score,
  count(reading_time_min) AS n_reading_time_min FROM records GROUP BY source""")),
    Query("meta_columns", meta_columns, """
SELECT event_id, json_extract_string(props, '$.k') AS k, NULL AS absent, json_extract_string(props, '$.k') AS k_text FROM events"""),
    Query("scope_counts", scope_counts, records_sql("""
SELECT count(*) AS n FROM records WHERE source = 'scraping' AND published_at IS NOT NULL AND author IS NOT NULL""")),
    Query("dedup_first", dedup_first,
          "SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"),
    Query("duplicate_stats", duplicate_stats, """
SELECT count(*) AS total, count(*) - count(DISTINCT text) AS duplicates,
  round((count(*) - count(DISTINCT text)) * 100.0 / count(*), 2) AS duplicate_rate FROM documents"""),
    Query("dedup_stats", dedup_stats, """
SELECT count(*) AS records_before_dedup, count(DISTINCT text) AS records_after_dedup, count(*) - count(DISTINCT text) AS duplicates_removed,
  round((count(*) - count(DISTINCT text)) * 100.0 / count(*), 2) AS duplicate_rate FROM documents"""),
    Query("top_per_source", top_per_source, """
SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents QUALIFY rank <= 3"""),
    Query("null_rates", null_rates, records_sql("SELECT " + ", ".join(
        f"round(avg(CASE WHEN {c} IS NULL THEN 100.0 ELSE 0 END), 2) AS null_rate_{c}" for c in _NULLABLE) + " FROM records")),
    Query("null_rates_long", null_rates_long, records_sql(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, round((count(*) - count({c})) * 100.0 / count(*), 2) AS null_pct FROM records"
        for c in _NULLABLE))),
    Query("missing_body", missing_body, records_sql(
        "SELECT round(avg(CASE WHEN body_text_missing THEN 100.0 ELSE 0 END), 2) AS body_text_missing_rate FROM records")),
    Query("schema_compliance", schema_compliance, records_sql(
        "SELECT round(avg(CASE WHEN " + " AND ".join(f"{c} IS NOT NULL" for c in fixed.REQUIRED)
        + " THEN 100.0 ELSE 0 END), 2) AS schema_compliance_rate FROM records")),
    Query("ingestion_compliance", ingestion_compliance, records_sql("""
SELECT a AS actual_runs_reddit, b AS actual_runs_scraping, 7 AS expected_runs_weekly, round(least(a * 100.0 / 7, 100), 2) AS ingestion_compliance_reddit,
  round(least(b * 100.0 / 7, 100), 2) AS ingestion_compliance_scraping
FROM (SELECT count(DISTINCT CASE WHEN source = 'reddit' THEN bronze_source END) AS a,
  count(DISTINCT CASE WHEN source = 'scraping' THEN bronze_source END) AS b FROM records)""")),
    Query("runs", runs, records_sql("SELECT source, bronze_source, count(*) AS n FROM records GROUP BY ALL")),
    Query("time_coverage", time_coverage, """
SELECT strftime(min(t), '%Y-%m-%d') AS first_record_date, strftime(max(t), '%Y-%m-%d') AS last_record_date,
  CAST(floor((epoch_us(max(t)) - epoch_us(min(t))) / 86400000000) AS BIGINT) AS span_days,
  count(DISTINCT date_trunc('week', t)) AS weeks_covered, count(DISTINCT CAST(t AS DATE)) AS days_covered,
  round(count(*) / count(DISTINCT date_trunc('week', t)), 2) AS avg_records_per_week,
  round(count(*) / count(DISTINCT CAST(t AS DATE)), 2) AS avg_records_per_day
FROM (SELECT CASE WHEN event_type <> 'error' THEN ts END AS t FROM events)"""),
    Query("token_stats", token_stats, gold_sql("""
SELECT round(avg(token_count), 2) AS token_count_mean, round(stddev_samp(token_count), 2) AS token_count_std,
  min(token_count) AS token_count_min, max(token_count) AS token_count_max FROM gold""")),
    Query("text_length_stats", text_length_stats, """
SELECT CASE WHEN grouping(lang) = 1 THEN 'all' ELSE lang END AS lang, round(avg(length(text)), 2) AS mean,
  round(quantile_cont(length(text), 0.5), 2) AS median, min(length(text)) AS min, max(length(text)) AS max
FROM documents GROUP BY GROUPING SETS ((), (lang))"""),
    Query("text_describe", text_describe, """
WITH s AS (SELECT CAST(count(*) AS DOUBLE) AS count, avg(length(text)) AS mean, stddev_samp(length(text)) AS std, CAST(min(length(text)) AS DOUBLE) AS min,
  quantile_cont(length(text), 0.25) AS "25%", quantile_cont(length(text), 0.5) AS "50%", quantile_cont(length(text), 0.75) AS "75%",
  CAST(max(length(text)) AS DOUBLE) AS max FROM documents)
SELECT statistic, round(value, 4) AS value FROM s UNPIVOT (value FOR statistic IN (count, mean, std, min, "25%", "50%", "75%", max))"""),
    Query("short_text_share", short_text_share, records_sql("""
SELECT count(*) FILTER (WHERE length(body_text) < 400) AS n_short,
  round(count(*) FILTER (WHERE length(body_text) < 400) * 100.0 / count(*), 2) AS pct_short FROM records""")),
    Query("length_histogram", length_histogram, """
WITH l AS (SELECT length(text) AS n FROM documents),
e AS (SELECT CAST(min(n) AS DOUBLE) AS lo, quantile_cont(n, 0.99) AS hi FROM l),
b AS (SELECT least(floor((least(n, hi) - lo) / ((hi - lo) / 40)) + 1, 40) AS bin FROM l CROSS JOIN e)
SELECT r.bin, count(b.bin) AS n FROM range(1, 41) r(bin) LEFT JOIN b ON b.bin = r.bin GROUP BY r.bin"""),
    Query("price_quantiles", price_quantiles, """
SELECT l_returnflag, count(l_extendedprice) AS n, round(quantile_cont(l_extendedprice, 0.1), 4) AS q0,
  round(quantile_cont(l_extendedprice, 0.5), 4) AS q1, round(quantile_cont(l_extendedprice, 0.9), 4) AS q2 FROM lineitem GROUP BY l_returnflag"""),
    Query("iqr_outliers", iqr_outliers, """
WITH v AS (SELECT value FROM events WHERE event_type = 'purchase'),
q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM v),
b AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT count(*) AS n, count(*) FILTER (WHERE value < lower OR value > upper) AS n_outliers,
  round(count(*) FILTER (WHERE value < lower OR value > upper) * 100.0 / count(*), 2) AS outlier_rate,
  round(any_value(q1), 4) AS q1, round(any_value(q3), 4) AS q3, round(any_value(iqr), 4) AS iqr, round(any_value(lower), 4) AS lower,
  round(any_value(upper), 4) AS upper FROM v CROSS JOIN b"""),
    Query("cap_outliers", cap_outliers, """
WITH v AS (SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
q AS (SELECT event_type, quantile_cont(value, 0.25) AS a1, quantile_cont(value, 0.75) AS a3, quantile_cont(k, 0.25) AS b1,
  quantile_cont(k, 0.75) AS b3 FROM v GROUP BY event_type)
SELECT event_id, round(greatest(least(value, a3 + 1.5 * (a3 - a1)), a1 - 1.5 * (a3 - a1)), 4) AS value,
  round(greatest(least(k, b3 + 1.5 * (b3 - b1)), b1 - 1.5 * (b3 - b1)), 4) AS k FROM v JOIN q USING (event_type)"""),
    Query("cap_outliers_global", cap_outliers_global, """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a1, quantile_cont(l_extendedprice, 0.75) AS a3 FROM lineitem)
SELECT l_orderkey, l_linenumber, round(greatest(least(l_extendedprice, a3 + 1.5 * (a3 - a1)), a1 - 1.5 * (a3 - a1)), 4) AS price
FROM lineitem CROSS JOIN q"""),
    Query("impute_median", impute_median, """
WITH v AS (SELECT event_id, event_type, CASE WHEN user_id > 10 THEN value END AS value FROM events),
m AS (SELECT event_type, quantile_cont(value, 0.5) AS mid FROM v GROUP BY event_type)
SELECT event_id, round(coalesce(value, mid), 4) AS value FROM v JOIN m USING (event_type)"""),
    Query("outlier_rates", outlier_rates, gold_sql(" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, outlier_rate, CASE WHEN outlier_rate >= 10 THEN 'bad' WHEN outlier_rate > 0 THEN 'warn' ELSE 'good' END AS severity
FROM out_{c} WHERE n > 0""" for c in G.OUTLIER_CHECKS), _outlier_ctes(), tokens=False)),
    Query("batch_metrics", batch_metrics, records_sql("""
SELECT k.bronze_source, k.rows, k.duplicates, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper, n_outliers,
  round(n_outliers * 100.0 / k.rows, 2) AS outlier_pct
FROM (SELECT bronze_source, count(DISTINCT url) AS rows, count(*) - count(DISTINCT url) AS duplicates FROM a GROUP BY bronze_source) k
JOIN q USING (bronze_source) JOIN (SELECT bronze_source, count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_outliers
  FROM u JOIN q USING (bronze_source) GROUP BY bronze_source) o USING (bronze_source)""", """
a AS (SELECT * FROM records WHERE source = 'scraping'),
f AS (SELECT bronze_source, url, CASE WHEN doc_id % 7 <> 0 THEN reading_time_min + doc_id % 5 END AS w FROM a
  QUALIFY row_number() OVER (PARTITION BY bronze_source, url ORDER BY doc_id) = 1),
u AS (SELECT bronze_source, url, coalesce(w, quantile_cont(w, 0.5) OVER (PARTITION BY bronze_source)) AS v FROM f),
q AS (SELECT bronze_source, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM u GROUP BY bronze_source)""")),
    Query("batch_metrics_posts", batch_metrics_posts, records_sql("""
SELECT bronze_source, count(*) AS rows, count(*) FILTER (WHERE body_text_missing) AS empty_bodies,
  round(quantile_cont(greatest(least(score, s3 + 1.5 * (s3 - s1)), s1 - 1.5 * (s3 - s1)), 0.5), 4) AS score_median,
  round(quantile_cont(greatest(least(num_comments, k3 + 1.5 * (k3 - k1)), k1 - 1.5 * (k3 - k1)), 0.5), 4) AS num_comments_median, any_value(duplicates) AS duplicates
FROM (SELECT *, quantile_cont(score, 0.25) OVER b AS s1, quantile_cont(score, 0.75) OVER b AS s3, quantile_cont(num_comments, 0.25) OVER b AS k1,
    quantile_cont(num_comments, 0.75) OVER b AS k3
  FROM (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY bronze_source, url ORDER BY doc_id) = 1) WINDOW b AS (PARTITION BY bronze_source))
JOIN (SELECT bronze_source, count(*) - count(DISTINCT url) AS duplicates FROM a GROUP BY bronze_source) USING (bronze_source) GROUP BY bronze_source""",
        "a AS (SELECT * FROM records WHERE source = 'reddit')")),
    Query("governance_row", governance_row, gold_sql(_gov_sql(True), _outlier_ctes())),
    Query("governance_by_source", governance_by_source, gold_sql(_gov_by_source_sql())),
    Query("governance_scoped", governance_scoped, gold_sql(
        _gov_sql(False), "scoped AS (SELECT * FROM gold WHERE source = 'reddit')," + _outlier_ctes("scoped")).replace(
            "FROM records QUALIFY row_number() OVER (PARTITION BY url ORDER BY bronze_source, doc_id) = 1", "FROM records").replace(
            "AS sp FROM gold)", "AS sp FROM scoped)")),
    Query("kpi_table", kpi_table, gold_sql(_kpi_sql(), _outlier_ctes() + f", gov AS ({_gov_sql(True)})")),
    Query("kpi_names", kpi_names, gold_sql(f"""
SELECT {_category('metric')} AS "Category", {_readable('metric')} AS "KPI", metric AS "RawMetric",
  CASE WHEN metric = 'schema_compliance_rate' THEN 'good' WHEN metric NOT IN ('duplicate_rate', 'body_text_missing_rate') THEN 'neutral'
       WHEN v > 0 THEN 'bad' ELSE 'good' END AS status
FROM (""" + " UNION ALL ".join(
        f"SELECT '{c}' AS metric, " + ("(SELECT round(avg(CASE WHEN body_text_missing THEN 100.0 ELSE 0 END), 2) FROM gold WHERE source = 'scraping')"
                                       if c == "body_text_missing_rate" else "0.0") + " AS v"
        for c in G.governance_columns() if c != "pipeline_run_ts") + ")", tokens=False)),
    Query("kpi_matrix", kpi_matrix, gold_sql("""
SELECT CASE WHEN grouping(source) = 1 THEN 'global' ELSE source END AS source, round(avg(n), 2) AS mean, round(quantile_cont(n, 0.5), 2) AS median,
  CAST(min(n) AS DOUBLE) AS min, CAST(max(n) AS DOUBLE) AS max
FROM (SELECT source, length(body_text_clean) AS n FROM gold) GROUP BY GROUPING SETS ((), (source))""", tokens=False)),
    Query("null_view", null_view, gold_sql(" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, p AS null_pct, CASE WHEN p >= 10 THEN 'bad' WHEN p > 0 THEN 'warn' ELSE 'good' END AS severity
FROM (SELECT round(avg(CASE WHEN {c} IS NULL THEN 100.0 ELSE 0 END), 2) AS p FROM gold WHERE source = 'reddit')""" for c in fixed.NULL_CHECKED), tokens=False)),
]
