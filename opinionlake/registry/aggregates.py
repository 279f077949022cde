"""Distributions, trends, comparisons, aspects and the dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinionlake import fixed
from opinionlake.operators import aspects as A
from opinionlake.operators import distribution as D
from opinionlake.plans import dashboard as B
from opinionlake.plans import story
from opinionlake.operators import tokens as K
from opinionlake.registry.base import Query, table
from opinionlake.registry.views import ASPECTS, WEEK, gold, gold_sql, matches_cte, quoted, stored_gold, stored_matches, values
from opinionlake.sources.tables import with_day_and_week


def events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# --- volumes and trends on events ------------------------------------------
def volume_by_week(spark, sf):
    return D.volume(D.with_week(events(spark, sf), "ts"), ["week", "event_type"])


def gold_by_day(spark, sf):
    """The gold base as the trend queries read it, with its day and week."""
    return with_day_and_week(stored_gold(spark, sf)).groupBy("day", "week").agg(F.count(F.lit(1)).alias("n"))


def trend_by_week(spark, sf):
    return D.trend(events(spark, sf), "ts", "event_type", "value", "week", digits=3)


def trend_by_day(spark, sf):
    return D.trend(events(spark, sf), "ts", "event_type", "value", "day", digits=3)


def score_trend(spark, sf):
    return D.score_trend(D.with_week(events(spark, sf), "ts"), ["week", "event_type"], "value", digits=3)


def _volume(grain: str):
    def run(spark, sf):
        # user 7 has gaps in daily data: cells with no event must come out as zero
        rows = events(spark, sf).withColumn("who", F.when(F.col("user_id") < 3, F.concat(F.lit("u"), F.col("user_id"))).otherwise("rest"))
        return D.volume_by_period(rows, "ts", "who", grain)
    return run


def _volume_sql(grain: str) -> str:
    fmt = "%Y-%m" if grain == "month" else "%Y-%m-%d"
    return f"""
WITH e AS (SELECT strftime(date_trunc('{grain}', ts), '{fmt}') AS period,
    CASE WHEN user_id < 3 THEN 'u' || user_id ELSE 'rest' END AS source FROM events),
n AS (SELECT period, source, count(*) AS n FROM e GROUP BY ALL)
SELECT p.period, s.source, coalesce(n.n, 0) AS n_records
FROM (SELECT DISTINCT period FROM e) p CROSS JOIN (SELECT DISTINCT source FROM e) s LEFT JOIN n USING (period, source)
UNION ALL SELECT period, 'all', count(*) FROM e GROUP BY period"""


def count_by(spark, sf):
    return D.count_by(table(spark, sf, "documents"), "source")


def label_distribution(spark, sf):
    """Label shares of the grand total, with the quality label as the sentiment."""
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return D.label_distribution(labelled, ["source"], "quality")


def label_share_by_source(spark, sf):
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return D.label_distribution(labelled, ["source"], "quality", share_within=["source"])


def pivot_source_label(spark, sf):
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    named = labelled.withColumn("label", F.when(F.col("quality") == 1, "good").otherwise("bad"))
    return D.pivot_counts(named, "source", "label", ["good", "bad"])


# --- gold based -------------------------------------------------------------
def gold_base(spark, sf):
    """The gold base table: one row per url with tokens and sentiment."""
    return gold(spark, sf).select(
        "url", "title", "author", F.col("published_at").cast("string").substr(1, 19).alias("published_at"), "body_text_missing", "source",
        "bronze_source", "score", "num_comments", "reading_time_min", "text_processed",
        F.col("token_count").cast("long").alias("token_count"), "vader_compound", "vader_pos", "vader_neg", "vader_neu", "sentiment_label")




def sentiment_dist_source(spark, sf):
    return D.label_distribution(gold(spark, sf), ["source"])


def sentiment_dist_week(spark, sf):
    return D.label_distribution(D.with_week(gold(spark, sf)), ["week"], share_within=["week"])


def sentiment_trend(spark, sf):
    return D.score_trend(D.with_week(gold(spark, sf)), ["week", "source"])


def label_shares(spark, sf):
    return D.label_share(gold(spark, sf))


def source_comparison(spark, sf):
    return D.compare_sources(gold(spark, sf))


def aspect_matches(spark, sf):
    return A.match_aspects(gold(spark, sf), aspects=ASPECTS).select("url", "aspect")


def aspect_summary(spark, sf):
    return A.aspect_summary(A.match_aspects(gold(spark, sf), aspects=ASPECTS))


_SUMMARY = """
summary AS (
  SELECT g.aspect, g.source, n_mentions, compound_mean, compound_std, pct_positive, pct_neutral, pct_negative, m.sentiment_label AS sentiment_mode
  FROM (SELECT aspect, CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source, count(*) AS n_mentions,
      round(avg(vader_compound), 4) AS compound_mean, round(stddev_samp(vader_compound), 4) AS compound_std,
      round(avg(CASE WHEN sentiment_label = 'positive' THEN 100.0 ELSE 0 END), 2) AS pct_positive,
      round(avg(CASE WHEN sentiment_label = 'neutral' THEN 100.0 ELSE 0 END), 2) AS pct_neutral,
      round(avg(CASE WHEN sentiment_label = 'negative' THEN 100.0 ELSE 0 END), 2) AS pct_negative
    FROM matches GROUP BY GROUPING SETS ((aspect), (aspect, source))) g
  JOIN (SELECT aspect, source, sentiment_label FROM (
      SELECT aspect, source, sentiment_label, count(*) AS n FROM matches GROUP BY ALL
      UNION ALL SELECT aspect, 'all', sentiment_label, count(*) FROM matches GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY aspect, source ORDER BY n DESC, sentiment_label) = 1) m
  ON m.aspect = g.aspect AND m.source = g.source)"""


def aspect_cowords(spark, sf):
    return A.aspect_cowords(stored_matches(spark, sf), ASPECTS, blocklist=_BLOCKED)


# blocks some of the most frequent words
_BLOCKED = fixed.COWORD_BLOCKLIST + ("thth", "thon", "erin", "thin", "than", "ther", "ion", "ment", "den", "eux")
_OWN = values([(a, w) for a, ws in ASPECTS.items() for w in ws])
_COWORDS = f"""
words AS (SELECT m.aspect, m.sentiment_label AS sentiment, t.token AS word, count(*) AS frequency
  FROM matches m JOIN toks t USING (doc_id) GROUP BY ALL),
kept AS (SELECT p.* FROM words p LEFT JOIN (VALUES {_OWN}) o(aspect, word) ON o.aspect = p.aspect AND o.word = p.word
  WHERE o.word IS NULL AND p.word NOT IN ({quoted(_BLOCKED)}) AND length(p.word) >= 3),
cowords AS (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY aspect, sentiment ORDER BY frequency DESC, word) <= 10),
docs AS (SELECT aspect, sentiment_label AS sentiment, count(*) AS n_docs FROM matches GROUP BY ALL)"""


def aspect_snippets(spark, sf):
    return A.aspect_snippets(stored_matches(spark, sf)).withColumn("rank", F.col("rank").cast("long"))


_SNIPPETS = """
cut AS (SELECT aspect, url, trim(substr(coalesce(nullif(body_text, ''), title, ''), 1, 300), ' ' || chr(10)) AS text_snippet,
    vader_compound, sentiment_label, source, substr(coalesce(title, ''), 1, 120) AS title FROM matches),
snippets AS (
  SELECT aspect, 'positive' AS sentiment_pole, row_number() OVER (PARTITION BY aspect ORDER BY vader_compound DESC, url) AS rank,
    text_snippet, vader_compound, sentiment_label, source, title FROM cut QUALIFY rank <= 3
  UNION ALL
  SELECT aspect, 'negative', row_number() OVER (PARTITION BY aspect ORDER BY vader_compound, url) AS rank,
    text_snippet, vader_compound, sentiment_label, source, title FROM cut QUALIFY rank <= 3)"""


def best_worst_aspect(spark, sf):
    return A.extremes(A.aspect_summary(stored_matches(spark, sf)))


def aspect_overview(spark, sf):
    return B.aspect_view(A.aspect_summary(stored_matches(spark, sf)))


def drilldown_snippets(spark, sf):
    found = stored_matches(spark, sf).filter(F.col("aspect") == "health")
    empty = A.aspect_summary(found)
    parts = B.drilldown_view(empty, A.aspect_cowords(found, ASPECTS), A.aspect_snippets(found), "health")
    return parts["snippets"].select("sentiment_pole", "text_snippet", "score_text", "source")


def drilldown_cowords(spark, sf):
    found = stored_matches(spark, sf).filter(F.col("aspect") == "health")
    return A.drilldown(A.aspect_summary(found), A.aspect_cowords(found, ASPECTS, blocklist=_BLOCKED),
                       A.aspect_snippets(found), "health")["cowords"]


def run_summary(spark, sf):
    docs = stored_gold(spark, sf)
    one = story.run_summary(docs, K.top_tokens(docs, k=50), "20240201_000000", aspects=ASPECTS)
    return one.withColumns({c: F.array_join(c, ",") for c in ("sources", "aggregations_saved", "aspects_analyzed")}).withColumn(
        "weeks_covered", F.col("weeks_covered").cast("long"))


def verdict(spark, sf):
    return B.verdict_view(gold(spark, sf)).withColumns({c: F.col(c).cast("long") for c in ("total", "n_reddit", "n_scraping")})


def trend_delta(spark, sf):
    return D.trend_delta(gold(spark, sf), "published_at", "vader_compound", "week")


def coverage_gap(spark, sf):
    return D.coverage_gap(gold(spark, sf), "published_at", "day")


def source_gap(spark, sf):
    return D.source_gap(D.compare_sources(gold(spark, sf)))


def pivot_week_label(spark, sf):
    return D.pivot_counts(D.with_week(gold(spark, sf)), "week", "sentiment_label", fixed.LABELS)


def pivot_week_source(spark, sf):
    return D.pivot_counts(D.volume(D.with_week(gold(spark, sf)), ["week", "source"]), "week", "source", fixed.SOURCES, "n_records")


def bigram_view(spark, sf):
    return B.bigram_view(K.top_bigrams(gold(spark, sf), k=30))


def sample_record(spark, sf):
    return D.sample_rows(gold(spark, sf), "url").select("url", "source", "title", "vader_compound", "sentiment_label")


_W = WEEK.format("published_at")
_COMPARE = """
cmp AS (SELECT source, count(url) AS n_records, round(avg(vader_compound), 4) AS compound_mean,
    round(stddev_samp(vader_compound), 4) AS compound_std,
    round(avg(CASE WHEN sentiment_label = 'positive' THEN 100.0 ELSE 0 END), 4) AS pct_positive,
    round(avg(CASE WHEN sentiment_label = 'neutral' THEN 100.0 ELSE 0 END), 4) AS pct_neutral,
    round(avg(CASE WHEN sentiment_label = 'negative' THEN 100.0 ELSE 0 END), 4) AS pct_negative,
    round(avg(token_count), 4) AS avg_token_count FROM gold GROUP BY source)"""
_MATCH = matches_cte()

QUERIES = [
    Query("volume_by_week", volume_by_week, f"SELECT {WEEK.format('ts')} AS week, event_type, count(*) AS n_records FROM events GROUP BY ALL"),
    Query("trend_by_week", trend_by_week,
          f"SELECT {WEEK.format('ts')} AS period, event_type, round(avg(value), 3) AS mean, count(*) AS n FROM events GROUP BY ALL"),
    Query("trend_by_day", trend_by_day,
          "SELECT strftime(ts, '%Y-%m-%d') AS period, event_type, round(avg(value), 3) AS mean, count(*) AS n FROM events GROUP BY ALL"),
    Query("score_trend", score_trend,
          f"SELECT {WEEK.format('ts')} AS week, event_type, round(avg(value), 3) AS compound_mean, count(value) AS n_records FROM events GROUP BY ALL"),
    *[Query(f"volume_zero_filled_{g}", _volume(g), _volume_sql(g)) for g in ("day", "week", "month")],
    Query("gold_by_day", gold_by_day, gold_sql("""
SELECT strftime(published_at, '%Y-%m-%d') AS day, coalesce(strftime(date_trunc('week', published_at), '%Y-%m-%d') || '/' ||
  strftime(date_trunc('week', published_at) + INTERVAL 6 DAY, '%Y-%m-%d'), 'NaT') AS week, count(*) AS n FROM gold GROUP BY ALL""", tokens=False)),
    Query("count_by_source", count_by, "SELECT source, count(*) AS n FROM documents GROUP BY source"),
    Query("label_distribution", label_distribution, """
SELECT source, quality, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct
FROM documents JOIN labels USING (doc_id) GROUP BY source, quality"""),
    Query("label_share_by_source", label_share_by_source, """
SELECT source, quality, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY source), 2) AS pct
FROM documents JOIN labels USING (doc_id) GROUP BY source, quality"""),
    Query("pivot_source_label", pivot_source_label, """
SELECT source, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE quality <> 1) AS bad
FROM documents JOIN labels USING (doc_id) GROUP BY source"""),
    Query("gold_base", gold_base, gold_sql("""
SELECT url, title, author, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, body_text_missing, source, bronze_source, score, num_comments,
  reading_time_min, text_processed, token_count, vader_compound, vader_pos, vader_neg, vader_neu, sentiment_label FROM gold""")),
    Query("sentiment_distribution", sentiment_dist_source, gold_sql("""
SELECT source, sentiment_label, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM gold GROUP BY ALL""", tokens=False)),
    Query("label_distribution_by_week", sentiment_dist_week, gold_sql(f"""
SELECT week, sentiment_label, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY week), 2) AS pct
FROM (SELECT {_W} AS week, sentiment_label FROM gold) GROUP BY week, sentiment_label""", tokens=False)),
    Query("sentiment_trend", sentiment_trend, gold_sql(f"""
SELECT {_W} AS week, source, round(avg(vader_compound), 4) AS compound_mean, count(vader_compound) AS n_records FROM gold GROUP BY ALL""", tokens=False)),
    Query("label_shares", label_shares, gold_sql("SELECT " + ", ".join(
        f"round(avg(CASE WHEN sentiment_label = '{v}' THEN 100.0 ELSE 0 END), 2) AS sentiment_pct_{v}" for v in fixed.LABELS) + " FROM gold", tokens=False)),
    Query("source_comparison", source_comparison, gold_sql("SELECT * FROM cmp", _COMPARE)),
    Query("aspect_matches", aspect_matches, gold_sql("SELECT url, aspect FROM matches", _MATCH, tokens=False)),
    Query("aspect_summary", aspect_summary, gold_sql("SELECT * FROM summary", f"{_MATCH},{_SUMMARY}", tokens=False)),
    Query("aspect_cowords", aspect_cowords, gold_sql(
        "SELECT c.*, d.n_docs FROM cowords c JOIN docs d ON d.aspect = c.aspect AND d.sentiment = c.sentiment", f"{_MATCH},{_COWORDS}")),
    Query("aspect_snippets", aspect_snippets, gold_sql("SELECT * FROM snippets", f"{_MATCH},{_SNIPPETS}", tokens=False)),
    Query("best_worst", best_worst_aspect, gold_sql("""
SELECT * FROM (SELECT 'best' AS kind, aspect, compound_mean, n_mentions, pct_positive, pct_negative FROM summary WHERE source = 'all'
  ORDER BY compound_mean DESC, aspect LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'worst', aspect, compound_mean, n_mentions, pct_positive, pct_negative FROM summary WHERE source = 'all'
  ORDER BY compound_mean, aspect LIMIT 1)""", f"{_MATCH},{_SUMMARY}", tokens=False)),
    Query("aspect_overview", aspect_overview, gold_sql("""
SELECT aspect, upper(aspect[1]) || lower(aspect[2:]) AS label, compound_mean,
  CASE WHEN compound_mean >= 0.05 THEN 'positive' WHEN compound_mean <= -0.05 THEN 'negative' ELSE 'neutral' END AS band,
  n_mentions, pct_positive, pct_negative FROM summary WHERE source = 'all'""", f"{_MATCH},{_SUMMARY}", tokens=False)),
    Query("drilldown_snippets", drilldown_snippets, gold_sql("""
SELECT sentiment_pole, CASE WHEN length(text_snippet) > 220 THEN substr(text_snippet, 1, 220) || '...' ELSE text_snippet END AS text_snippet,
  printf('%+.3f', vader_compound) AS score_text, source FROM snippets WHERE aspect = 'health' AND rank <= 2""", f"{_MATCH},{_SNIPPETS}", tokens=False)),
    Query("drilldown_cowords", drilldown_cowords, gold_sql("""
SELECT c.*, d.n_docs FROM cowords c JOIN docs d ON d.aspect = c.aspect AND d.sentiment = c.sentiment
WHERE c.aspect = 'health' AND c.sentiment IN ('positive', 'negative')""", f"{_MATCH},{_COWORDS}")),
    Query("run_summary", run_summary, gold_sql(f"""
SELECT '20240201_000000' AS pipeline_run_ts, count(*) AS total_records, string_agg(DISTINCT source, ',' ORDER BY source) AS sources,
  count(DISTINCT {_W}) AS weeks_covered, (SELECT token FROM toks GROUP BY token ORDER BY count(*) DESC, token LIMIT 1) AS top_keyword,
  (SELECT sentiment_label FROM gold GROUP BY sentiment_label ORDER BY count(*) DESC, sentiment_label LIMIT 1) AS overall_sentiment,
  round(avg(vader_compound), 4) AS overall_compound, '{','.join(story.TABLES)}' AS aggregations_saved, '{','.join(ASPECTS)}' AS aspects_analyzed
FROM gold""")),
    Query("verdict", verdict, gold_sql("""
SELECT *, round((compound + 1) / 2 * 100, 1) AS gauge, printf('%+.3f', compound) AS compound_text,
  CASE WHEN compound >= 0.2 THEN 'optimistic' WHEN compound >= 0.05 THEN 'positive_with_criticism'
       WHEN compound >= -0.05 THEN 'divided' ELSE 'critical' END AS verdict
FROM (SELECT count(*) AS total, (SELECT sentiment_label FROM gold GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS dominant,
  (SELECT round(max(n) * 100.0 / sum(n), 1) FROM (SELECT count(*) AS n FROM gold GROUP BY sentiment_label)) AS dominant_pct,
  round(count(*) FILTER (WHERE sentiment_label = 'positive') * 100.0 / count(*), 1) AS positive_pct,
  round(count(*) FILTER (WHERE sentiment_label = 'neutral') * 100.0 / count(*), 1) AS neutral_pct,
  round(count(*) FILTER (WHERE sentiment_label = 'negative') * 100.0 / count(*), 1) AS negative_pct,
  round(avg(vader_compound), 3) AS compound, count(*) FILTER (WHERE source = 'reddit') AS n_reddit,
  count(*) FILTER (WHERE source = 'scraping') AS n_scraping FROM gold)""", tokens=False)),
    Query("trend_delta", trend_delta, gold_sql(f"""
SELECT n_periods, round(CASE WHEN n_periods >= 2 THEN d END, 4) AS delta,
  CASE WHEN n_periods < 2 THEN NULL WHEN d > 0.05 THEN 'up' WHEN d < -0.05 THEN 'down' ELSE 'flat' END AS direction
FROM (SELECT count(*) AS n_periods, arg_max(m, p) - arg_min(m, p) AS d
  FROM (SELECT {_W} AS p, avg(vader_compound) AS m FROM gold WHERE source = 'scraping' GROUP BY 1))""", tokens=False)),
    Query("coverage_gap", coverage_gap, gold_sql("""
SELECT n_reddit, n_scraping, n_reddit < n_scraping AS unequal FROM (
  SELECT count(DISTINCT CASE WHEN source = 'reddit' THEN CAST(published_at AS DATE) END) AS n_reddit,
    count(DISTINCT CASE WHEN source = 'scraping' THEN CAST(published_at AS DATE) END) AS n_scraping FROM gold)""", tokens=False)),
    Query("source_gap", source_gap, gold_sql("""
SELECT diff_positive, diff_negative,
  CASE WHEN abs(diff_positive) > 8 THEN CASE WHEN diff_positive > 0 THEN 'scraping' ELSE 'reddit' END END AS more_positive,
  CASE WHEN abs(diff_negative) > 8 THEN CASE WHEN diff_negative > 0 THEN 'reddit' ELSE 'scraping' END END AS more_critical,
  abs(diff_positive) <= 8 AND abs(diff_negative) <= 8 AS aligned
FROM (SELECT round(max(pct_positive) FILTER (WHERE source = 'scraping') - max(pct_positive) FILTER (WHERE source = 'reddit'), 1) AS diff_positive,
  round(max(pct_negative) FILTER (WHERE source = 'reddit') - max(pct_negative) FILTER (WHERE source = 'scraping'), 1) AS diff_negative FROM cmp)""", _COMPARE)),
    Query("pivot_week_label", pivot_week_label, gold_sql(
        f"SELECT {_W} AS week, " + ", ".join(f"count(*) FILTER (WHERE sentiment_label = '{v}') AS {v}" for v in fixed.LABELS) + " FROM gold GROUP BY 1", tokens=False)),
    Query("pivot_week_source", pivot_week_source, gold_sql(
        f"SELECT {_W} AS week, " + ", ".join(f"count(*) FILTER (WHERE source = '{v}') AS {v}" for v in fixed.SOURCES) + " FROM gold GROUP BY 1", tokens=False)),
    Query("bigram_view", bigram_view, gold_sql("""
SELECT bigram, count(*) AS frequency FROM (
  SELECT token || ' ' || lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS bigram FROM toks)
WHERE bigram IS NOT NULL GROUP BY bigram ORDER BY frequency DESC, bigram LIMIT 15""")),
    Query("sample_record", sample_record, gold_sql(
        "SELECT url, source, title, vader_compound, sentiment_label FROM gold ORDER BY url LIMIT 1", tokens=False)),
]
