"""Text, tokens, sentiment, language."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from opinionlake import fixed
from opinionlake.functions import numbers as N
from opinionlake.functions import text as X
from opinionlake.functions import timeparts as TP
from opinionlake.operators import tokens as K
from opinionlake.operators.conform import filter_counts, keep_language
from opinionlake.operators.language import detect_by_ngrams, detect_language, language_hint_share, learn_profiles
from opinionlake.operators.sentiment import with_joined_sentiment, with_sentiment
from opinionlake.registry.base import Query, scratch, table
from opinionlake.registry.views import (LEXICON, RULES, MATCH_WORDS, gold_sql, gold, quoted, records, records_sql, scores_cte,
                                        scored, sql_clean, stored_gold, tokens_cte, values)
from opinionlake.sources.tables import run_counts, write_table


def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_text(F.col("text"), social=True).alias("clean"))


def clean_text_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.clean_text(F.col("html")).alias("clean"))


_DECODED = "html"
for _entity, _char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
    _DECODED = f"replace({_DECODED}, '{_entity}', '{_char}')"


def text_predicates(spark, sf):
    """Blank test, whole-word test, hints, snippets and shortening on documents."""
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", X.is_blank(text).alias("blank"), X.any_word(text, ("nicht", "eau", "with")).alias("mentions"),
        X.hint_count(text, fixed.SPANISH_HINTS).cast("long").alias("hints"),
        X.snippet(text, 300).alias("snippet"), X.shorten(text, 220).alias("short"), F.length(text).cast("long").alias("chars"))


def first_numbers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", X.first_int(F.col("c_name")).cast("long").alias("from_name"),
        X.first_int(F.col("c_mktsegment")).cast("long").alias("from_segment"))


def scoring_texts(spark, sf):
    return records(spark, sf).select("doc_id", X.scoring_text(F.col("body_text"), F.col("title")).alias("scoring_text"))


def number_bands(spark, sf):
    """Labels, bands, gauge and formats over account balances scaled to [-1, 1]."""
    score = F.round(F.col("c_acctbal") / 10000, 2)
    return table(spark, sf, "customer").select("c_custkey", score.alias("score")).select(
        "c_custkey", N.label(F.col("score"), 0.05).alias("label_short"), N.label(F.col("score"), 0.20).alias("label_article"),
        N.polarity(F.col("score")).alias("polarity"), N.verdict_class(F.col("score")).alias("verdict"),
        N.severity(F.col("score") * 20).alias("severity"), N.gauge(F.col("score")).alias("gauge"),
        N.signed(F.col("score")).alias("signed"))


def date_fallback(spark, sf):
    """Order dates written as ISO text, as day-first text, or not at all."""
    orders = table(spark, sf, "orders")
    day = F.col("o_orderdate")
    iso = F.when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.lit("soon"))
    alt = F.when(F.col("o_orderstatus") == "O", F.date_format(day, "d/M/yyyy"))
    parsed = TP.coalesce_ts(iso, alt)
    return orders.select("o_orderkey", F.date_format(parsed, "yyyy-MM-dd").alias("day"),
                         TP.week_label(parsed, fixed.UNDATED).alias("week"), TP.period_label(parsed, "month").alias("month"))


def sentiment_scores(spark, sf):
    return scored(spark, sf).select("doc_id", "vader_compound", "vader_pos", "vader_neg", "vader_neu", "sentiment_label")


def conversation_scores(spark, sf):
    """Whole-text scoring of every turn."""
    turns = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("text").alias("body_text"), F.lit(None).cast("string").alias("title"), F.lit("reddit").alias("source"))
    return with_sentiment(turns, RULES).select("conv_id", "turn", "vader_compound", "sentiment_label")


def processed_text(spark, sf):
    return gold(spark, sf).select("url", "text_processed", F.col("token_count").cast("long").alias("token_count"))


def top_tokens(spark, sf):
    """Most frequent words of all documents after the token rules."""
    docs = table(spark, sf, "documents").select(X.clean_text(F.col("text"), social=True).alias("clean"))
    return K.top_terms(docs, K.tokenize(F.col("clean")), 50)


def top_bigrams(spark, sf):
    docs = table(spark, sf, "documents").select(X.clean_text(F.col("text"), social=True).alias("clean"))
    return K.top_terms(docs, K.bigrams(K.tokenize(F.col("clean"))), 30, "bigram")


_DOC_TOKENS = f"WITH docs AS (SELECT doc_id, {sql_clean('text')} AS clean FROM documents),{tokens_cte('docs', 'clean')}"


def tokens_with_joined_lemmas(spark, sf):
    """Token counts with a lemma table larger than a literal: joined, not embedded."""
    lemmas = spark.createDataFrame(list(fixed.LEMMAS.items()), "form string, lemma string")
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("url"), X.clean_text(F.col("text"), social=True).alias("body_text_clean"),
        F.lit("").alias("title_clean"))
    out = K._with_joined_lemmas(docs, "body_text_clean", "title_clean", lemmas, "url")
    return out.select(F.col("url").cast("long").alias("doc_id"), F.col("token_count").cast("long").alias("token_count"))


def token_score(spark, sf):
    docs = stored_gold(spark, sf)
    return K.term_sentiment(docs, K.top_tokens(docs, k=20))


_TOP20 = "top20 AS (SELECT token FROM toks GROUP BY token ORDER BY count(*) DESC, token LIMIT 20)"
_HITS = "hits AS (SELECT DISTINCT t.token, g.* FROM toks t JOIN top20 USING (token) JOIN gold g USING (doc_id))"
_MODES = """modes AS (SELECT token, sentiment_label FROM (SELECT token, sentiment_label, count(*) AS n FROM hits GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY token ORDER BY n DESC, sentiment_label) = 1)"""
_TOKEN_SCORE = """SELECT h.token AS keyword, count(*) AS n_mentions, round(avg(vader_compound), 4) AS compound_mean,
  any_value(m.sentiment_label) AS sentiment_mode FROM hits h JOIN modes m ON m.token = h.token GROUP BY h.token"""


def keywords_scored(spark, sf):
    """The twenty most frequent terms, and one that no document holds."""
    docs = stored_gold(spark, sf)
    top = K.top_n(K.top_tokens(docs, k=50), "frequency", 20, "keyword")
    terms = top.unionByName(spark.createDataFrame([("-absent-", 0)], "keyword string, frequency long"))
    return K.top_terms_scored(terms, K.term_sentiment(docs, terms), 21)


def token_quality(spark, sf):
    return K.token_quality(gold(spark, sf)).withColumn("empty", F.col("empty").cast("long"))


def detect_languages(spark, sf):
    return table(spark, sf, "documents").select("doc_id", detect_language(F.col("text")).alias("detected"))


def tokens_by_ending(spark, sf):
    """Lemmas of unknown forms by rules learned from the lemma table."""
    rules = K.ending_rules(spark.createDataFrame(list(fixed.LEMMAS.items()), "form string, lemma string"))
    docs = table(spark, sf, "documents").select("doc_id", X.clean_text(F.col("text"), social=True).alias("body_text_clean"), F.lit("").alias("title_clean"))
    return K.with_tokens(docs, endings=rules).select("doc_id", "text_processed", F.col("token_count").cast("long").alias("token_count"))


_ENDINGS_SQL = f"""WITH lem(form, lemma) AS (VALUES {values(fixed.LEMMAS.items())}),
edits AS (SELECT form, lemma, list_max(list_filter(range(0, least(length(form), length(lemma)) + 1), lambda i: form[:i] = lemma[:i])) AS same FROM lem),
votes AS (SELECT right(form, n::INTEGER) AS ending, length(form) - same AS cut, lemma[same + 1:] AS add
  FROM (SELECT *, unnest(range(greatest(length(form) - same, 1), least(length(form) - 1, 5) + 1)) AS n FROM edits)),
counted AS (SELECT ending, cut, add, count(*) AS n FROM votes GROUP BY ALL),
rules AS (SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY ending) AS total, row_number() OVER (PARTITION BY ending ORDER BY n DESC, cut, add) AS k FROM counted)
  WHERE k = 1 AND n >= 3 AND n >= total * 0.5),
docs AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM (SELECT doc_id, string_split({sql_clean('text')}, ' ') AS ws FROM documents)),
kept AS (SELECT * FROM docs WHERE regexp_full_match(w, '\\p{{L}}+') AND w NOT IN ({quoted(fixed.ENGLISH_STOPWORDS)})),
forms AS (SELECT DISTINCT w FROM kept),
fits AS (SELECT w, cut, add FROM forms JOIN rules ON length(w) > length(ending) AND right(w, length(ending)::INTEGER) = ending
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY length(ending) DESC) = 1),
lemmas AS (SELECT w, coalesce(lemma, CASE WHEN length(w) - cut >= 3 THEN left(w, (length(w) - cut)::INTEGER) || add END, w) AS token
  FROM forms LEFT JOIN lem ON form = w LEFT JOIN fits USING (w)),
toks AS (SELECT doc_id, pos, token FROM kept JOIN lemmas USING (w) WHERE length(token) >= 3 AND token NOT IN ({quoted(K.DEFAULT_STOP)}))
SELECT d.doc_id, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS text_processed, count(token) AS token_count FROM documents d LEFT JOIN toks USING (doc_id) GROUP BY d.doc_id"""


def joined_lexicon_scores(spark, sf):
    """Scores with the lexicon as a table that is joined; the rules hold no word of it."""
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, value double")
    out = with_joined_sentiment(records(spark, sf), lexicon, replace(RULES, lexicon={}))
    return out.select("doc_id", "vader_compound", "vader_pos", "vader_neg", "vader_neu", "sentiment_label")


def detect_language_ngrams(spark, sf):
    """Profiles of a bounded sample of the labelled documents, applied to the first line of every document."""
    docs = table(spark, sf, "documents")
    profiles = learn_profiles(docs, most=100)
    line = F.substring_index("text", "\n", 1)
    return docs.select("doc_id", detect_by_ngrams(line, profiles).alias("detected"))


_NGRAM_DETECT = """
WITH t AS (SELECT doc_id, lang, trim(regexp_replace(lower(text), '\\P{L}+', ' ', 'g')) AS whole,
  trim(regexp_replace(lower(split_part(text, chr(10), 1)), '\\P{L}+', ' ', 'g')) AS line FROM documents),
c AS (SELECT doc_id, lang, list_transform(string_split(' ' || whole || ' ', ''), lambda x: unicode(x)) AS ws,
  list_transform(string_split(' ' || line || ' ', ''), lambda x: unicode(x)) AS ls, whole, line FROM t),
sample AS (SELECT lang, ws FROM c WHERE lang IS NOT NULL AND whole <> ''
  AND doc_id IN (SELECT doc_id FROM documents WHERE lang IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), doc_id) <= 100)),
g AS (SELECT lang, (ws[i] * 961 + ws[i + 1] * 31 + ws[i + 2]) % 4096 AS slot FROM (SELECT lang, ws, unnest(range(1, len(ws) - 1)) AS i FROM sample)),
n AS (SELECT lang, slot, count(*) AS n FROM g GROUP BY ALL),
a AS (SELECT lang, sum(n) AS total FROM n GROUP BY lang),
w AS (SELECT a.lang, s.slot, floor(ln((coalesce(n.n, 0) + 1) / (a.total + 4096)) * 1000000)::BIGINT AS w
  FROM a CROSS JOIN (SELECT unnest(range(4096)) AS slot) s LEFT JOIN n ON n.lang = a.lang AND n.slot = s.slot),
q AS (SELECT doc_id, (ls[i] * 961 + ls[i + 1] * 31 + ls[i + 2]) % 4096 AS slot FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM c WHERE line <> '')),
l AS (SELECT doc_id, lang, sum(w) AS s FROM q JOIN w USING (slot) GROUP BY ALL),
best AS (SELECT doc_id, lang FROM l QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, lang) = 1)
SELECT d.doc_id, coalesce(b.lang, 'unknown') AS detected FROM documents d LEFT JOIN best b USING (doc_id)"""


_PROFILES = values([(lang, w) for lang, ws in fixed.LANGUAGE_PROFILES.items() for w in ws])
_DETECT = f"""
lw AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS w FROM documents),
lh AS (SELECT doc_id, lang, count(*) AS n FROM lw JOIN (VALUES {_PROFILES}) p(lang, word) ON word = w GROUP BY ALL),
best AS (SELECT doc_id, lang FROM lh QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, lang) = 1),
detected AS (SELECT d.doc_id, coalesce(b.lang, 'unknown') AS detected FROM documents d LEFT JOIN best b USING (doc_id))"""


def language_filter(spark, sf):
    """Documents kept by the language filter, per declared language."""
    tagged = table(spark, sf, "documents").withColumn("detected", detect_language(F.col("text")))
    return keep_language(tagged, "detected").groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))


def filter_outcome(spark, sf):
    """Kept and skipped rows of the same filter, counted by the job that writes the kept ones."""
    root = scratch(spark, "filtered")
    tagged = table(spark, sf, "documents").withColumn("detected", detect_language(F.col("text")))
    kept, counted = filter_counts(tagged, F.col("detected") == "en", "language")
    write_table(kept, root, "english", "20240201_000000", seen={"language": counted})
    return run_counts(spark, root, "english").select("rows", F.col("counters")["language.kept"].alias("kept"),
                                                     F.col("counters")["language.skipped"].alias("skipped"))


def language_share(spark, sf):
    return language_hint_share(table(spark, sf, "documents"), "text")


_SCORES_SQL = f"""WITH {records_sql('', '')[5:].strip()},{scores_cte('records')}
SELECT * FROM scores"""
_HINTS = " + ".join(
    f"(length(t) - length(replace(t, '{h}', ''))) // {len(h)}" for h in fixed.SPANISH_HINTS)

QUERIES = [
    Query("clean_text", clean_text, f"SELECT doc_id, {sql_clean('text')} AS clean FROM documents"),
    Query("clean_text_pages", clean_text_pages,
          f"SELECT page_id, {sql_clean('html', social=False)} AS clean FROM (SELECT page_id, {_DECODED} AS html FROM pages)"),
    Query("text_predicates", text_predicates, f"""
SELECT doc_id, NOT regexp_matches(text, '\\S') AS blank,
  list_has_any({MATCH_WORDS.format('text')}, ['nicht', 'eau', 'with']) AS mentions, ({_HINTS}) AS hints,
  regexp_replace(regexp_replace(substr(text, 1, 300), '^\\s+', ''), '\\s+$', '') AS snippet,
  CASE WHEN length(text) > 220 THEN substr(text, 1, 220) || '...' ELSE text END AS short, length(text) AS chars
FROM (SELECT *, ' ' || lower(text) || ' ' AS t FROM documents)"""),
    Query("first_numbers", first_numbers, """
SELECT c_custkey, TRY_CAST(nullif(regexp_extract(c_name, '(\\d+)', 1), '') AS BIGINT) AS from_name,
  TRY_CAST(nullif(regexp_extract(c_mktsegment, '(\\d+)', 1), '') AS BIGINT) AS from_segment FROM customer"""),
    Query("scoring_texts", scoring_texts, records_sql("""
SELECT doc_id, CASE WHEN regexp_matches(coalesce(body_text, ''), '\\S') THEN body_text
  WHEN regexp_matches(coalesce(title, ''), '\\S') THEN title ELSE '' END AS scoring_text FROM records""")),
    Query("number_bands", number_bands, """
SELECT c_custkey,
  CASE WHEN score >= 0.05 THEN 'positive' WHEN score <= -0.05 THEN 'negative' ELSE 'neutral' END AS label_short,
  CASE WHEN score >= 0.20 THEN 'positive' WHEN score <= -0.20 THEN 'negative' ELSE 'neutral' END AS label_article,
  CASE WHEN score >= 0.05 THEN 'positive' WHEN score <= -0.05 THEN 'negative' ELSE 'neutral' END AS polarity,
  CASE WHEN score >= 0.2 THEN 'optimistic' WHEN score >= 0.05 THEN 'positive_with_criticism'
       WHEN score >= -0.05 THEN 'divided' ELSE 'critical' END AS verdict,
  CASE WHEN score * 20 >= 10 THEN 'bad' WHEN score > 0 THEN 'warn' ELSE 'good' END AS severity,
  round((score + 1) / 2 * 100, 1) AS gauge, printf('%+.3f', score) AS signed
FROM (SELECT c_custkey, round(c_acctbal / 10000, 2) + 0.0 AS score FROM customer)"""),
    Query("date_fallback", date_fallback, """
SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS day,
  coalesce(strftime(date_trunc('week', d), '%Y-%m-%d') || '/' || strftime(date_trunc('week', d) + INTERVAL 6 DAY, '%Y-%m-%d'), 'NaT') AS week,
  strftime(d, '%Y-%m') AS month
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderdate END AS d FROM orders)"""),
    Query("sentiment_scores", sentiment_scores, _SCORES_SQL),
    Query("conversation_scores", conversation_scores, f"""WITH turns AS (
  SELECT conv_id * 1000 + turn AS doc_id, conv_id, turn, text AS body_text, NULL::VARCHAR AS title, 'reddit' AS source FROM conversations),
{scores_cte('turns')}
SELECT conv_id, turn, vader_compound, sentiment_label FROM turns JOIN scores USING (doc_id)"""),
    Query("processed_text", processed_text, gold_sql("SELECT url, text_processed, token_count FROM gold")),
    Query("top_tokens", top_tokens, _DOC_TOKENS + """
SELECT token AS keyword, count(*) AS frequency FROM toks GROUP BY token ORDER BY frequency DESC, keyword LIMIT 50"""),
    Query("top_bigrams", top_bigrams, _DOC_TOKENS + """
SELECT bigram, count(*) AS frequency FROM (
  SELECT token || ' ' || lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS bigram FROM toks)
WHERE bigram IS NOT NULL GROUP BY bigram ORDER BY frequency DESC, bigram LIMIT 30"""),
    Query("tokens_with_joined_lemmas", tokens_with_joined_lemmas, _DOC_TOKENS + """
SELECT d.doc_id, count(t.token) AS token_count FROM documents d LEFT JOIN toks t USING (doc_id) GROUP BY d.doc_id"""),
    Query("token_score", token_score, gold_sql(_TOKEN_SCORE, f"{_TOP20},{_HITS},{_MODES}")),
    Query("keywords_scored", keywords_scored, gold_sql(f"""
SELECT t.keyword, t.frequency, coalesce(s.sentiment_mode, 'neutral') AS sentiment_mode, coalesce(s.compound_mean, 0.0) AS compound_mean
FROM ((SELECT token AS keyword, count(*) AS frequency FROM toks GROUP BY token ORDER BY frequency DESC, keyword LIMIT 20)
  UNION ALL SELECT '-absent-', 0) t LEFT JOIN ({_TOKEN_SCORE}) s USING (keyword)""", f"{_TOP20},{_HITS},{_MODES}")),
    Query("token_quality", token_quality, gold_sql("""
SELECT source, count(*) FILTER (WHERE text_processed = '') AS empty, round(avg(token_count), 1) AS avg_tokens FROM gold GROUP BY source""")),
    Query("detect_language", detect_languages, f"WITH {_DETECT}\nSELECT * FROM detected"),
    Query("detect_language_ngrams", detect_language_ngrams, _NGRAM_DETECT),
    Query("tokens_by_ending", tokens_by_ending, _ENDINGS_SQL),
    Query("joined_lexicon_scores", joined_lexicon_scores, _SCORES_SQL),
    Query("language_filter", language_filter, f"""WITH {_DETECT}
SELECT lang, count(*) AS kept FROM documents JOIN detected USING (doc_id) WHERE detected = 'en' GROUP BY lang"""),
    Query("filter_outcome", filter_outcome, f"""WITH {_DETECT}
SELECT count(*) FILTER (WHERE detected = 'en') AS rows, count(*) FILTER (WHERE detected = 'en') AS kept,
  count(*) FILTER (WHERE detected <> 'en') AS skipped FROM detected"""),
    Query("language_share", language_share, f"""
SELECT round(avg(CASE WHEN es THEN 100.0 ELSE 0 END), 2) AS pct_likely_spanish,
  round(100 - avg(CASE WHEN es THEN 100.0 ELSE 0 END), 2) AS pct_likely_english
FROM (SELECT length(text) >= 40 AND ({_HINTS}) >= 4 AS es FROM (SELECT text, ' ' || lower(text) || ' ' AS t FROM documents))"""),
]
