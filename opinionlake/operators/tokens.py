"""Tokens, term counts, bigrams, term sentiment."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from opinionlake.fixed import (DOMAIN_STOPWORDS, ENGLISH_STOPWORDS, LEMMAS, MIN_LEMMA, SPANISH_STOPWORDS)
from opinionlake.functions.lookup import let, lookup, member
from opinionlake.operators.quantiles import salted_join


def stop_words(*lists: Iterable[str]) -> tuple[str, ...]:
    return tuple(dict.fromkeys(word for words in lists for word in words))


DEFAULT_STOP = stop_words(ENGLISH_STOPWORDS, SPANISH_STOPWORDS, DOMAIN_STOPWORDS)


def raw_tokens(col: Column) -> Column:
    """The blank-separated pieces of a cleaned text; null gives none."""
    return F.split(F.lower(F.coalesce(col, F.lit(""))), " ")


def _is_word(piece: Column, base_stop: Iterable[str]) -> Column:
    """Letters only and not in the base list (the hash test comes first, it is the cheaper one)."""
    return ~member(piece, base_stop) & (piece != "") & ~piece.rlike(r"\P{L}")


def tokenize(col: Column, base_stop: Iterable[str] = ENGLISH_STOPWORDS,
             lemma_stop: Iterable[str] = DEFAULT_STOP, lemmas: Mapping[str, str] = LEMMAS,
             min_len: int = MIN_LEMMA, endings: Mapping[str, str] | None = None) -> Column:
    """Text to an array of lemmas, all inside the row.

    Words of the base list go first; the rest are replaced by their lemma, and
    lemmas that are too short or in a stop list go.  Forms without an entry stay, or
    follow the rule of their longest ending if ``endings`` (of ``ending_rules``) are given.
    """
    words = F.filter(raw_tokens(col), lambda w: _is_word(w, base_stop))

    def unknown(word: Column) -> Column:
        return by_ending(word, endings) if endings else word

    if lemmas:
        # the hash-set test keeps the table scan away from words that have no entry
        words = F.transform(words, lambda w: F.when(member(w, lemmas), lookup(w, lemmas, "string")).otherwise(unknown(w)))
    elif endings:
        words = F.transform(words, unknown)
    return F.filter(words, lambda w: (F.length(w) >= min_len) & ~member(w, lemma_stop))


def with_tokens(df: DataFrame, body: str = "body_text_clean", title: str = "title_clean",
                lemma_table: DataFrame | None = None, key: str = "url", join_lemmas: bool = False, **rules) -> DataFrame:
    """Add text_processed, title_processed and token_count.

    ``lemma_table(form, lemma)`` replaces the default forms.  It becomes part of
    the plan, or is joined if ``join_lemmas`` says so; the result is the same.
    """
    if lemma_table is not None:
        table = one_lemma(lemma_table)
        if join_lemmas:
            return _with_joined_lemmas(df, body, title, table, key, **rules)
        rules["lemmas"] = {r["form"]: r["lemma"] for r in table.collect()}
    return _finish(df, tokenize(F.col(body), **rules), tokenize(F.col(title), **rules))


def one_lemma(table: DataFrame) -> DataFrame:
    """One lemma per form, the first by name; entries without form or lemma are dropped."""
    return table.select("form", "lemma").dropna().groupBy("form").agg(F.min("lemma").alias("lemma"))


LONGEST_ENDING = 5
MIN_STEM = 3


def ending_rules(table: DataFrame, longest: int = LONGEST_ENDING, support: int = 3, share: float = 0.5, most: int = 10_000) -> dict[str, str]:
    """How forms with an ending become lemmas, learned from a table of (form, lemma).

    A form's edit cuts letters off its end and adds others.  Each ending of up to
    ``longest`` letters that holds the cut votes for the edit; an ending's rule is its most
    frequent edit (then the shorter cut, then the letters by name) if at least
    ``support`` forms and ``share`` of those with the ending agree.  The ``most``
    best supported rules are returned: number of letters to cut, then what to add.
    """
    same = "aggregate(sequence(1, least(length(form), length(lemma))), 0, (n, i) -> if(n = i - 1 AND substring(form, i, 1) = substring(lemma, i, 1), i, n))"
    edits = one_lemma(table).filter("length(form) > 0 AND length(lemma) > 0").withColumn("same", F.expr(same)).select(
        "form", (F.length("form") - F.col("same")).alias("cut"), F.expr("substring(lemma, same + 1)").alias("add"))
    first, last = F.greatest(F.col("cut"), F.lit(1)), F.least(F.length("form") - 1, F.lit(longest))
    votes = edits.filter((first <= last) & (F.col("cut") < 10)).select("cut", "add", F.explode(
        F.transform(F.sequence(first, last), lambda n: F.right("form", n))).alias("ending"))
    counted = votes.groupBy("ending", "cut", "add").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("ending").orderBy(F.desc("n"), "cut", "add")  # no more rows than there are edits
    best = counted.withColumn("all", F.sum("n").over(Window.partitionBy("ending"))).withColumn("rank", F.row_number().over(order)).filter(
        (F.col("rank") == 1) & (F.col("n") >= support) & (F.col("n") >= F.col("all") * share))
    kept = best.orderBy(F.desc("n"), "ending").limit(most).collect()
    return {r["ending"]: f"{r['cut']}{r['add']}" for r in kept}


def by_ending(word: Column, endings: Mapping[str, str], min_stem: int = MIN_STEM) -> Column:
    """The word by the rule of its longest known ending; a word that keeps too few letters stays as it is."""
    rule = F.lit(None).cast("string")
    for size in range(1, max(map(len, endings)) + 1):
        of_size = {e: r for e, r in endings.items() if len(e) == size}
        end = F.right(word, F.lit(size))
        if of_size:
            rule = F.when((F.length(word) > size) & member(end, of_size), lookup(end, of_size, "string")).otherwise(rule)

    def apply(found: Column) -> Column:
        stem = F.length(word) - F.substring(found, 1, 1).cast("int")
        return F.when(found.isNull() | (stem < min_stem), word).otherwise(
            F.concat(F.left(word, stem), F.substr(found, F.lit(2), F.length(found))))

    return let(rule, apply)


def _finish(df: DataFrame, body_tokens: Column, title_tokens: Column) -> DataFrame:
    # the count is taken from the stored text, so the token array is built once
    text = df.withColumns({"text_processed": F.array_join(body_tokens, " "),
                           "title_processed": F.array_join(title_tokens, " ")})
    return text.withColumn("token_count", token_count(F.col("text_processed")))


def token_count(processed: Column) -> Column:
    return F.when(processed == "", F.lit(0)).otherwise(
        F.length(processed) - F.length(F.replace(processed, F.lit(" "), F.lit(""))) + 1)


def processed_tokens(col: Column) -> Column:
    """Back from the stored text to the array; empty text gives no token."""
    return F.filter(F.split(col, " "), lambda w: w != "")


def _with_joined_lemmas(df: DataFrame, body: str, title: str, lemma_table: DataFrame, key: str,
                        base_stop: Iterable[str] = ENGLISH_STOPWORDS, lemma_stop: Iterable[str] = DEFAULT_STOP,
                        min_len: int = MIN_LEMMA, endings: Mapping[str, str] | None = None, **_: object) -> DataFrame:
    """The same result for a lemma table of any size.

    Distinct forms are resolved once and grouped back per record as a form-to-lemma
    map, so only the words of one record ever meet in one group.
    """
    forms = F.array_distinct(F.filter(F.concat(raw_tokens(F.col(body)), raw_tokens(F.col(title))),
                                      lambda w: _is_word(w, base_stop)))
    table = lemma_table.select(F.col("form").alias("_form"), F.col("lemma").alias("_lemma"))
    asked = df.select(F.col(key).alias("_key"), F.explode(forms).alias("_form"))
    # a form that most records hold is dealt to many tasks
    known = salted_join(asked, table, ["_form"], "inner").groupBy("_key").agg(
        F.map_from_entries(F.collect_set(F.struct("_form", "_lemma"))).alias("_map"))
    joined = df.join(known, df[key].eqNullSafe(known["_key"]), "left").drop("_key")

    def tokens(name: str) -> Column:
        words = F.filter(raw_tokens(F.col(name)), lambda w: _is_word(w, base_stop))
        words = F.transform(words, lambda w: F.coalesce(F.try_element_at(F.col("_map"), w), by_ending(w, endings) if endings else w))
        return F.filter(words, lambda w: (F.length(w) >= min_len) & ~member(w, lemma_stop))

    return _finish(joined, tokens(body), tokens(title)).drop("_map")


def bigrams(tokens: Column) -> Column:
    """Adjacent pairs inside one token array."""
    pairs = F.zip_with(tokens, F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(0))),
                       lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    return F.array_compact(pairs)


def top_n(df: DataFrame, count: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(count), F.asc(tie)).limit(k)


def top_terms(df: DataFrame, tokens: Column, k: int, name: str = "keyword") -> DataFrame:
    """The ``k`` most frequent array elements; equal counts in alphabetical order."""
    counts = (df.select(F.explode(tokens).alias(name))
              .groupBy(name).agg(F.count(F.lit(1)).alias("frequency")))
    return top_n(counts, "frequency", k, name)


def top_tokens(df: DataFrame, processed: str = "text_processed", k: int = 50) -> DataFrame:
    return top_terms(df, processed_tokens(F.col(processed)), k)


def top_bigrams(df: DataFrame, processed: str = "text_processed", k: int = 30) -> DataFrame:
    return top_terms(df, bigrams(processed_tokens(F.col(processed))), k, "bigram")


def match_terms(df: DataFrame, tokens: Column, terms: DataFrame, term: str = "keyword") -> DataFrame:
    """One row per record and term it contains.

    ``terms`` is a top-k list; it enters as a scalar array, and a record emits
    only the terms it holds.
    """
    wanted = terms.agg(F.collect_list(term)).scalar()
    return df.withColumn(term, F.explode(F.array_intersect(tokens, wanted)))


def term_sentiment(df: DataFrame, terms: DataFrame, processed: str = "text_processed",
                   score: str = "vader_compound", label: str = "sentiment_label") -> DataFrame:
    """For each term: records that contain it, mean score and most frequent label."""
    hits = match_terms(df, processed_tokens(F.col(processed)), terms)
    return hits.groupBy("keyword").agg(
        F.count(F.lit(1)).alias("n_mentions"),
        F.round(F.avg(score), 4).alias("compound_mean"),
        F.mode(F.col(label), True).alias("sentiment_mode"),
    )


def top_terms_scored(top: DataFrame, scored: DataFrame, k: int = 20) -> DataFrame:
    """The first ``k`` terms with their sentiment; unmatched terms count as neutral."""
    first = top_n(top, "frequency", k, "keyword")
    return first.join(scored.select("keyword", "sentiment_mode", "compound_mean"), "keyword", "left").na.fill(
        {"sentiment_mode": "neutral", "compound_mean": 0.0})


def token_quality(df: DataFrame, by: str = "source", processed: str = "text_processed") -> DataFrame:
    """Per source: records that lost every token, and mean token count."""
    return df.groupBy(by).agg(
        F.sum(F.when(F.trim(F.coalesce(F.col(processed), F.lit(""))) == "", 1).otherwise(0)).alias("empty"),
        F.round(F.avg("token_count"), 1).alias("avg_tokens"),
    )
