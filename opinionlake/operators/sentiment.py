"""Lexicon sentiment, rule by rule as in Hutto & Gilbert (ICWSM 2014), inside the row.

Each text becomes an array of word records; neighbours are read by index and the
scores are folded, so scoring needs no shuffle and no Python at any data size.
Idioms and emoji of the published implementation are not covered.
"""

from __future__ import annotations

import string
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinionlake import fixed
from opinionlake.functions.lookup import let, lookup, member
from opinionlake.functions.numbers import label
from opinionlake.functions.text import is_blank, scoring_text, squash
from opinionlake.operators.quantiles import salted_join

# Distance damping of a degree word one, two and three places before.
DAMPING = (1.0, 0.95, 0.9)


@dataclass(frozen=True)
class Rules:
    """Word tables of the scorer.  ``lexicon`` gives the valence of words; it may stay empty where a lexicon table is joined."""

    lexicon: Mapping[str, float]
    intensifiers: tuple[str, ...] = fixed.INTENSIFIERS
    dampeners: tuple[str, ...] = fixed.DAMPENERS
    negators: tuple[str, ...] = fixed.NEGATORS

    @property
    def degrees(self) -> dict[str, float]:
        return {**{w: fixed.BOOST for w in self.intensifiers}, **{w: -fixed.BOOST for w in self.dampeners}}


def starter_rules() -> Rules:
    """Rules with a lexicon of some fifty words, for a first look."""
    return Rules(dict(fixed.STARTER_LEXICON))


def lexicon_table(spark: SparkSession, path: str) -> DataFrame:
    """(word, value) of a lexicon file: token, mean valence, then ignored columns, tab-separated.

    Words that differ in case only share their mean, whatever the order of the lines.
    """
    return (spark.read.option("sep", "\t").option("quote", "").csv(path)
            .select(F.lower("_c0").alias("word"), F.col("_c1").try_cast("double").alias("value"))
            .dropna().groupBy("word").agg(F.avg("value").alias("value")))


def read_lexicon(spark: SparkSession, path: str) -> Rules:
    """Rules that hold a whole lexicon file; a lexicon too large for the plan is joined by ``with_joined_sentiment``."""
    return Rules({r["word"]: r["value"] for r in lexicon_table(spark, path).collect()})


def _bare(low: Column) -> Column:
    return let(F.btrim(low, F.lit(string.punctuation)), lambda b: F.when(F.length(b) > 2, b).otherwise(low))


def _pieces(squashed: Column) -> Column:
    return F.when(squashed == "", F.array().cast("array<string>")).otherwise(F.split(squashed, " "))


def _words(text: Column) -> Column:
    """Struct of parallel arrays: the words as written and their bare lower-case form.

    The text is lower-cased once and split in parallel with the original.
    """
    return let(squash(text), lambda t: F.struct(
        _pieces(t).alias("raw"), F.transform(_pieces(F.lower(t)), _bare).alias("low")))


def _value(word: Column, rules: Rules, values: Column | None) -> Column:
    """Valence of a bare word or null, from the map of the text's lexicon words or else from the rules' lexicon."""
    if values is not None:
        return F.try_element_at(values, word)
    # the hash-set test keeps the table scan away from words that have no entry
    return F.when(member(word, rules.lexicon), lookup(word, rules.lexicon, "double"))


def _is_caps(raw: Column) -> Column:
    # punctuation has no case: the untrimmed word answers for the trimmed one
    return (F.lower(raw) != raw) & (F.upper(raw) == raw)


def _valence(words: Column, i: Column, own: Column, rules: Rules, values: Column | None) -> Column:
    """Valence in its context of a word that is in the lexicon.

    Degree words, negators and capitals are only looked up here, for the three
    words before a hit.
    """
    def mixed_case() -> Column:
        # asked only once a word in capitals is found: another word ends the search, mostly the first
        return F.exists(words["raw"], lambda w: ~_is_caps(w))

    def low(offset: int) -> Column:
        return F.get(words["low"], i + F.lit(offset))

    def value_of(offset: int) -> Column:
        return _value(low(offset), rules, values)

    def caps(offset: int) -> Column:
        return _is_caps(F.get(words["raw"], i + F.lit(offset))) & mixed_case()

    def degree(offset: int) -> Column:
        return F.when(member(low(offset), rules.degrees), lookup(low(offset), rules.degrees, "double"))

    def negator(offset: int) -> Column:
        return member(low(offset), rules.negators) | F.contains(low(offset), F.lit("n't"))

    def is_no(offset: int) -> Column:
        return F.coalesce(low(offset) == "no", F.lit(False))

    def toward(value: Column, amount: float) -> Column:
        return F.when(value > 0, value + amount).otherwise(value - amount)

    standing_no = (low(0) == "no") & value_of(1).isNotNull()
    after_no = is_no(-1) | is_no(-2) | (is_no(-3) & low(-1).isin("or", "nor"))
    start = F.when(after_no, own * fixed.NEGATION).when(standing_no, F.lit(0.0)).otherwise(own)

    def shift(value: Column, offset: int) -> Column:
        def scaled(d: Column) -> Column:
            scalar = F.when(value < 0, -d).otherwise(d)
            loud = F.when(value > 0, scalar + fixed.CAPS_BOOST).otherwise(scalar - fixed.CAPS_BOOST)
            return F.when(d.isNull(), F.lit(0.0)).when(caps(offset), loud).otherwise(scalar)

        return let(degree(offset), scaled)

    def negated(value: Column, distance: int) -> Column:
        flipped = F.when(negator(-distance), value * fixed.NEGATION).otherwise(value)
        if distance == 1:
            return flipped
        between = [low(-d) for d in range(1, distance)]
        emphatic = F.lit(False)
        undoubted = F.lit(False)
        for word in between:
            emphatic = emphatic | word.isin("so", "this")
            undoubted = undoubted | (word == "doubt")
        return (F.when((low(-distance) == "never") & emphatic, value * 1.25)
                .when((low(-distance) == "without") & undoubted, value)
                .otherwise(flipped))

    def step(value: Column, distance: int) -> Column:
        # a neighbour that has a valence of its own does not modify this word
        applies = (i >= distance) & value_of(-distance).isNull()
        shifted = value + shift(value, -distance) * DAMPING[distance - 1]
        return F.when(applies, let(shifted, lambda v: negated(v, distance))).otherwise(value)

    def least(value: Column) -> Column:
        plain = value_of(-1).isNull() & (low(-1) == "least")
        exempt = F.coalesce(low(-2).isin("at", "very"), F.lit(False))
        return F.when(plain & ~exempt, value * fixed.NEGATION).otherwise(value)

    def emphasised(value: Column) -> Column:
        loud = F.when(value > 0, value + fixed.CAPS_BOOST).otherwise(value - fixed.CAPS_BOOST)
        return F.when(caps(0), loud).otherwise(value)

    in_context = let(let(start, emphasised), lambda a: let(step(a, 1), lambda b: let(step(b, 2), lambda c: let(step(c, 3), least))))
    kind_of = (low(0) == "kind") & F.coalesce(low(1) == "of", F.lit(False))
    return F.when(member(low(0), rules.degrees) | kind_of, F.lit(0.0)).otherwise(in_context)


def _contrast(hits: Column, words: Column) -> Column:
    """Halve what stands before the first "but", raise what follows by half."""
    def weigh(turn: Column) -> Column:
        def weighed(h: Column) -> Column:
            factor = F.when(h["i"] + 1 < turn, 0.5).when(h["i"] + 1 > turn, 1.5).otherwise(1.0)
            return F.struct(h["i"].alias("i"), (h["v"] * factor).alias("v"))

        return F.when(turn > 0, F.transform(hits, weighed)).otherwise(hits)

    return let(F.array_position(words["low"], "but"), weigh)


def _occurrences(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def score_text(text: Column, rules: Rules, values: Column | None = None) -> Column:
    """Struct (compound, pos, neg, neu) of one text."""
    emphasis = F.least(_occurrences(text, "!"), F.lit(4)) * fixed.EXCLAMATION + let(_occurrences(text, "?"), lambda marks: F.when(
        marks <= 1, 0.0).when(marks <= 3, marks * fixed.QUESTION).otherwise(fixed.QUESTION_MAX))

    def fold(hits: Column, n_words: Column) -> Column:
        # most words are neutral: they are counted, and only the others are summed
        zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("p"), F.lit(0.0).alias("n"))
        return let(F.filter(hits, lambda h: h["v"] != 0), lambda charged: let(
            F.aggregate(charged, zero, lambda acc, h: F.struct(
                (acc["s"] + h["v"]).alias("s"),
                (acc["p"] + F.when(h["v"] > 0, h["v"] + 1).otherwise(0.0)).alias("p"),
                (acc["n"] + F.when(h["v"] < 0, 1 - h["v"]).otherwise(0.0)).alias("n"))),
            lambda acc: F.struct(acc["s"].alias("s"), acc["p"].alias("p"), acc["n"].alias("n"),
                                 (n_words - F.size(charged)).cast("double").alias("u"))))

    def finish(t: Column, amp: Column) -> Column:
        total = F.when(t["s"] > 0, t["s"] + amp).when(t["s"] < 0, t["s"] - amp).otherwise(t["s"])
        p = F.when(t["p"] > t["n"], t["p"] + amp).otherwise(t["p"])
        n = F.when(t["p"] < t["n"], t["n"] + amp).otherwise(t["n"])
        return let(F.struct(total.alias("s"), p.alias("p"), n.alias("n"), (p + n + t["u"]).alias("all")), lambda x: F.struct(
            F.round(x["s"] / F.sqrt(x["s"] * x["s"] + fixed.NORMALISER), 4).alias("compound"),
            F.coalesce(F.round(F.try_divide(x["p"], x["all"]), 3), F.lit(0.0)).alias("pos"),
            F.coalesce(F.round(F.try_divide(x["n"], x["all"]), 3), F.lit(0.0)).alias("neg"),
            F.coalesce(F.round(F.try_divide(t["u"], x["all"]), 3), F.lit(0.0)).alias("neu"),
        ))

    def scored(words: Column) -> Column:
        def found(word: Column, i: Column) -> Column:
            return let(_value(word, rules, values), lambda v: F.when(v.isNotNull(), F.struct(i.alias("i"), v.alias("v"))))

        hits = F.transform(F.array_compact(F.transform(words["low"], found)), lambda h: F.struct(
            h["i"].alias("i"), _valence(words, h["i"], h["v"], rules, values).alias("v")))
        return let(hits, lambda h: let(fold(_contrast(h, words), F.size(words["raw"])),
                                     lambda t: let(emphasis, lambda amp: finish(t, amp))))

    return let(_words(text), scored)


def _paragraphs(text: Column, max_chars: int | None) -> Column:
    head = text if max_chars is None else F.substring(text, 1, max_chars)
    # white space at the ends has no part in a score
    parts = F.filter(F.split(head, "\n"), lambda p: ~is_blank(p))
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(head))


def sentiment(text: Column, is_article: Column, rules: Rules, max_chars: int | None = None, values: Column | None = None) -> Column:
    """Struct (compound, pos, neg, neu, label) of a record's scoring text.

    Articles: the mean over all paragraphs (of the first ``max_chars`` characters
    only if that is given) and the wider label band.  Other records: one score for the whole text.
    """
    # a row flag of null counts as "not an article"
    article = F.coalesce(is_article, F.lit(False))
    units = F.when(article, _paragraphs(text, max_chars)).otherwise(F.array(text))

    def mean(scores: Column) -> Column:
        n = F.size(scores)

        def total(name: str) -> Column:
            # the scores have at most four decimals, and so has their exact sum
            return F.round(F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + s[name]), 4) / n

        return F.struct(*[total(name).alias(name) for name in ("compound", "pos", "neg", "neu")])

    def labelled(m: Column) -> Column:
        band = F.when(article, fixed.ARTICLE_THRESHOLD).otherwise(fixed.SHORT_TEXT_THRESHOLD)
        # means such as 0.02995 have no exact double, so halves are rounded as decimals
        rounded = [F.round(m[name].cast("decimal(18,10)"), 4).cast("double").alias(name) for name in ("compound", "pos", "neg", "neu")]
        return F.struct(*rounded,
                        label(m["compound"], band).alias("label"))

    empty = F.struct(F.lit(0.0).alias("compound"), F.lit(0.0).alias("pos"), F.lit(0.0).alias("neg"),
                     F.lit(1.0).alias("neu"), F.lit("neutral").alias("label"))
    scores = let(F.transform(units, lambda u: score_text(u, rules, values)), lambda s: let(mean(s), labelled))
    return F.when(is_blank(text), empty).otherwise(scores)


def with_sentiment(df: DataFrame, rules: Rules, body: str = "body_text", title: str = "title", source: str = "source",
                   articles: str = fixed.ARTICLES, max_chars: int | None = None, values: str | None = None) -> DataFrame:
    """Add vader_compound, vader_pos, vader_neg, vader_neu and sentiment_label.

    ``values`` names a map column with the valence of a row's words, in place of the rules' lexicon.
    """
    scored = df.withColumn("_s", sentiment(scoring_text(F.col(body), F.col(title)), F.col(source) == articles, rules, max_chars,
                                           F.col(values) if values else None))
    return scored.withColumns({
        "vader_compound": F.col("_s.compound"), "vader_pos": F.col("_s.pos"), "vader_neg": F.col("_s.neg"),
        "vader_neu": F.col("_s.neu"), "sentiment_label": F.col("_s.label"),
    }).drop("_s")


def with_joined_sentiment(df: DataFrame, lexicon: DataFrame, rules: Rules, key: str = "url", body: str = "body_text",
                          title: str = "title", **options) -> DataFrame:
    """The same scores with a lexicon table (word, value) of any size, which is joined.

    A record's distinct words meet the lexicon once and come back as a map of the words
    that have a valence, so only the words of one record ever meet in one group.  A
    word that most records hold is dealt to many tasks.  Words that the table has more than
    once have their mean.
    """
    table = lexicon.dropna(subset=["word", "value"]).groupBy("word").agg(F.avg("value").alias("value"))
    words = let(squash(scoring_text(F.col(body), F.col(title))), lambda t: F.array_distinct(F.transform(_pieces(F.lower(t)), _bare)))
    asked = df.select(F.col(key).alias("_key"), F.explode(words).alias("word"))
    found = salted_join(asked, table, ["word"], "inner").groupBy("_key").agg(
        F.map_from_entries(F.collect_set(F.struct("word", "value"))).alias("_values"))
    joined = df.join(found, df[key].eqNullSafe(found["_key"]), "left").drop("_key")
    none = F.from_json(F.lit("{}"), "map<string,double>")
    known = joined.withColumn("_values", F.coalesce("_values", none))
    return with_sentiment(known, rules, body, title, values="_values", **options).drop("_values")
