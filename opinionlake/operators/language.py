"""Language by function words, and by profiles of letter sequences learned from labelled texts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from opinionlake import fixed
from opinionlake.functions.lookup import let, member
from opinionlake.functions.numbers import share
from opinionlake.functions.text import hint_count
from opinionlake.operators.dedup import top_per_group


def detect_language(col: Column, profiles: Mapping[str, Iterable[str]] = fixed.LANGUAGE_PROFILES) -> Column:
    """The language with most function-word hits; equal hits go to the first name, none is ``unknown``."""
    names = sorted(profiles)
    words = F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))

    def best(tokens: Column) -> Column:
        def hits_of(i: int, name: str) -> Column:
            known = F.filter(tokens, lambda w: member(w, profiles[name]))
            return F.struct(F.size(known).alias("hits"), F.lit(-i).alias("order"), F.lit(name).alias("lang"))

        hits = [hits_of(i, name) for i, name in enumerate(names)]
        return let(F.array_max(F.array(*hits)),
                   lambda top: F.when(top["hits"] > 0, top["lang"]).otherwise(F.lit("unknown")))

    return let(words, best)


# Three letters in a row are hashed to so many slots; a profile has a number for each.
SLOTS = 4096
# Most texts of a language that a profile is learned from.
PROFILE_TEXTS = 500


@dataclass(frozen=True)
class NgramProfiles:
    """For each language, the logarithm of each slot's share in millionths."""

    weights: Mapping[str, tuple[int, ...]]


def ngram_slots(col: Column) -> Column:
    """The slot of every three neighbouring letters of a lower-cased text; words are set apart by one blank.

    A null text, or one without letters, has none.
    """
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), r"\P{L}+", " "))
    letters = F.filter(F.split(F.concat(F.lit(" "), plain, F.lit(" ")), ""), lambda c: c != "")
    codes = F.transform(letters, lambda c: F.ascii(c))

    def slots(c: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(c) - 3), lambda i: (
            (F.get(c, i) * 961 + F.get(c, i + 1) * 31 + F.get(c, i + 2)) % SLOTS).cast("int"))

    return F.when(plain == "", F.array().cast("array<int>")).otherwise(let(codes, slots))


def learn_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", most: int = PROFILE_TEXTS) -> NgramProfiles:
    """Profiles from at most ``most`` texts of each language, those with the smallest hash of their key; texts are used whole.

    Slots are counted by Spark; the driver gets ``SLOTS`` counts for each language.
    """
    order = [F.md5(F.col(key).cast("string").cast("binary")), F.col(key)]
    chosen = top_per_group(labelled.filter(F.col(lang).isNotNull()), lang, order, most)
    counts = chosen.select(F.col(lang).alias("lang"), F.explode(ngram_slots(F.col(text))).alias("slot")).groupBy("lang", "slot").agg(
        F.count(F.lit(1)).alias("n"))
    shares = counts.groupBy("lang").agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("m")).select(
        "lang", F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.floor(
            F.log((F.coalesce(F.try_element_at("m", i), F.lit(0)) + 1) / (F.col("all") + SLOTS)) * 1_000_000).cast("long")).alias("w"))
    return NgramProfiles({r["lang"]: tuple(r["w"]) for r in shares.collect()})


def detect_by_ngrams(col: Column, profiles: NgramProfiles) -> Column:
    """The language under which a text's letter sequences are most likely; equal ones go to the first name.

    A text without letters is ``unknown``.  The sums are taken in the row, over whole numbers.
    """
    names = sorted(profiles.weights)

    def best(slots: Column) -> Column:
        def likelihood(i: int, name: str) -> Column:
            table = F.from_json(F.lit(str(list(profiles.weights[name]))), "array<bigint>")  # folded to a literal
            total = F.aggregate(slots, F.lit(0).cast("long"), lambda s, slot: s + F.get(table, slot))
            return F.struct(total.alias("sum"), F.lit(-i).alias("order"), F.lit(name).alias("lang"))

        top = F.array_max(F.array(*[likelihood(i, name) for i, name in enumerate(names)]))
        return F.when(F.size(slots) > 0, top["lang"]).otherwise(F.lit("unknown"))

    return let(ngram_slots(col), best) if names else F.lit("unknown")


def looks_spanish(text: Column, hints: Iterable[str] = fixed.SPANISH_HINTS,
                  min_hits: int = fixed.HINT_MIN_HITS) -> Column:
    """Long enough and at least ``min_hits`` padded function words."""
    long_enough = F.coalesce(F.length(text) >= fixed.HINT_MIN_CHARS, F.lit(False))
    return F.when(long_enough, hint_count(text, hints) >= min_hits).otherwise(F.lit(False))


def language_hint_share(df: DataFrame, text: str = "body_text", hints: Iterable[str] = fixed.SPANISH_HINTS,
                        min_hits: int = fixed.HINT_MIN_HITS) -> DataFrame:
    """One row: share of records that look Spanish, and the rest."""
    spanish = share(looks_spanish(F.col(text), hints, min_hits))
    return df.agg(F.round(spanish, 2).alias("pct_likely_spanish"),
                  F.round(100 - spanish, 2).alias("pct_likely_english"))
