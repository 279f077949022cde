"""Silver tables to the gold base table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opinionlake.operators.conform import conform, union_sources
from opinionlake.operators.dedup import dedup_first
from opinionlake.operators.sentiment import Rules, with_joined_sentiment, with_sentiment
from opinionlake.operators.tokens import with_tokens
from opinionlake.schemas import GOLD_BASE, GOLD_INPUT

# Earliest file wins; the remaining columns only make the choice repeatable.
SURVIVOR_ORDER = ("bronze_source", "source", "published_at", "title")


def unify(*silver: DataFrame) -> DataFrame:
    """Union of the silver tables in the gold input schema, repeats still in."""
    return conform(union_sources(*silver), GOLD_INPUT)


def dedup_global(unified: DataFrame, key: str = "url", order: Sequence[str | Column] = SURVIVOR_ORDER) -> DataFrame:
    return dedup_first(unified, key, order)


def enrich(records: DataFrame, rules: Rules, lemma_table: DataFrame | None = None, lexicon: DataFrame | None = None,
           **token_rules) -> DataFrame:
    """Tokens and sentiment; no shuffle unless a lexicon table is to be joined in place of the rules' lexicon."""
    tokens = with_tokens(records, lemma_table=lemma_table, **token_rules)
    scored = with_sentiment(tokens, rules) if lexicon is None else with_joined_sentiment(tokens, lexicon, rules)
    return conform(scored.withColumn("token_count", F.col("token_count").cast("int")), GOLD_BASE)


def gold_base(silver: Sequence[DataFrame], rules: Rules, lemma_table: DataFrame | None = None, lexicon: DataFrame | None = None,
              **token_rules) -> DataFrame:
    """Union, one row per url, tokens, sentiment.  Write it once and read it for everything after."""
    return enrich(dedup_global(unify(*silver)), rules, lemma_table, lexicon, **token_rules)
