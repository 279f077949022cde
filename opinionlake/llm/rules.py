"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and
one ``fail_bits`` number in which bit k says that rule k failed.  Policies are
versioned sets of rules, applied to the ledger by a bitwise AND; ablations are
counted from the ledger alone, so texts are never read again.

A null text has no words; null and blank texts fail ``few_words``.  Repeated rows
are judged one by one, rows with equal ids too.  Columns of the ledger replace
input columns of the same name, all others are kept.  An empty table gives an empty
ledger.  Texts are measured whole, however long; a row holds the words and windows
of its text.  Windows of three words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# The white space that separates words, as in [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_WORK = ("_words", "_hashes", "_windows", "_repeats", "_lines")


@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL over the measurements; the bit is fixed once given out."""

    bit: int
    name: str
    failed: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "2 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule(4, "long_words", "word_chars > 40 * n_words"),
    Rule(5, "short_words", "2 * word_chars < 3 * n_words"),
)
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    version: int
    rules: tuple[str, ...]


POLICIES = (
    Policy(1, BASE),
    Policy(2, (*BASE, "symbols", "duplicate_lines", "long_words", "short_words")),
)


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    """The bits of the named rules."""
    bits = {rule.name: 1 << rule.bit for rule in rules}
    return sum(bits[name] for name in names)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements; a row never leaves its partition.

    Windows of three words are compared by a 64-bit hash within their document.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    size = F.size("_words")
    hashed = lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))
    hash_at = lambda k: F.get("_windows", k)["h"]
    # sorted by hash: a window is repeated if a neighbour has the same hash
    repeated = F.filter(F.sequence(F.lit(0), F.size("_windows") - 1), lambda k: F.coalesce(
        hash_at(k) == hash_at(k - 1), F.lit(False)) | F.coalesce(hash_at(k) == hash_at(k + 1), F.lit(False)))
    empty = F.array().cast("array<int>")
    # a window covers three words, less what the next one covers anyway
    covered = F.aggregate(
        F.when(F.size("_repeats") > 0, F.sequence(F.lit(0), F.size("_repeats") - 1)).otherwise(empty), F.lit(0).cast("long"),
        lambda total, k: total + F.least(F.lit(3), F.coalesce(F.get("_repeats", k + 1) - F.get("_repeats", k), F.lit(3))))
    steps = docs.drop(*MEASURES, *_WORK).withColumn("_words", F.regexp_extract_all(body, F.lit(WORD), F.lit(0)))
    steps = steps.withColumn("_hashes", F.when(size >= 3, F.transform(F.sequence(F.lit(0), size - 3), hashed)))
    # most texts repeat no window and need no positions
    steps = steps.withColumn("_windows", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), F.sort_array(
        F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    steps = steps.withColumn("_repeats", F.when(F.col("_windows").isNotNull(), F.sort_array(
        F.transform(repeated, lambda k: F.get("_windows", k)["at"]))).otherwise(empty))
    steps = steps.withColumn("_lines", F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != ""))
    return steps.withColumns({
        "n_words": size.cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOL)).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": covered,
    }).drop(*_WORK)


def ledger(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows with their measurements and ``fail_bits``."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.failed), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, text).withColumn("fail_bits", bits)


def passes(policy: Policy, rules: Sequence[Rule] = RULES, bits: str = "fail_bits") -> Column:
    """True where no rule of the policy failed."""
    return F.col(bits).bitwiseAND(F.lit(mask(policy.rules, rules)).cast("long")) == 0


def kept(book: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows without a failed rule of the policy."""
    # a filter moves below deterministic columns only; below these it would measure a text once per use
    fenced = book.withColumn("_fence", F.spark_partition_id())
    return fenced.filter(passes(policy, rules) & (F.col("_fence") >= 0)).drop("_fence")


def ablation(book: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per policy and rule: documents failing it, and documents it alone rejects.

    The ledger is first counted by ``fail_bits`` (at most 2^rules rows), so only
    that small table meets the policies.  An empty ledger gives no rows.
    """
    plan = F.array(*[F.struct(F.lit(p.version).alias("version"), F.lit(mask(p.rules, rules)).cast("long").alias("mask"),
                              F.lit(rule.name).alias("rule"), F.lit(1 << rule.bit).cast("long").alias("bit"))
                     for p in policies for rule in rules if rule.name in p.rules])
    rows = book.groupBy("fail_bits").count().select("fail_bits", "count", F.explode(plan).alias("p"))
    inside = F.col("fail_bits").bitwiseAND(F.col("p.mask"))
    return rows.groupBy("p.version", "p.rule").agg(
        F.sum(F.when(inside.bitwiseAND(F.col("p.bit")) != 0, F.col("count")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(inside == F.col("p.bit"), F.col("count")).otherwise(0)).alias("n_only_here"),
        F.sum(F.when(inside == 0, F.col("count")).otherwise(0)).alias("n_kept"))
