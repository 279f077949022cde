"""Secret scans over a trigram inverted index.

Each rule's regular expression gives a Boolean query: the trigrams that every
match must contain.  Postings of the asked-for trigrams are stored; intersecting
them leaves candidates, and only those are matched.  A rule without mandatory
trigrams is matched against every text.

Offsets are code points, ends exclusive.  A null text is empty and has no spans.
Rows are told apart by id and text, so rows that share an id are judged alone and rows
that repeat get equal results.  An empty table gives no rows.  Texts are scanned whole,
however long; what was found in a text is held in its row and copied at each match.  A
column ``spans`` is replaced, all others are kept.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as kinds, _parser as parser  # the standard library's own reading of a pattern

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinionlake.llm.decontam import row_keys

_ROW = ["_r1", "_r2"]
_MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``group`` of a match has ``least`` characters or more, else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False

    @property
    def regex(self) -> str:
        return ("(?i)" if self.any_case else "") + self.pattern


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("slack", r"xox[abps]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE + MORE


def _strings(node) -> list[str] | None:
    """All strings one parsed element can be, if they are few."""
    op, value = node
    if op is kinds.LITERAL:
        return [chr(value)]
    if op is kinds.IN and all(x[0] is kinds.LITERAL for x in value):
        return [chr(x[1]) for x in value]
    if op is kinds.MAX_REPEAT and value[1] <= 2:
        return _product([value[2]] * value[1], value[0])
    if op is kinds.SUBPATTERN:
        return _product([value[3]])
    if op is kinds.BRANCH:
        parts = [_product([branch]) for branch in value[1]]
        return None if None in parts else [s for part in parts for s in part]
    return None


def _product(sequences, least: int | None = None) -> list[str] | None:
    """Strings of the sequences one after another, or of the first ``least`` and more of them."""
    found, all_found = [""], [""] if least == 0 else []
    for n, sequence in enumerate(sequences, 1):
        for node in sequence:
            part = _strings(node)
            if part is None or len(found) * len(part) > _MOST_STRINGS:
                return None
            found = [a + b for a, b in itertools.product(found, part)]
        if least is not None and n >= least:
            all_found += found
    return found if least is None else all_found


def trigram_query(rule: Rule) -> list[list[frozenset[str]]]:
    """An AND of ORs of ANDs of lower-cased trigrams; empty if nothing is mandatory."""
    query: list[list[frozenset[str]]] = []
    held = [""]

    def close() -> None:
        nonlocal held
        options = [frozenset(s.lower()[i:i + 3] for i in range(len(s) - 2)) for s in held]
        if all(options):
            query.append(sorted(set(options), key=sorted))
        held = [""]

    for node in parser.parse(rule.pattern):
        part = _strings(node)
        if part is None:
            close()
            continue
        # what can be empty or makes too many strings ends the run, to be begun anew
        if len(held) * len(part) > _MOST_STRINGS:
            close()
        held = [a + b for a, b in itertools.product(held, part)]
    close()
    return query


def dictionary(rules: Sequence[Rule]) -> list[str]:
    """The trigrams that the rules ask for."""
    return sorted({t for rule in rules for clause in trigram_query(rule) for option in clause for t in option})


def postings(docs: DataFrame, trigrams: Sequence[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(trigram, row) for each of the trigrams that a text has."""
    lowered = docs.select(*[column.alias(name) for name, column in row_keys(key, text).items()], F.lower(F.col(text)).alias("_low"))
    present = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return lowered.select(F.explode(present).alias("trigram"), *_ROW)


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows whose postings meet a rule's query, with one flag per rule; a row has no more postings than the dictionary."""
    held = index.groupBy(*_ROW).agg(F.collect_set("trigram").alias("_have"))

    def meets(rule: Rule) -> Column:
        answer = F.lit(True)
        for clause in trigram_query(rule):
            options = [F.size(F.array_intersect("_have", F.array(*map(F.lit, sorted(option))))) == len(option) for option in clause]
            either = options[0]
            for option in options[1:]:
                either = either | option
            answer = answer & either
        return answer

    asked = [rule for rule in rules if trigram_query(rule)]
    flagged = held.select(*_ROW, *[meets(rule).alias(f"_may_{rule.kind}") for rule in asked])
    return flagged.filter(F.array_contains(F.array(*[f"_may_{rule.kind}" for rule in asked]), True)) if asked else flagged


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Sorted (start, order, end) of the rule's matches: lengths of the text between matches give the places."""
    whole = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    parts = F.arrays_zip(F.split(text, rule.regex, -1).alias("gap"), whole.alias("match"),
                         F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)).alias("held"))
    kind = "struct<at:int,found:array<struct<start:int,kind:int,end:int>>>"

    def add(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["match"]), F.lit(0))
        keep = F.length(part["held"]) >= rule.least
        span = F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(keep, F.array_append(done["found"], span)).otherwise(done["found"]).alias("found"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("found")).cast(kind)
    return F.when(text.rlike(rule.regex), F.aggregate(parts, begin, add)["found"])


def scan(spark: SparkSession, docs: DataFrame, root: str, rules: Sequence[Rule] = RULES, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """The rows with ``spans``: sorted array of (start, kind, end), kind an index into ``rules``.

    The postings are stored below ``root``.
    """
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    trigrams = dictionary(rules)
    own = [c for c in docs.columns if c != "spans"]
    # other columns travel as one struct, so none of theirs can clash
    others = [c for c in own if c != text]
    keyed = docs.select((F.struct(*others) if others else F.lit(0)).alias("_others"), F.col(text).alias("_body"),
                        *[column.alias(name) for name, column in row_keys(key, text).items()])
    asked = [rule for rule in rules if trigram_query(rule)]
    if asked:
        postings(docs, trigrams, key, text).write.mode("overwrite").parquet(f"{root}/postings")
        index = spark.read.schema("trigram string, _r1 long, _r2 long").parquet(f"{root}/postings")
        keyed = keyed.join(candidates(index, rules), _ROW, "left")
    body = F.coalesce(F.col("_body"), F.lit(""))
    found = []
    for order, rule in enumerate(rules):
        spans = _spans(body, rule, order)
        if rule in asked:
            spans = F.when(F.col(f"_may_{rule.kind}"), spans)
        found.append(F.coalesce(spans, none))
    kept = [F.col("_body").alias(c) if c == text else F.col("_others")[c].alias(c) for c in own]
    return keyed.select(*kept, F.sort_array(F.concat(*found)).alias("spans"))


def listing(spans: Column, rules: Sequence[Rule], most: int | None = None) -> Column:
    """kind:start:end of the spans, comma-joined; only of the first ``most`` rules if given."""
    some = spans if most is None else F.filter(spans, lambda s: s["kind"] < most)
    names = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(scanned: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", spans: str = "spans") -> DataFrame:
    """Replace every span by <KIND>, overlapping spans by the one that begins first; drops ``spans``."""
    names = F.array(*[F.lit(f"<{rule.kind.upper()}>") for rule in rules])
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def cut(state: Column, span: Column) -> Column:
        gap = F.substring(F.col(text), state["at"] + 1, span["start"] - state["at"])
        fresh = span["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"),
                        F.when(fresh, F.concat(state["done"], gap, F.get(names, span["kind"]))).otherwise(state["done"]).alias("done"))

    cleaned = F.aggregate(F.col(spans), begin, cut, lambda s: F.concat(s["done"], F.substring(F.col(text), s["at"] + 1, 1 << 30)))
    return scanned.withColumn(text, F.when(F.size(spans) > 0, cleaned).otherwise(F.col(text))).drop(spans)
