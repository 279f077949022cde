"""Small in-row helpers: value binding, word lookups and word sets.

Word tables are turned into literals, so a lookup costs a hash and a short scan
inside the row: no join, no shuffle, no Python.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, functions as F

_KEYS_PER_BUCKET = 4


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    The start value of a fold over nothing: unlike the elements of a transform, neither
    it nor the result is copied, however long the arrays they hold.
    """
    return F.aggregate(F.array(), value, lambda bound, _: bound, body)


def member(word: Column, words: Iterable[str]) -> Column:
    """Set membership; Catalyst turns the literal list into a hash set."""
    words = list(words)
    return word.isin(words) if words else F.lit(False)


def lookup(word: Column, table: Mapping[str, object], value_type: str) -> Column:
    """``table[word]`` or null, by hash bucket (crc32 is the same in Python and in Spark)."""
    if not table:
        return F.lit(None).cast(value_type)
    n = max(1, len(table) // _KEYS_PER_BUCKET)
    buckets: list[dict] = [{} for _ in range(n)]
    for key, value in table.items():
        buckets[zlib.crc32(key.encode("utf-8")) % n][key] = value
    # from_json of a literal is folded to an array-of-maps literal at planning time
    literal = F.from_json(F.lit(json.dumps(buckets, ensure_ascii=False)), f"array<map<string,{value_type}>>")
    slot = (F.crc32(word.cast("binary")) % F.lit(n)).cast("int")
    return F.try_element_at(F.get(literal, slot), word)
