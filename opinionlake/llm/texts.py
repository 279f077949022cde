"""Texts as bytes, in parts and runs of bounded size."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def parts(text: bytes, size: int = PART_BYTES) -> Iterator[bytes]:
    """Parts of a text, cut at white space; a longer word is in one part."""
    at = 0
    while at < len(text):
        blank = _BLANK.search(text, at + size)
        end = blank.start() if blank else len(text)
        yield text[at:end]
        at = end


def runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows whose sizes add up to about ``most``; a larger row is a run of its own."""
    begin = held = 0
    for at, size in enumerate(sizes):
        if at > begin and held + size > most:
            yield begin, at
            begin, held = at, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def byte_runs(column: pa.Array, most: int = PART_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Where a run begins, and its texts in UTF-8 (null: empty)."""
    for begin, end in runs(pc.fill_null(pc.binary_length(column), 0).to_pylist(), most):
        yield begin, [x or b"" for x in column.slice(begin, end - begin).cast(pa.binary()).to_pylist()]
