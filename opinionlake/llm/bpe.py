"""Byte-level BPE: encoding and decoding whole texts.

Pieces are found without regular expressions.  Each character becomes a symbol
(its class, with up to two characters of look-ahead), each symbol a function on the
states of a small automaton.  Those functions are composed by an associative scan
over all texts of a batch at once; the state before a character says whether a
piece begins there.  Pieces go through a cached pair merging by rank.

A null text is empty and gives no ids.  Rows are encoded one by one, so repeated
rows and ids give equal results, and an empty table gives no rows.  Texts are encoded
whole, in runs of about a million characters; a longer text is a run of its own and needs
memory for its characters, pieces and ids.  Columns of the result replace input columns of
the same name, all others are kept.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

# Characters of the White_Space property.
_SPACES = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# Characters handled at once, and pieces a worker remembers: memory bounds that change no result.
BATCH_CHARS = 1_000_000
CACHED_PIECES = 150_000
_NEVER = 1 << 62

# Symbols: letter, number, other, apostrophe before a one- or two-letter ending, blank or white
# space just before something visible, white space before white space or the end, end of text.
LETTER, NUMBER, OTHER, ENDING1, ENDING2, BLANK, LAST, INNER, STOP = range(9)
# States: a piece begins next; inside letters, numbers, others; after a blank that belongs to the
# next piece; inside white space; one or two letters of an ending to come.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_SPACES, ONE_MORE, TWO_MORE = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece begins at this character."""
    if symbol == LETTER and state in (ONE_MORE, TWO_MORE):
        return (FRESH if state == ONE_MORE else ONE_MORE), False
    for kind, inside in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        if symbol == kind:
            return inside, state not in (inside, AFTER_BLANK)
    if symbol in (ENDING1, ENDING2):
        if state in (IN_OTHERS, AFTER_BLANK):
            return IN_OTHERS, False
        return (ONE_MORE if symbol == ENDING1 else TWO_MORE), True
    if symbol == BLANK:
        return AFTER_BLANK, True
    if symbol == LAST:
        return FRESH, True
    if symbol == INNER:
        return IN_SPACES, state != IN_SPACES
    return FRESH, False


@lru_cache(maxsize=1)
def _machine():
    """Functions reachable by composing symbols: their products, their effect on states, the begin table."""
    states = range(8)
    of_symbol = [tuple(_step(s, x)[0] for s in states) for x in range(9)]
    known = {f: i for i, f in enumerate(dict.fromkeys(of_symbol))}
    queue = list(known)
    while queue:
        f = queue.pop()
        for g in of_symbol:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    functions = list(known)
    n = len(functions)
    product = np.array([[known[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
    effect = np.array(functions, np.uint8)
    symbols = np.array([known[f] for f in of_symbol], np.uint16)
    begins = np.array([[_step(s, x)[1] for x in range(9)] for s in states], bool)
    return product.ravel(), n, effect.ravel(), symbols, begins.ravel()


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point: letter, number, other, or LAST for white space."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = NUMBER
    table[list(_SPACES)] = LAST
    return table


def _symbols(codes: np.ndarray, stops: np.ndarray) -> np.ndarray:
    kinds = _classes()[codes]
    kinds[stops] = STOP
    after = np.append(kinds[1:], STOP)
    space = kinds == LAST
    shown = (after != LAST) & (after != STOP)
    out = np.where(space & ~shown, INNER, kinds)
    out[space & shown & (codes == 0x20)] = BLANK
    quotes = np.flatnonzero((codes == 0x27) & (kinds == OTHER))
    if len(quotes):
        padded = np.append(codes, np.zeros(2, codes.dtype))
        one, two = padded[quotes + 1], padded[quotes + 2]
        pair = one.astype(np.uint64) << np.uint64(32) | two
        out[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = ENDING1
        out[quotes[np.isin(pair, np.array([ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")], np.uint64))]] = ENDING2
    return out


def _scan(functions: np.ndarray, width: int = 64) -> np.ndarray:
    """State before each element, starting FRESH: blocks are composed, then their products scanned the same way."""
    product, n, effect, _, _ = _machine()
    if len(functions) <= width:
        states = np.empty(len(functions), np.uint8)
        state = FRESH
        for i, f in enumerate(functions.tolist()):
            states[i] = state
            state = effect[f * 8 + state]
        return states
    blocks = -(-len(functions) // width)
    padded = np.zeros(blocks * width, np.uint16)
    padded[: len(functions)] = functions
    # one row per place in a block, so every step works on whole rows
    rows = np.ascontiguousarray(padded.reshape(blocks, width).T)
    done = np.empty_like(rows)
    done[0] = rows[0]
    for j in range(1, width):
        done[j] = product[done[j - 1].astype(np.uint32) * n + rows[j]]
    entry = _scan(done[-1], width)
    states = np.empty((width, blocks), np.uint8)
    states[0] = entry
    states[1:] = effect[done[:-1].astype(np.uint32) * 8 + entry]
    return states.T.ravel()[: len(functions)]


def piece_starts(texts: list[str]) -> list[np.ndarray]:
    """For each text, the offsets in code points at which its pieces begin."""
    joined = "\0".join(texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    symbols = _symbols(codes, ends - 1)
    states = _scan(_machine()[3][symbols])
    starts = np.flatnonzero(_machine()[4][states.astype(np.uint16) * 9 + symbols])
    cuts = np.searchsorted(starts, ends)
    firsts = np.concatenate(([0], ends[:-1]))
    return [part - first for part, first in zip(np.split(starts, cuts[:-1]), firsts)]


def read_ranks(path: str) -> bytes:
    """A rank file, to be shipped to tasks: it is as large as the vocabulary."""
    with open(path, "rb") as file:
        return file.read()


class Merger(dict):
    """Piece to ids, as little-endian 32-bit numbers; remembers what it has merged."""

    def __init__(self, ranks: bytes):
        super().__init__()
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
        size = max(self.ranks.values(), default=-1) + 1
        self.pieces = np.full(size, b"", object)
        for piece, rank in self.ranks.items():
            self.pieces[rank] = piece
        self.bytes_of = {rank: rank.to_bytes(4, "little") for rank in self.ranks.values()}
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHED_PIECES:  # what is not met again before the next turn is forgotten
            self.older = dict(self)
            self.clear()
        ids = self.older.get(piece)
        if ids is None:
            ids = b"".join(map(self.bytes_of.__getitem__, self.merge(piece.encode("utf-8"))))
        self[piece] = ids
        return ids

    def rest(self) -> None:
        """Between tasks a worker waits with the pieces of late only."""
        self.older = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids after merging the pair of lowest rank, leftmost first, as long as there is one."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > 64:
            return self._merge_long(piece)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        rank = ranks.get
        costs = [rank(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while costs and (best := min(costs)) < _NEVER:
            i = costs.index(best)
            joined = parts[i] = parts[i] + parts.pop(i + 1)
            del costs[i]
            if i < len(costs):
                costs[i] = rank(joined + parts[i + 1], _NEVER)
            if i:
                costs[i - 1] = rank(parts[i - 1] + joined, _NEVER)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap of pairs over a linked list: n log n for very long pieces."""
        ranks, n = self.ranks, len(piece)
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                rank = ranks.get(piece[i:end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[i], end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, middle, stop = heapq.heappop(heap)
            # stale unless both halves are still as they were
            if end[i] != middle or after[i] >= n or end[after[i]] != stop:
                continue
            j = after[i]
            end[i], after[i] = stop, after[j]
            if after[j] < n:
                before[after[j]] = i
            end[j] = -1
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = after[i]
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and piece offsets of each text."""
        get = self.__getitem__
        for text, starts in zip(texts, piece_starts(texts)):
            at = starts.tolist()
            ids = b"".join([get(text[a:b]) for a, b in zip(at, at[1:] + [len(text)])])
            yield np.frombuffer(ids, "<u4"), starts

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.pieces[ids].tolist())


@lru_cache(maxsize=2)
def merger(ranks: bytes) -> Merger:
    return Merger(ranks)


def runs(column: pa.Array, most: int = BATCH_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Where a run begins, and its texts (null: empty), of about ``most`` bytes together.

    Only one run at a time is turned into Python texts; a longer text is a run of its own.
    """
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    begin = held = 0
    for at, size in enumerate(sizes):
        if at > begin and held + size > most:
            yield begin, [x or "" for x in column.slice(begin, at - begin).to_pylist()]
            begin, held = at, 0
        held += size
    if begin < len(sizes):
        yield begin, [x or "" for x in column.slice(begin).to_pylist()]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays], dtype=np.int64))).astype(np.int32)
    values = np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def encode(docs: DataFrame, ranks: bytes, text: str = "text", decoded: bool = False) -> DataFrame:
    """Add ``ids`` and ``piece_offsets``, the code point at which each piece begins.

    With ``decoded`` also the bytes that the ids stand for, by the same task.
    """
    numbers = T.ArrayType(T.IntegerType())
    added = [T.StructField("ids", numbers), T.StructField("piece_offsets", numbers)] + [T.StructField("decoded", T.BinaryType())] * decoded
    kept = [f for f in docs.schema.fields if f.name not in {x.name for x in added}]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, *added])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merger(ranks)
        for batch in batches:
            for at, some in runs(batch.column(names.index(text))):
                found = list(model.encode(some))
                more = [_lists([x[0] for x in found]), _lists([x[1] for x in found])]
                if decoded:
                    more.append(pa.array([model.decode(x[0]) for x in found], pa.binary()))
                yield pa.RecordBatch.from_arrays([*batch.slice(at, len(some)).columns, *more], names=schema.names)
        model.rest()

    return docs.select(*names).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: bytes, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the bytes the ids stand for; null ids give null."""
    kept = [f for f in encoded.schema.fields if f.name != "decoded"]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merger(ranks)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            decoded = [model.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else None for x in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], names=[*names, "decoded"])

    return encoded.select(*names).mapInArrow(run, schema)
