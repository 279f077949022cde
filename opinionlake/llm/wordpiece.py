"""Word-piece counts by a linear longest-match automaton.

The vocabulary is a trie.  Where no edge fits, a failure link leads to the node
that spells what is left after popping the longest matching pieces, and how many
pieces that pops is known beforehand.  Every character is looked at once, apart
from failure links, and no piece is ever built.

Words are split at [\\x20\\x09-\\x0D].  A null text has no words.  A word that the
vocabulary cannot spell counts as one piece and as unknown.  Rows that repeat are counted
one by one, and an empty table gives no rows.  Words of any length go through the same
table, one character at a time.  Columns of the counts replace input columns of the same name;
all others are kept.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

# Words remembered by a worker, and the length up to which words go through the table together.
CACHED_WORDS = 400_000
SHORT = 48
COUNTS = ("n_words", "n_tokens", "n_unknown")
_FIRST, _NEXT = 0, 1


def byte_level_vocabulary(path: str) -> tuple[frozenset[bytes], frozenset[bytes]]:
    """Pieces that begin a word (written with a blank before it) and pieces inside words, from a rank file."""
    with open(path, "rb") as file:
        pieces = [base64.b64decode(line.split()[0]) for line in file if line.strip()]
    plain = [p for p in pieces if not p[1:].split() != ([p[1:]] if p[1:] else [])]
    return frozenset(p for p in plain if p[:1] == b" "), frozenset(p for p in plain if p.split() == [p])


class Automaton:
    """Tables of the trie over ``first`` (pieces at a word's start) and ``following`` (pieces inside)."""

    def __init__(self, first: Iterable[bytes], following: Iterable[bytes]):
        edges: dict[tuple[int, int], int] = {}
        parent, letter, piece = [-1, -1], [0, 0], [False, False]
        for root, words in ((_FIRST, first), (_NEXT, following)):
            for word in sorted(words):
                node = root
                for c in word:
                    to = edges.get((node, c))
                    if to is None:
                        to = edges[node, c] = len(parent)
                        parent.append(node)
                        letter.append(c)
                        piece.append(False)
                    node = to
                piece[node] = len(word) > 0
        n = len(parent)
        fail, pops = [-1] * n, [0] * n
        depth = [0] * n
        for v in range(2, n):  # parents come before children
            depth[v] = depth[parent[v]] + 1
        for v in sorted(range(2, n), key=depth.__getitem__):
            if piece[v]:
                fail[v], pops[v] = _NEXT, 1
                continue
            z, popped = fail[parent[v]], pops[parent[v]]
            while z >= 0 and (z, letter[v]) not in edges:
                popped += pops[z]
                z = fail[z]
            if z >= 0:
                fail[v], pops[v] = edges[z, letter[v]], popped
        # pieces popped when a word ends here; -1 if it cannot be spelled
        last = [0, 0] + [-1] * (n - 2)
        for v in sorted(range(2, n), key=depth.__getitem__):
            if fail[v] >= 0 and last[fail[v]] >= 0:
                last[v] = pops[v] + last[fail[v]]
        order = sorted(edges)
        self.edges = edges
        self.keys = np.array([v << 8 | c for v, c in order], np.int64)
        self.targets = np.array([edges[e] for e in order], np.int32)
        self.fail, self.pops, self.last = (np.array(x, np.int32) for x in (fail, pops, last))

    def _go(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        wanted = nodes.astype(np.int64) << 8 | letters
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.targets[at], -1)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word; 0 for an unknown word.  All words advance together, one character a step."""
        if not len(self.keys):
            return np.zeros(len(words), np.int32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(words) else np.zeros(0, np.int64)
        order = np.argsort(-sizes, kind="stable")  # the words still running are a prefix
        node, found = np.zeros(len(words), np.int32), np.zeros(len(words), np.int32)
        dead = np.zeros(len(words), bool)
        running = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), side="left")
        for j, n in enumerate(running.tolist()):
            some = order[:n][~dead[order[:n]]]
            letters = flat[begins[some] + j]
            to = self._go(node[some], letters)
            stuck = np.flatnonzero(to < 0)
            while len(stuck):
                who = some[stuck]
                link = self.fail[node[who]]
                dead[who[link < 0]] = True
                who, stuck, link = who[link >= 0], stuck[link >= 0], link[link >= 0]
                found[who] += self.pops[node[who]]
                node[who] = link
                to[stuck] = self._go(link, letters[stuck])
                stuck = stuck[to[stuck] < 0]
            alive = ~dead[some]
            node[some[alive]] = to[alive]
        rest = self.last[node]
        return np.where(dead | (rest < 0), 0, found + rest)

    def count(self, word: bytes) -> int:
        """Pieces of one word, character by character; for very long words."""
        node, found = _FIRST, 0
        for c in word:
            while (to := self.edges.get((node, c))) is None:
                if self.fail[node] < 0:
                    return 0
                found += int(self.pops[node])
                node = int(self.fail[node])
            node = to
        return found + int(self.last[node]) if self.last[node] >= 0 else 0


@lru_cache(maxsize=2)
def automaton(first: frozenset[bytes], following: frozenset[bytes]) -> Automaton:
    return Automaton(first, following)


def count_tokens(docs: DataFrame, first: frozenset[bytes], following: frozenset[bytes], text: str = "text",
                 lead: bytes = b" ") -> DataFrame:
    """Add words, pieces and unknown words of each text; ``lead`` is put before each word.

    The vocabulary travels with the tasks and is as large as it is, whatever the data.
    """
    kept = [f for f in docs.schema.fields if f.name not in COUNTS]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, *(T.StructField(name, T.LongType()) for name in COUNTS)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(first, following)
        known: dict[bytes, int] = {}
        for batch in batches:
            words = [(x or "").encode("utf-8").split() for x in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            if len(known) > CACHED_WORDS:
                known.clear()
            fresh = list({w for some in words for w in some if w not in known})
            short = [w for w in fresh if len(w) <= SHORT]
            known.update(zip(short, machine.counts([lead + w for w in short]).tolist()))
            known.update((w, machine.count(lead + w)) for w in fresh if len(w) > SHORT)
            pieces = [list(map(known.__getitem__, some)) for some in words]
            unknown = [some.count(0) for some in pieces]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(map(len, words)), pa.int64()),
                 pa.array([sum(some) + k for some, k in zip(pieces, unknown)], pa.int64()), pa.array(unknown, pa.int64())],
                names=[*names, *COUNTS])

    return docs.select(*names).mapInArrow(run, schema)
