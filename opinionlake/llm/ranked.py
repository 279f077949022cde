"""Ranked lexical search with hashed max-sketches.

The index has a row per document: its terms, their occurrences, and a sketch.  Terms
are hashed to the sketch's coordinates, of which there are several for each term, and a
coordinate keeps the largest impact of its terms.  In one document the impact grows
with a term's occurrences alone, so the sketch keeps those, and needs no statistics
of the corpus until a search.

A search looks up the terms of all its items in the sketches of a run of documents.
The weighted sums are upper bounds of the scores; documents are scored exactly in
descending order of their bounds until the bounds fall below the last score that is
still among the best.  Tasks return their best documents of each item.  Items
come in blocks of bounded size, each a job over the index.

A null or empty text, or one without terms, is in no result and not counted among the
documents; such an item has no results.  Rows that repeat are ranked each.  Equal
scores are ordered by document id, a null id last.  Repeated items, and items without
an id, are each ranked.  An empty table gives no rows.  Long texts are read in parts.
Columns other than those named are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from opinionlake.llm.texts import byte_runs, parts, runs

BEST = 10
COORDINATES = 8  # of a sketch, for each term of its document
LEAST_COORDINATES = 64
FULL = 255  # in a sketch: so many occurrences or more
BLOCK_BYTES = 1 << 20
RUN_CELLS = 1 << 22
SALTS = 64

# every ASCII character but letters and digits ends a term; A-Z become a-z
_TERMS = bytes((c + 32 if 65 <= c <= 90 else c) if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def count_terms(text: bytes) -> Counter:
    """Occurrences of each term of a text."""
    found: Counter = Counter()
    for part in parts(text):
        found.update(part.translate(_TERMS).split())
    return found


def _hashes(terms: Iterable[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, terms), np.int64)


def sketch(terms: list[bytes], occurrences: np.ndarray) -> np.ndarray:
    """The largest number of occurrences at each coordinate, a power of two of them."""
    size = LEAST_COORDINATES
    while size < COORDINATES * len(terms):
        size *= 2
    made = np.zeros(size, np.uint8)
    np.maximum.at(made, _hashes(terms) & (size - 1), np.minimum(occurrences, FULL).astype(np.uint8))
    return made


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, occurrences, sketch) of each document that has terms."""
    names = ["doc_id", "n", "terms", "occurrences", "sketch"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in byte_runs(batch.column(1)):
                counted = [count_terms(t) for t in texts]
                some = [i for i, c in enumerate(counted) if c]
                terms = [list(counted[i]) for i in some]
                times = [np.fromiter(counted[i].values(), np.int64) for i in some]
                ends = np.cumsum([0, *map(len, times)]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.int64), *times])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array([begin + i for i in some], pa.int64())), pa.array([int(t.sum()) for t in times], pa.int64()),
                    pa.array(map(b" ".join, terms), pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    pa.array([sketch(a, b).tobytes() for a, b in zip(terms, times)], pa.binary())], names=names)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text))
    return rows.mapInArrow(run, "doc_id long, n long, terms binary, occurrences array<long>, sketch binary")


def weight(documents: int, holding: int) -> int:
    """Weight of a term that ``holding`` of ``documents`` hold, in thousandths."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impact(times: int, length: int) -> int:
    """Share of a term's weight that its occurrences in a document earn, in millionths."""
    return 1_000_000_000 * times // (1000 * times + 8 * length)


def relative_length(n: int, documents: int, terms: int) -> int:
    return 25 + 75 * n * documents // terms


@dataclass(frozen=True)
class Block:
    """Items of a search, by number: their terms as numbers, and how often each has them."""

    vocabulary: dict[bytes, int]
    items: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(texts: list[bytes]) -> "Block":
        vocabulary: dict[bytes, int] = {}
        items = []
        for text in texts:
            counted = count_terms(text)
            numbers = [vocabulary.setdefault(t, len(vocabulary)) for t in counted]
            items.append((np.array(numbers, np.int64), np.fromiter(counted.values(), np.int64)))
        return Block(vocabulary, items)


def holding_counts(index: DataFrame, block: Block) -> np.ndarray:
    """How many documents hold each term of the block: a task sends one number per term."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, seen = block.vocabulary, Counter()
        known = vocabulary.keys()
        for batch in batches:
            for terms in batch.column(0):
                seen.update(known & set(terms.as_py().split()))
        yield pa.RecordBatch.from_arrays([pa.array([vocabulary[t] for t in seen], pa.int64()), pa.array(seen.values(), pa.int64())],
                                         names=["term", "n"])

    counts = np.zeros(len(block.vocabulary), np.int64)
    for term, n in index.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        counts[term] = n
    return counts


class Searcher:
    """The best documents of each item among those seen so far."""

    def __init__(self, block: Block, weights: list[int], documents: int, terms: int):
        self.documents, self.terms, self.weights = documents, terms, weights
        self.names = list(block.vocabulary)
        self.hashes = _hashes(self.names)
        # a term's weight as often as the item has the term
        self.items = [(numbers, np.array([weights[t] for t in numbers.tolist()], np.int64) * times) for numbers, times in block.items]
        self.best: list[list[tuple]] = [[] for _ in self.items]

    def _impacts(self, sketches: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        times = sketches.astype(np.int64)
        found = 1_000_000_000 * times // np.maximum(1000 * times + 8 * lengths, 1)
        found[sketches == FULL] = 1_000_000
        return found.astype(np.float64)

    def _offer(self, item: int, score: int, doc_id: int | None) -> None:
        best = self.best[item]
        best.append((score, doc_id is not None, -(doc_id or 0)))
        best.sort(reverse=True)
        del best[BEST:]

    def see(self, ids: list, lengths: list[int], sketches: np.ndarray, held) -> None:
        """Documents with sketches of one size; ``held(i)`` gives the terms of one and their occurrences."""
        size = sketches.shape[1]
        coordinates = self.hashes & (size - 1)
        asked, place = np.unique(coordinates, return_inverse=True)
        impacts = self._impacts(np.ascontiguousarray(sketches[:, asked].T), np.array(lengths, np.int64))
        opened: dict[int, dict[bytes, int]] = {}
        for item, (numbers, weights) in enumerate(self.items):
            if not len(numbers):
                continue
            bounds = weights.astype(np.float64) @ impacts[place[numbers]]
            best = self.best[item]
            least = best[-1][0] if len(best) == BEST else 1
            some = np.flatnonzero(bounds >= least)
            for i in some[np.argsort(-bounds[some], kind="stable")].tolist():
                if len(best) == BEST and bounds[i] < best[-1][0]:
                    break
                if i not in opened:
                    opened[i] = held(i)
                times, length = opened[i], lengths[i]
                score = sum(w * impact(times[t], length) for t, w in zip((self.names[t] for t in numbers.tolist()), weights.tolist())
                            if t in times)
                if score > 0:
                    self._offer(item, score, ids[i])

    def rows(self) -> list[tuple]:
        return [(item, -negative if known else None, score) for item, best in enumerate(self.best) for score, known, negative in best]


def _search_block(index: DataFrame, block: Block, documents: int, terms: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each item by number, of each task."""
    weights = [weight(documents, n) for n in holding_counts(index, block).tolist()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(block, weights, documents, terms)
        for batch in batches:
            ids, sizes = batch.column(0).to_pylist(), pc.binary_length(batch.column(4)).to_numpy()
            lengths = [relative_length(n, documents, terms) for n in batch.column(1).to_pylist()]
            ends = np.concatenate(([0], batch.column(3).value_lengths().to_numpy().cumsum()))
            times = batch.column(3).flatten().to_numpy()
            names = batch.column(2)

            def held(i: int) -> dict[bytes, int]:
                return dict(zip(names[i].as_py().split(), times[ends[i]:ends[i + 1]].tolist()))

            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                for a, b in runs([size] * len(rows), RUN_CELLS):
                    some = rows[a:b].tolist()
                    sketches = np.frombuffer(b"".join(batch.column(4)[i].as_py() for i in some), np.uint8).reshape(len(some), size)
                    searcher.see([ids[i] for i in some], [lengths[i] for i in some], sketches, lambda i, some=some: held(some[i]))
        found = list(zip(*searcher.rows())) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["item", "doc_id", "score"])

    return index.select("doc_id", "n", "terms", "occurrences", "sketch").mapInArrow(run, "item long, doc_id long, score long")


def _ranked(found: DataFrame, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= BEST)


def search(spark: SparkSession, index: DataFrame, items: DataFrame, root: str, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the best ten documents of each item with a score above zero.

    ``index`` is a stored table of ``build_index``.  The driver and every task hold one block of items.
    """
    stats = index.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    asked = items.select(F.col(key).alias("item_id"), F.col(text).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    for number in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect() if stats.documents else []
        block = Block.of([(r.text or "").encode() for r in rows])
        found = _search_block(index, block, stats.documents or 0, stats.terms or 0)
        # few rows of each task and item meet, first in parts
        found = _ranked(_ranked(found.withColumn("salt", F.spark_partition_id() % SALTS), "item", "salt").drop("rank", "salt"), "item")
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item long, item_id {asked.schema['item_id'].dataType.simpleString()}")
        found = found.join(names, "item").select("item_id", "rank", "doc_id", "score")
        found.write.mode("overwrite").parquet(f"{root}/found/block={number}")
    return spark.read.schema(found.schema).parquet(*[f"{root}/found/block={number}" for number in range(blocks)])
