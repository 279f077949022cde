"""Alignment of the tokens that two tokenizers give for the same texts.

Tokens stand for byte ranges.  The incidence of tokens and bytes is a sparse matrix
for each tokenizer (``Csr``), and the row product of one with the other's transpose
(Gustavson) gives the overlap links.  Offsets at which tokens of both end cut the bytes
into groups; the product of the two token-group incidences gives the links of tokens
that share a group.  Over the corpus an id pair is counted once for each document
that links it.

Texts are cut at single blanks between visible characters.  Neither tokenizer joins
across such a blank (checked for the vocabulary, and by tests against whole texts), so
a token ends there in both, and no group goes across.  The pieces of a run of documents are
aligned once each; a run stores its pieces' id pairs, and documents the numbers of
their pieces.  Counts of a run's pairs are looked up by one join of runs and pairs, and go
back to the run's documents, where documents are summed.

A text that is null or empty, or that a tokenizer does not give back byte by byte, has no
tokens: zeros and an empty digest.  Rows that repeat are all kept and each counts as a document;
null ids are kept.  An empty table gives no rows.  A text longer than a run is a run of its
own and is held by one task.  Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from opinionlake.llm.texts import byte_runs

RUN_BYTES = 1 << 20
KEPT_PIECES = 150_000
LEARNED_AT_ONCE = 20_000
KEPT_BYTES = 1 << 24
_CUT = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class Csr:
    """Sparse matrix by rows."""

    ends: np.ndarray  # where the entries of row r begin and, one further, end
    columns: np.ndarray
    values: np.ndarray
    width: int

    @staticmethod
    def of(rows: np.ndarray, columns: np.ndarray, height: int, width: int) -> "Csr":
        """Ones at (row, column), rows ascending."""
        return Csr(np.searchsorted(rows, np.arange(height + 1)), columns, np.ones(len(columns), np.int64), width)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ends) - 1), np.diff(self.ends))

    def transposed(self) -> "Csr":
        order = np.argsort(self.columns, kind="stable")
        return Csr(np.searchsorted(self.columns[order], np.arange(self.width + 1)), self.rows()[order], self.values[order], len(self.ends) - 1)

    def times(self, other: "Csr") -> "Csr":
        """Row product: each entry of a row adds the other's row that it names, and equal columns are summed."""
        sizes = np.diff(other.ends)[self.columns]
        begins = np.cumsum(sizes) - sizes
        taken = np.repeat(other.ends[self.columns] - begins, sizes) + np.arange(int(sizes.sum()))
        row, column = np.repeat(self.rows(), sizes), other.columns[taken]
        value = np.repeat(self.values, sizes) * other.values[taken]
        order = np.lexsort((column, row))
        row, column, value = row[order], column[order], value[order]
        first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (column[1:] != column[:-1]))[:len(row)])
        summed = np.add.reduceat(value, first) if len(first) else value
        return Csr(np.searchsorted(row[first], np.arange(len(self.ends))), column[first], summed, other.width)


def overlap_links(a_ends: np.ndarray, b_ends: np.ndarray) -> Csr:
    """Tokens of A by tokens of B: how many bytes they share."""
    size = int(a_ends[-1]) if len(a_ends) else 0
    a, b = (Csr.of(np.repeat(np.arange(len(e)), np.diff(e, prepend=0)), np.arange(size), len(e), size) for e in (a_ends, b_ends))
    return a.times(b.transposed())


def group_links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[Csr, np.ndarray, np.ndarray]:
    """Tokens of A by tokens of B that share a group, and the group of each token of A and of B."""
    ends = np.sort(np.concatenate((a_ends, b_ends)))
    cuts = ends[:-1][ends[1:] == ends[:-1]]  # no token is empty, so an end comes once on each side
    a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
    a, b = (Csr.of(np.arange(len(g)), g, len(g), len(cuts)) for g in (a_group, b_group))
    return a.times(b.transposed()), a_group, b_group


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Strings:
    """Byte strings in one buffer, joined by number."""

    def __init__(self, values: list[bytes]):
        self.flat = np.frombuffer(b"".join(values), np.uint8)
        self.sizes = np.array(list(map(len, values)), np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        return self.flat[_within(self.begins[numbers], self.sizes[numbers])]


class Pair:
    """Tokenizer A (JSON, byte-level) and tokenizer B (piece model), with the bytes of their ids."""

    def __init__(self, a_model: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_model)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet, vocabulary = byte_alphabet(), self.a.get_vocab()
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for name, number in vocabulary.items():
            a_bytes[number] = bytes(alphabet[c] for c in name) if all(c in alphabet for c in name) else name.encode()
        b_bytes = []
        for number in range(self.b.get_piece_size()):
            name = self.b.id_to_piece(number)
            if "▁" in name.lstrip("▁"):
                raise ValueError(f"piece {name!r} goes across a blank")
            b_bytes.append(bytes([int(name[3:-1], 16)]) if self.b.is_byte(number) else name.replace("▁", " ").encode())
        self.a_bytes, self.b_bytes = Strings(a_bytes), Strings(b_bytes)
        self.a_blank = np.array([x.startswith(b" ") for x in a_bytes])
        # an id as it is listed, with each mark that can follow: another id, the other side, the next group, nothing
        self.marks = ",|;"
        self.listed = Strings([f"{i}{mark}".encode() for mark in (*self.marks, "") for i in range(max(len(a_bytes), len(b_bytes)))])
        self.names = max(len(a_bytes), len(b_bytes))

    def encode(self, pieces: list[str], plain: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of all pieces, each after a blank, and their number for each piece, by A and by B; B adds that blank itself.

        ``plain`` pieces hold no blank and have no white space at their ends, so A may
        take them as one text, in which only a piece's first id has a blank.
        """
        if plain:
            ids = np.array(self.a.encode_batch_fast([" " + " ".join(pieces)], add_special_tokens=False)[0].ids, np.int64)
            begins = np.flatnonzero(self.a_blank[ids])
            if len(begins) != len(pieces):
                raise ValueError("the tokenizer does not cut before blanks")
            a = ids, np.diff(np.append(begins, len(ids)))
        else:
            a = _flat([e.ids for e in self.a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)])
        return [a, _flat(self.b.encode(pieces, num_threads=1))]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64), np.fromiter(map(len, lists), np.int64, len(lists))


@lru_cache(maxsize=1)
def _pair(a_model: str, b_model: bytes) -> "Pieces":
    return Pieces(Pair(a_model, b_model))


class _Numbers:
    """An array that grows."""

    def __init__(self):
        self._held, self.size = np.zeros(1024, np.int64), 0

    def add(self, values: np.ndarray) -> None:
        while self.size + len(values) > len(self._held):
            self._held = np.concatenate((self._held, np.zeros_like(self._held)))
        self._held[self.size:self.size + len(values)] = values
        self.size += len(values)

    def all(self) -> np.ndarray:
        return self._held[:self.size]


class Pieces:
    """Aligned pieces by number: what a document sums, the listing of groups, and the id pairs with their occurrences."""

    MEASURES = ("whole", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_pairs")

    def __init__(self, pair: Pair):
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.plain: dict[str, int] = {}  # pieces without white space at their ends
        self.others: dict[str, int] = {}
        self.listing: list[bytes] = []
        self.measures = {name: _Numbers() for name in self.MEASURES}
        self.pairs, self.occurrences = _Numbers(), _Numbers()
        self.held = 0

    def learn(self, fresh: list[str], plain: bool) -> None:
        """Align pieces that have no number yet."""
        count = len(fresh)
        encoded = self.pair.encode(fresh, plain)
        flat = [ids for ids, _ in encoded]
        owner = [np.repeat(np.arange(count), sizes) for _, sizes in encoded]
        wanted = Strings([b" " + piece.encode() for piece in fresh])
        whole = np.ones(count, bool)
        for ids, own, texts in zip(flat, owner, (self.pair.a_bytes, self.pair.b_bytes)):
            held = np.bincount(own, texts.sizes[ids], minlength=count).astype(np.int64)
            whole &= held == wanted.sizes
            same = texts.joined(ids[whole[own]]) == wanted.joined(np.flatnonzero(whole))
            wrong = np.repeat(np.flatnonzero(whole), wanted.sizes[whole])[~same]
            whole[wrong] = False
        a, b = (ids[whole[own]] for ids, own in zip(flat, owner))
        a_owner, b_owner = (own[whole[own]] for own in owner)
        a_ends, b_ends = np.cumsum(self.pair.a_bytes.sizes[a]), np.cumsum(self.pair.b_bytes.sizes[b])
        overlaps = overlap_links(a_ends, b_ends)
        links, a_group, b_group = group_links(a_ends, b_ends)

        linked = a_owner[links.rows()]
        keys = a[links.rows()] << 32 | b[links.columns]
        order = np.lexsort((keys, linked))
        keys, linked = keys[order], linked[order]
        first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (linked[1:] != linked[:-1]))[:len(keys)])
        of = lambda owners: np.bincount(owners, minlength=count)
        last_a, last_b = (np.append(g[1:] != g[:-1], True)[:len(g)] for g in (a_group, b_group))
        measured = (whole, of(a_owner), of(b_owner), of(a_owner[last_a]), of(linked), of(a_owner[overlaps.rows()]), of(linked[first]))
        for name, values in zip(self.MEASURES, measured):
            self.measures[name].add(values.astype(np.int64))
        self.pairs.add(keys[first])
        self.occurrences.add(np.diff(np.append(first, len(keys))))

        # listings: a group's ids of A, then those of B; a piece's last id has no mark behind it
        comma, bar, semicolon, none = (k * self.pair.names for k in range(4))
        ends_piece = np.append(b_owner[1:] != b_owner[:-1], True)[:len(b)]
        marked = np.concatenate((a + np.where(last_a, bar, comma), b + np.where(ends_piece, none, np.where(last_b, semicolon, comma))))
        order = np.lexsort((np.repeat([0, 1], [len(a), len(b)]), np.concatenate((a_group, b_group))))
        listed = self.pair.listed.joined(marked[order]).tobytes()
        cuts = np.cumsum(np.bincount(np.concatenate((a_owner, b_owner)), self.pair.listed.sizes[marked], minlength=count).astype(np.int64)).tolist()
        self.listing += [listed[begin:end] for begin, end in zip([0, *cuts], cuts)]

    def _number(self, book: dict[str, int], fresh: list[str]) -> None:
        for at in range(0, len(fresh), LEARNED_AT_ONCE):
            some = fresh[at:at + LEARNED_AT_ONCE]
            begin = len(self.listing)
            self.learn(some, book is self.plain)
            book.update(zip(some, range(begin, begin + len(some))))
            self.held += sum(map(len, some))

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The numbers of each text's pieces."""
        if len(self.listing) > KEPT_PIECES or self.held > KEPT_BYTES:  # forgotten, and learned again where they are met again
            self.clear()
        cut = [text.split(" ") if text else [] for text in texts]
        fresh = set(itertools.chain.from_iterable(cut)) - self.plain.keys()
        # a blank beside other white space, or at an end, does not cut
        odd = {p for p in fresh if not p or p[0].isspace() or p[-1].isspace()}
        slow = {i for i, some in enumerate(cut) if not odd.isdisjoint(some)} if odd else set()
        others = {i: _CUT.split(texts[i]) for i in slow}
        self._number(self.plain, list(fresh - odd))
        self._number(self.others, list({p for some in others.values() for p in some} - self.others.keys()))
        plain, rest = self.plain.__getitem__, self.others.__getitem__
        return [list(map(rest, others[i]) if i in slow else map(plain, some)) for i, some in enumerate(cut)]


_DOCUMENT = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")
_ALIGNED = ("run long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, "
            "words binary, pairs array<long>, docs array<long>, sizes binary, word_pairs binary")


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def _small(numbers: np.ndarray) -> bytes:
    """Whole numbers in two or four bytes each."""
    wide = len(numbers) > 0 and int(numbers.max()) > 0xFFFF
    return (b"4" if wide else b"2") + numbers.astype("<u4" if wide else "<u2").tobytes()


def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4" if packed[:1] == b"4" else "<u2", offset=1).astype(np.int64)


def _within(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range."""
    begins = np.cumsum(sizes) - sizes
    return np.repeat(starts - begins, sizes) + np.arange(int(sizes.sum()))


def _distinct(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    return ordered[np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)]]


def _per(owner: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Sums of whole numbers by owner, owners ascending."""
    summed = np.concatenate(([0], np.cumsum(values)))
    return np.diff(summed[np.searchsorted(owner, np.arange(count + 1))])


def align_documents(docs: DataFrame, a_model: str, b_model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document, and one for each run of documents with its pieces' id pairs and their documents in the run."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = _pair(a_model, b_model), TaskContext.get().partitionId() << 32
        for batch in batches:
            for begin, texts in byte_runs(batch.column(1), RUN_BYTES):
                number += 1
                yield aligned_run(known, number, batch.column(0).slice(begin, len(texts)), [t.decode() for t in texts])
        known.clear()  # the worker waits with little memory

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(run, _ALIGNED)


def aligned_run(known: Pieces, number: int, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    pieces = known.numbers(texts)
    measures = {name: held.all() for name, held in known.measures.items()}
    flat = np.fromiter(itertools.chain.from_iterable(pieces), np.int64)
    owner = np.repeat(np.arange(len(texts)), list(map(len, pieces)))
    # a document with a piece that is not given back has no tokens
    broken = np.zeros(len(texts), bool)
    broken[owner[measures["whole"][flat] == 0]] = True
    flat, owner = flat[~broken[owner]], owner[~broken[owner]]
    pieces = [[] if b else some for some, b in zip(pieces, broken.tolist())]
    words = _distinct(flat)
    word = np.searchsorted(words, flat)

    # id pairs of the run's pieces, numbered within the run
    n_pairs = measures["n_pairs"][words]
    places = _within((np.cumsum(measures["n_pairs"]) - measures["n_pairs"])[words], n_pairs)
    met_pairs = known.pairs.all()[places]
    pairs = _distinct(met_pairs)
    word_pairs = np.searchsorted(pairs, met_pairs)
    ends = np.concatenate(([0], np.cumsum(n_pairs)))

    # documents of the run by pair: each piece of a document once, then each pair once
    held = _distinct(owner * max(len(words), 1) + word)
    document, met = held // max(len(words), 1), held % max(len(words), 1)
    sizes = n_pairs[met]
    each = _distinct(np.repeat(document, sizes) * max(len(pairs), 1) + word_pairs[_within(ends[:-1][met], sizes)])
    docs = np.bincount(each % max(len(pairs), 1), minlength=len(pairs))

    listing = known.listing
    digests = [hashlib.sha256(b";".join([listing[x] for x in some])).hexdigest() if some else "" for some in pieces]
    count = len(texts) + 1
    last = np.zeros(count, bool)
    last[-1] = True
    sums = [pa.array(np.append(_per(owner, measures[name][flat], len(texts)), 0), mask=last) for name in _DOCUMENT]
    word_ends = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    # a pair stands in its piece as often as the piece links it
    times = known.occurrences.all()[places]
    sizes = _per(np.repeat(np.arange(len(words)), n_pairs), times, len(words))
    only = lambda value, kind: pa.array([*[None] * len(texts), value], kind)
    many = lambda values: pa.concat_arrays([pa.nulls(len(texts), pa.list_(pa.int64())), _lists(values, np.array([0, len(values)]))])
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(count, number)), pa.concat_arrays([ids, pa.nulls(1, pa.int64())]), *sums, pa.array([*digests, None], pa.string()),
        pa.array([*[_small(word[a:b]) for a, b in zip(word_ends, word_ends[1:])], None], pa.binary()), many(pairs), many(docs),
        only(_small(sizes), pa.binary()), only(_small(np.repeat(word_pairs, times)), pa.binary())],
        names=[field.split()[0] for field in _ALIGNED.split(", ")])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents two ids are linked, and whether no other id is linked with the A id in more."""
    met = aligned.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "docs")).alias("e"))
    counts = met.groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.docs").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))  # no more rows than B has ids
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def _summed(aligned: DataFrame, told: DataFrame) -> DataFrame:
    """Documents with ``n_best`` and ``count_sum``; a run's counts and its pieces come before its documents."""
    shown = ["doc_id", *_DOCUMENT, "groups_sha256"]
    packed = ["words", "sizes", "word_pairs"]
    is_run = F.col("pairs").isNotNull()
    none = [F.lit(None).cast(told.schema[c].dataType).alias(c) for c in ("counted", "best")]
    rows = aligned.select("run", F.when(is_run, 1).otherwise(2).alias("kind"), *shown, *packed, *none)
    answers = told.select("run", F.lit(0).alias("kind"), *[F.lit(None).cast(aligned.schema[c].dataType).alias(c) for c in [*shown, *packed]],
                          "counted", "best")
    names = [*shown, "n_best", "count_sum"]
    schema = ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in shown) + ", n_best long, count_sum long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        counted, of_words, number = (none, none), (none, none), None
        for batch in batches:
            kinds, runs = batch.column("kind").to_numpy(), batch.column("run").to_numpy()
            change = np.flatnonzero((kinds[1:] != kinds[:-1]) | (runs[1:] != runs[:-1])) + 1
            cuts = [0, *change.tolist(), len(kinds)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if runs[begin] != number:  # a run without pairs has no counts
                    number, counted = runs[begin], (none, none)
                if kinds[begin] == 0:
                    counted = tuple(batch.column(name)[begin].values.to_numpy(zero_copy_only=False).astype(np.int64) for name in ("best", "counted"))
                elif kinds[begin] == 1:
                    sizes, pair = (_numbers(batch.column(name)[begin].as_py()) for name in ("sizes", "word_pairs"))
                    word = np.repeat(np.arange(len(sizes)), sizes)
                    of_words = tuple(_per(word, values[pair], len(sizes)) for values in counted)
                else:
                    part = batch.slice(begin, end - begin)
                    words = [_numbers(w) for w in part.column("words").to_pylist()]
                    owner, flat = np.repeat(np.arange(len(words)), list(map(len, words))), np.concatenate(words)
                    sums = [_per(owner, values[flat], len(words)) for values in of_words]
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in shown], *map(pa.array, sums)], names=names)

    both = rows.unionByName(answers).repartition("run").sortWithinPartitions("run", "kind")
    return both.mapInArrow(run, schema)


def align(spark: SparkSession, docs: DataFrame, root: str, a_model: str, b_model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_overlaps``, ``groups_sha256``, ``n_best`` and ``count_sum``.

    Intermediate tables go below ``root``; ``{root}/pairs`` has the corpus-wide counts of id pairs.
    """
    align_documents(docs, a_model, b_model, key, text).write.mode("overwrite").parquet(f"{root}/aligned")
    aligned = spark.read.schema(_ALIGNED).parquet(f"{root}/aligned")
    pair_counts(aligned).write.mode("overwrite").parquet(f"{root}/pairs")
    counts = spark.read.schema("pair long, n long, best boolean").parquet(f"{root}/pairs")
    asked = aligned.filter("pairs IS NOT NULL").select("run", F.posexplode("pairs").alias("at", "pair"))
    # a run's pairs are bounded by its size
    told = asked.join(counts, "pair").groupBy("run").agg(F.array_sort(F.collect_list(F.struct("at", "n", "best"))).alias("t")).select(
        "run", F.col("t.n").alias("counted"), F.transform("t.best", lambda x: x.cast("int")).alias("best"))
    return _summed(aligned, told)
