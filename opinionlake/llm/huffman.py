"""Token ids in Huffman-coded files.

Ids are counted over the whole corpus and get a canonical code of limited length.
Documents go in ascending order of id into files of independent blocks.  A block
has its documents' ids and lengths, a bit stream, and the bit length of every run
of 64 ids; so all runs of a block are decoded side by side by table look-up.

A null text is an empty one: only the end id is written.  A null document id is
kept and comes first.  Rows with equal document ids are all kept; their order is
that of a hash of their ids.  An empty table gives no files and no rows.  Texts are
encoded in runs of half a million bytes; a longer text is a run and a block of its own.
The string of a special token in a text becomes that token, as the library does by
default.  Columns other than id and text are not read.
"""

from __future__ import annotations

import itertools
import os
import string
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from opinionlake.llm.bpe import runs
from opinionlake.llm.files import Output, Ranges, new_name

END = 2
MAX_BITS = 16
RUN = 64
RUN_CHARS = 500_000
BLOCK_IDS = 1 << 20
FILE_IDS = 1 << 24
MAGIC = b"IDHUF01\n"
CACHED_CHUNKS = 800_000
KEPT_TAILS = 10_000
JOINED = 200
MARKS = string.punctuation


class ChunkEncoder:
    """Ids of whole texts, as little-endian 32-bit numbers, by a byte-level tokenizer.

    A piece never goes across a blank that stands between two visible characters, across
    a single line end between them, or from a letter to a mark, so texts are cut there
    and chunks met before are not encoded again.  A text with a blank at its ends or
    beside other white space is encoded in one go, and so is a text that holds the
    string of an added token, which the library looks for first.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.starts: dict[str, bytes] = {"": b""}  # words after a line end
        self.tails: dict[str, bytes] = {}
        self.line_end = int(np.frombuffer(self._encode("\n"), "<u4")[0])
        blank = self.tokenizer.pre_tokenizer.pre_tokenize_str(" ")[0][0]
        vocabulary = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(vocabulary.values()) + 1, bool)
        self.blank[[number for piece, number in vocabulary.items() if piece.startswith(blank)]] = True

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _cut(self, lead: str, of: list[str], begins: Callable[[np.ndarray], np.ndarray], skip: int) -> dict[str, bytes]:
        """The ids of each word, encoded in texts that join some with ``lead`` before each.

        ``begins`` marks ids at which a word begins, ``skip`` of them are not its own.
        """
        # the library takes longer over a word the longer the text around it
        texts = [lead + lead.join(of[i:i + JOINED]) for i in range(0, len(of), JOINED)]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, "<u4") for x in encoded])
        cuts = [*(4 * np.flatnonzero(begins(ids))).tolist(), 4 * len(ids)]
        if len(cuts) != len(of) + 1:
            raise ValueError("the tokenizer does not cut there")
        flat = ids.tobytes()
        return dict(zip(of, map(flat.__getitem__, map(slice, [a + 4 * skip for a in cuts] if skip else cuts, cuts[1:]))))

    def _tail(self, marks: str) -> bytes:
        if marks not in self.tails:
            if len(self.tails) > KEPT_TAILS:
                self.tails.clear()
            self.tails[marks] = self._encode(marks)
        return self.tails[marks]

    def _learn(self, book: dict[str, bytes], words: set[str], learn: Callable[[list[str]], dict[str, bytes]]) -> None:
        """Encode words; those with marks after a letter or digit are their rest and the marks."""
        plain, marked = set(filter(str.isalnum, words)), []
        for word in words - plain:
            stem = word.rstrip(MARKS)
            if len(stem) < len(word) and stem and stem[-1].isalnum():
                marked.append((word, stem))
                if stem not in book:
                    plain.add(stem)
            else:
                plain.add(word)
        if plain:
            book.update(learn(list(plain)))
        for word, stem in marked:
            book[word] = book[stem] + self._tail(word[len(stem):])

    def _learn_chunks(self, chunks: list[str]) -> dict[str, bytes]:
        # each with its blank before it: only a chunk's first id has a blank at its start
        return self._cut(" ", chunks, lambda ids: self.blank[ids], 0)

    def _learn_starts(self, words: list[str]) -> dict[str, bytes]:
        # a line end is one id and stands alone
        return self._cut("\n", words, lambda ids: ids == self.line_end, 1)

    def _learn_all(self, fresh: set[str]) -> None:
        chunks, older = self.chunks, self.older
        known = {p: older.pop(p) for p in filter(older.__contains__, fresh)}
        chunks.update(known)
        fresh = fresh.difference(known)
        # the many chunks of letters and digits alone need no look at their ends
        wanted, starts, lines = set(filter(str.isalnum, fresh)), set(), []
        for p in fresh - wanted:
            if not p or p[0].isspace() or p[-1].isspace():
                continue
            if "\n" in p:
                parts = p.split("\n")
                if all(x.split() == [x] for x in parts):
                    lines.append((p, parts))
                    wanted.add(parts[0])
                    starts.update(parts[1:])
                    continue
            wanted.add(p)
        # difference() looks the words up; a minus would go through all keys of the book
        self._learn(chunks, wanted.difference(chunks), self._learn_chunks)
        self._learn(self.starts, starts.difference(self.starts), self._learn_starts)
        end = np.array([self.line_end], "<u4").tobytes()
        for p, parts in lines:
            chunks[p] = chunks[parts[0]] + b"".join([end + self.starts[x] for x in parts[1:]])

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.chunks) > CACHED_CHUNKS:  # what is not met again before the next turn is forgotten
            self.older, self.chunks, self.starts = self.chunks, {}, {"": b""}
        whole = {i for i, text in enumerate(texts) if any(mark in text for mark in self.added)}
        parts = [[] if i in whole else text.split(" ") for i, text in enumerate(texts)]
        chunks, starts = self.chunks, self.starts
        self._learn_all(set(itertools.chain.from_iterable(parts)).difference(chunks))
        heads = {some[0] for some in parts if some}.difference(starts)
        self._learn(starts, {h for h in heads if h.split() == [h]}, self._learn_starts)
        out: list[bytes] = []
        for text, some in zip(texts, parts):
            try:
                if not some or not some[0] or some[0][-1].isspace():
                    raise KeyError
                tail = b"".join(map(chunks.__getitem__, some[1:]))
            except KeyError:
                out.append(self._encode(text))
            else:
                out.append((starts[some[0]] if some[0] in starts else self._encode(some[0])) + tail)
        return out


@lru_cache(maxsize=2)
def _encoder(model: str) -> ChunkEncoder:
    return ChunkEncoder(model)


@lru_cache(maxsize=1)
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack_ids(ids: bytes) -> bytes:
    """32-bit ids made small for storing and shuffling."""
    numbers = np.frombuffer(ids, "<u4")
    wide = len(numbers) > 0 and int(numbers.max()) > 0xFFFF
    return (b"4" if wide else b"2") + _zstd()[0].compress(ids if wide else numbers.astype("<u2").tobytes())


def unpack_ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(_zstd()[1].decompress(packed[1:]), "<u4" if packed[:1] == b"4" else "<u2")


def encode_ids(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """``doc_id``, packed ``ids`` with the end id, and their number ``n``; ``model`` is the tokenizer's JSON.

    Every task ends with a row in which ``tally`` has its count of each id.
    """
    mark = np.array([end], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, total = _encoder(model), np.zeros(0, np.int64)
        for batch in batches:
            for begin, texts in runs(batch.column(1), RUN_CHARS):
                part = batch.slice(begin, len(texts))
                ids = [x + mark for x in encode(texts)]
                seen = np.bincount(np.frombuffer(b"".join(ids), "<u4"), minlength=len(total))
                seen[: len(total)] += total
                total = seen
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(pack_ids, ids), pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.nulls(len(ids), pa.binary())], names=_ENCODED)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.binary()), pa.array([None], pa.int64()),
                                          pa.array([total.astype("<i8").tobytes()], pa.binary())], names=_ENCODED)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(run, ENCODED)


ENCODED = "doc_id long, ids binary, n long, tally binary"
_ENCODED = ["doc_id", "ids", "n", "tally"]


def count_ids(encoded: DataFrame) -> DataFrame:
    """Occurrences of each id over all tasks: one number per id and task is shuffled."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                total = np.frombuffer(value.as_buffer(), "<i8")
                found = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])

    tallies = encoded.filter("tally IS NOT NULL").select("tally")
    return tallies.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal lengths of at most ``most`` bits for the ids with a count (package merging).

    Raises if there are more such ids than codes of that length.
    """
    used = np.flatnonzero(counts)
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} ids do not fit codes of {most} bits")
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    packed = np.zeros(0, np.int64)
    levels = []
    for _ in range(most):
        merged = np.concatenate((weights, packed))
        place = np.argsort(merged, kind="stable")
        levels.append(place < len(weights))
        merged = merged[place]
        packed = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * (len(weights) - 1)
    depth = np.zeros(len(weights) + 1, np.int64)
    for single in reversed(levels):
        leaves = int(single[:take].sum())  # the lightest ones: each gets a bit more
        depth[0] += 1
        depth[leaves] -= 1
        take = 2 * (take - leaves)
    lengths[order] = np.cumsum(depth)[:-1]
    return lengths


@dataclass(frozen=True)
class Code:
    """Canonical code: ids in the order of (length, id) get consecutive numbers."""

    lengths: np.ndarray
    words: np.ndarray
    table_id: np.ndarray
    table_bits: np.ndarray
    bits: int

    @staticmethod
    def of(lengths: np.ndarray) -> "Code":
        bits = max(int(lengths.max(initial=0)), 1)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        spans = np.int64(1) << (bits - lengths[order].astype(np.int64))
        starts = np.cumsum(spans) - spans
        words = np.zeros(len(lengths), np.uint32)
        words[order] = starts >> (bits - lengths[order].astype(np.int64))
        table_id, table_bits = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.uint8)
        table_id[: spans.sum()] = np.repeat(order, spans)
        table_bits[: spans.sum()] = np.repeat(lengths[order], spans)
        return Code(lengths, words, table_id, table_bits, bits)

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bit stream, and the bit length of each run of ids."""
        sizes = self.lengths[ids]
        if not sizes.all():
            raise ValueError("an id without a code")
        runs = np.add.reduceat(sizes, np.arange(0, len(ids), RUN), dtype=np.int64) if len(ids) else np.zeros(0, np.int64)
        # neighbours are joined to words of up to 64 bits, which are then set into the stream
        words, sizes = self.words[ids].astype(np.uint64), sizes.astype(np.uint64)
        for _ in range(2 if self.bits <= 16 else 1):
            if len(words) % 2:
                words, sizes = np.append(words, np.uint64(0)), np.append(sizes, np.uint64(0))
            words, sizes = words[::2] << sizes[1::2] | words[1::2], sizes[::2] + sizes[1::2]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        stream = np.zeros(int(ends[-1] if len(ends) else 0) // 64 + 2, np.uint64)
        at, inside = (starts >> np.uint64(6)).astype(np.int64), starts & np.uint64(63)
        aligned = np.where(sizes > 0, words << (np.uint64(64) - np.maximum(sizes, np.uint64(1))), np.uint64(0))
        np.bitwise_or.at(stream, at, aligned >> inside)
        over = inside > 0
        np.bitwise_or.at(stream, at[over] + 1, aligned[over] << (np.uint64(64) - inside[over]))
        return stream.astype(">u8").tobytes()[: -(-int(ends[-1] if len(ends) else 0) // 8)], runs.astype("<u2")

    def unpack(self, stream: bytes, runs: np.ndarray, n: int) -> np.ndarray:
        """``n`` ids; all runs advance together, one id a step."""
        data = np.frombuffer(stream + b"\0" * 8, np.uint8).astype(np.uint32)
        at = np.cumsum(runs.astype(np.int64)) - runs
        out = np.zeros((RUN, len(runs)), np.uint32)
        shift, last = np.uint32(24 - self.bits), n - RUN * (len(runs) - 1)
        mask = np.uint32((1 << self.bits) - 1)
        for j in range(RUN):
            if j == last:  # the last run is shorter
                at = at[:-1]
            byte = at >> 3
            window = data[byte] << np.uint32(16) | data[byte + 1] << np.uint32(8) | data[byte + 2]
            code = window >> (shift - (at & 7).astype(np.uint32)) & mask
            out[j, : len(at)] = self.table_id[code]
            at = at + self.table_bits[code]
        return out.T.ravel()[:n]


def write_files(encoded: DataFrame, lengths: np.ndarray, folder: str, n_ids: int, file_ids: int = FILE_IDS,
                block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write the files in ascending document id; one row per block, which commits its file.

    The row has the file's number in that order, the block's place, and its counts.
    A document lies whole in one block, so a block is as long as the longest document
    or ``block_ids``.
    """
    table = zlib.compress(lengths.tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code.of(np.frombuffer(zlib.decompress(table), np.uint8))
        number = TaskContext.get().partitionId()
        file: Output | None = None
        rows: list[tuple] = []
        keys: list[int | None] = []
        ids: list[np.ndarray] = []

        def flush() -> None:
            nonlocal file
            if file is None:
                file = Output(new_name(folder, f"ids-{number:06d}", ".huf"))
                file.write(MAGIC + struct.pack("<I", len(table)) + table)
            sizes = np.array([len(x) for x in ids], "<u4")
            stream, runs = code.pack(np.concatenate(ids))
            head = struct.pack("<IQIQ", len(keys), int(sizes.sum()), len(runs), len(stream))
            nulls = np.packbits([k is None for k in keys]).tobytes()
            block = head + np.array([k or 0 for k in keys], "<i8").tobytes() + nulls + sizes.tobytes() + runs.tobytes() + stream
            rows.append((number, len(rows), file.uri, file.write(block), len(block), len(keys), int(sizes.sum())))
            keys.clear()
            ids.clear()

        held = 0
        for batch in batches:
            for key, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                value = unpack_ids(packed)
                if ids and held + len(value) > block_ids:
                    flush()
                    held = 0
                keys.append(key)
                ids.append(value)
                held += len(value)
        if ids:
            flush()
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_pylist([dict(zip(_BLOCK, row)) for row in rows], schema=_BLOCK_ARROW)

    n_files = max(1, -(-n_ids // file_ids))
    dealt = (encoded.filter("tally IS NULL").select("doc_id", "ids").withColumn("_tie", F.xxhash64("ids")).repartitionByRange(n_files, "doc_id", "_tie")
             .sortWithinPartitions("doc_id", "_tie").select("doc_id", "ids"))
    return dealt.mapInArrow(run, "file_no int, block_no int, path string, offset long, length long, n_docs long, n_ids long")


_BLOCK_ARROW = pa.schema([("file_no", pa.int32()), ("block_no", pa.int32()), ("path", pa.string()), ("offset", pa.int64()),
                          ("length", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
_BLOCK = _BLOCK_ARROW.names


def read_block(block: bytes, code: Code) -> Iterator[tuple[int | None, np.ndarray]]:
    """Document id and ids of each document of a block."""
    n_docs, n_ids, n_runs, n_bytes = struct.unpack_from("<IQIQ", block)
    at = struct.calcsize("<IQIQ")
    keys = np.frombuffer(block, "<i8", n_docs, at).tolist()
    at += 8 * n_docs
    nulls = np.unpackbits(np.frombuffer(block, np.uint8, -(-n_docs // 8), at))[:n_docs].tolist()
    at += -(-n_docs // 8)
    sizes = np.frombuffer(block, "<u4", n_docs, at).astype(np.int64)
    at += 4 * n_docs
    runs = np.frombuffer(block, "<u2", n_runs, at)
    at += 2 * n_runs
    ids = code.unpack(block[at:at + n_bytes], runs, n_ids)
    ends = np.cumsum(sizes)
    for key, null, start, end in zip(keys, nulls, (ends - sizes).tolist(), ends.tolist()):
        yield (None if null else key), ids[start:end]


def read_files(manifest: DataFrame) -> DataFrame:
    """Documents read back: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids``.

    Starts of blocks are summed inside each file, those of files over one row per file.
    """
    files = manifest.groupBy("file_no").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file_no", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_file_start"))
    inside = Window.partitionBy("file_no").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    blocks = manifest.withColumn("_in_file", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(files, "file_no")
    blocks = blocks.select("path", "offset", "length", (F.col("_file_start") + F.col("_in_file")).alias("start"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, codes = Ranges(), {}
        for batch in batches:
            for row in batch.to_pylist():
                path = row["path"]
                if path not in codes:
                    head = ranges.read(path, 0, len(MAGIC) + 4)
                    if not head.startswith(MAGIC):
                        raise IOError(f"{path} is no id file")
                    table = ranges.read(path, len(head), struct.unpack_from("<I", head, len(MAGIC))[0])
                    codes = {path: Code.of(np.frombuffer(zlib.decompress(table), np.uint8))}
                docs = list(read_block(ranges.read(path, row["offset"], row["length"]), codes[path]))
                sizes = np.array([len(x[1]) for x in docs], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in docs], pa.int64()), pa.array(np.cumsum(sizes) - sizes + row["start"]),
                     pa.array(sizes), pa.array([x[1].astype("<u4").tobytes() for x in docs], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])
        ranges.close()

    # a row is a whole block to decode: rows are few, so Spark would put them all in one task
    dealt = blocks.repartition(max(1, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def write_corpus(spark: SparkSession, docs: DataFrame, model: str, root: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, count, code and write all texts below ``root``; returns the stored manifest of blocks."""
    stored = f"{root}/encoded"
    encode_ids(docs, model, key, text).write.mode("overwrite").parquet(stored)
    encoded = spark.read.schema(ENCODED).parquet(stored)
    # one row per id in use: no more than the vocabulary, whatever the data
    found = count_ids(encoded).collect()
    counts = np.zeros(max((row["id"] for row in found), default=-1) + 1, np.int64)
    for row in found:
        counts[row["id"]] = row["n"]
    blocks = write_files(encoded, code_lengths(counts), f"{root}/files", int(counts.sum()))
    blocks.write.mode("overwrite").parquet(f"{root}/manifest")
    return spark.read.schema(blocks.schema).parquet(f"{root}/manifest")
