"""Encoders against the public libraries, and id files against a plain computation."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Row
from tokenizers import Tokenizer

from opinionlake.llm import bpe, huffman, queries, wordpiece
from opinionlake.session import scratch_folder

SF = "/root/testdata/sf0.001"
DOCS = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as _file:
    MODEL = _file.read()
_random = random.Random(5)
ODD = ["", " ", "  a", "a  b \n\n c\t", "don't 's ''s it's's we'll've 'store he'L", "x" * 500 + "ab" * 300, "\n\n", "a b  c",
       "日本語 テキスト 12３", "'re'", " 'll", "\r\n x", "🎉🎉 é́ ¼ Ⅷ", "'", "end '", " \n'd", "<|endoftext|> a", "\0 \0", "a " * 40_000,
       *("".join(_random.choice("ab '\n\t s1té.,!lrve日") for _ in range(_random.randint(0, 60))) for _ in range(400))]


def tiktoken_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_and_merges_are_those_of_the_library():
    model, library = bpe.merger(RANKS), tiktoken_encoding()
    for _, some in bpe.runs(pa.array(ODD), 5000):
        for text, (ids, starts) in zip(some, model.encode(some)):
            assert ids.tolist() == library.encode_ordinary(text), text[:50]
            assert model.decode(ids) == text.encode("utf-8")
            assert len(starts) == 0 or starts[0] == 0


def test_long_pieces_merge_like_short_ones():
    model = bpe.merger(RANKS)
    for piece in (b"the" * 21, "überéà".encode() * 6, b"a" * 64):
        assert model._merge_long(piece) == model.merge(piece)


def test_op8_agrees_with_the_library(spark):
    library = tiktoken_encoding()
    want = {}
    for row in DOCS:
        ids = library.encode_ordinary(row["text"])
        want[row["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                               hashlib.sha256(row["text"].encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op8_byte_bpe(spark, SF).collect()}
    assert got == want


def test_bpe_edge_rows(spark):
    rows = [(1, None, 9), (1, "", 9), (None, "a b", 9), (1, "a b", 9)]
    out = bpe.decode(bpe.encode(spark.createDataFrame(rows, "doc_id long, text string, ids long"), RANKS), RANKS)
    got = sorted((r.text or "", bytes(r.decoded), len(r.piece_offsets)) for r in out.collect())
    assert got == [("", b"", 0), ("", b"", 0), ("a b", b"a b", 2), ("a b", b"a b", 2)]
    at_once = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string, ids long"), RANKS, decoded=True).collect()
    assert sorted((r.text or "", bytes(r.decoded)) for r in at_once) == [x[:2] for x in got]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(empty, RANKS), RANKS).count() == 0


def test_chunks_give_the_ids_of_whole_texts():
    library = Tokenizer.from_str(MODEL)
    encode = huffman.ChunkEncoder(MODEL)
    for _ in range(2):  # the second time from memory
        for text, ids in zip(ODD, encode(ODD)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:50]


def test_a_run_goes_through_its_own_words_only():
    seen = []

    class Key(str):
        def __hash__(self):
            seen.append(self)
            return str.__hash__(self)

    class Recorder:
        def __init__(self, library):
            self.library, self.longest, self.encode = library, 0, library.encode

        def encode_batch_fast(self, texts, **options):
            self.longest = max(self.longest, *(len(t.split()) for t in texts))
            return self.library.encode_batch_fast(texts, **options)

    library = Tokenizer.from_str(MODEL)
    encode = huffman.ChunkEncoder(MODEL)
    for book in (encode.chunks, encode.starts):
        book.update((Key(f"metbefore{i}"), b"") for i in range(9000))
    seen.clear()
    encode.tokenizer = Recorder(encode.tokenizer)
    texts = [" ".join(f"word{i}{'.' * (i % 3)}" for i in range(3000)), "\n".join(f"line{i}" for i in range(3000))]
    for text, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert not seen  # words met before are looked up, not gone through
    assert encode.tokenizer.longest <= huffman.JOINED  # the library takes longer over a word in a long text


def want_files(rows):
    library = Tokenizer.from_str(MODEL)
    start, out = 0, []
    for key, text in sorted(rows):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op1_agrees_with_a_plain_computation(spark):
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in queries.op1_huffman_files(spark, SF).collect())
    assert got == want_files([(r["doc_id"], r["text"]) for r in DOCS])


def test_id_files_with_many_small_blocks(spark):
    rows = [(i, ODD[i % len(ODD)] if i % 7 else None) for i in range(300)]
    root = scratch_folder(spark, "test")
    stored = huffman.encode_ids(spark.createDataFrame(rows, "doc_id long, text string"), MODEL)
    counts = {r.id: r.n for r in huffman.count_ids(stored).collect()}
    dense = np.array([counts.get(i, 0) for i in range(max(counts) + 1)])
    blocks = huffman.write_files(stored, huffman.code_lengths(dense), root, int(dense.sum()), file_ids=20_000, block_ids=500)
    blocks.write.parquet(f"{root}/manifest")
    manifest = spark.read.parquet(f"{root}/manifest")
    assert manifest.count() > manifest.select("file_no").distinct().count() > 1
    got = sorted((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in huffman.read_files(manifest).collect())
    assert got == want_files(rows)


def test_id_files_edge_rows(spark):
    frame = spark.createDataFrame([(None, "x"), (3, None), (3, "y"), (3, "y")], "doc_id long, text string")
    got = huffman.read_files(huffman.write_corpus(spark, frame, MODEL, scratch_folder(spark, "test"))).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 3, 3, 3] and [r.start for r in got][0] == 0
    assert sorted(r.n_tokens for r in got) == [1, 2, 2, 2]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert huffman.read_files(huffman.write_corpus(spark, empty, MODEL, scratch_folder(spark, "test"))).count() == 0


@pytest.mark.parametrize("counts", [[0, 5], [1] * 9, [2 ** i for i in range(30)], [0, 0, 3, 1, 1, 0, 9], []])
def test_code_lengths_are_short_and_complete(counts):
    counts = np.array(counts, np.int64)
    lengths = huffman.code_lengths(counts, most=8)
    assert ((lengths > 0) == (counts > 0)).all() and lengths.max(initial=0) <= 8
    if (counts > 0).sum() > 1:
        assert sum(2.0 ** -int(n) for n in lengths if n) == 1


def test_code_lengths_are_optimal_without_a_limit():
    import heapq

    counts = np.array(_random.sample(range(1, 5000), 200))
    heap, cost = sorted(counts.tolist()), 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    assert int((huffman.code_lengths(counts, most=30) * counts).sum()) == cost
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(300, np.int64), most=8)


def greedy(word, first, following):
    at, n = 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in (following if at else first)), None)
        if end is None:
            return 0
        at, n = end, n + 1
    return n


def test_automaton_counts_like_greedy_matching():
    pieces = ["".join(_random.choice("abc") for _ in range(_random.randint(1, 6))).encode() for _ in range(60)]
    first, following = frozenset(pieces[:30]), frozenset(pieces[20:])
    machine = wordpiece.Automaton(first, following)
    words = ["".join(_random.choice("abcd") for _ in range(_random.randint(1, 30))).encode() for _ in range(3000)]
    want = [greedy(w, first, following) for w in words]
    assert machine.counts(words).tolist() == want == [machine.count(w) for w in words]
    assert any(want) and not all(want)


def test_op2_agrees_with_greedy_matching(spark):
    first, following = wordpiece.byte_level_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    want = {}
    for row in DOCS:
        words = row["text"].encode().split()
        counts = [greedy(b" " + w, first, following) for w in words]
        want[row["doc_id"]] = (len(words), sum(c or 1 for c in counts), counts.count(0))
    got = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in queries.op2_piece_counts(spark, SF).collect()}
    assert got == want


def test_piece_counts_edge_rows(spark):
    frame = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "ab " + "ab" * 500 + " zz", 5)], "doc_id long, text string, n_words int")
    got = wordpiece.count_tokens(frame, frozenset([b"a", b"ab"]), frozenset([b"b", b"ab"]), lead=b"")
    assert sorted((r.n_words, r.n_tokens, r.n_unknown) for r in got.collect()) == [(0, 0, 0), (0, 0, 0), (3, 502, 1)]
    assert wordpiece.count_tokens(frame.limit(0), frozenset([b"a"]), frozenset(), lead=b"").count() == 0
