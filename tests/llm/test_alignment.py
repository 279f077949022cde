"""Token alignment against both tokenizers on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from opinionlake.llm import alignment, queries
from opinionlake.session import scratch_folder

SF = "/root/testdata/sf0.001"
_random = random.Random(14)
_A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
_A.encode_special_tokens = True
_B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def models():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return a.read(), b.read()


def plain_groups(text):
    """Groups ([ids of A], [ids of B]) of a whole text; None if it is not given back."""
    if not text:
        return None
    want = (" " + text).encode()
    alphabet = alignment.byte_alphabet()
    a = [(i, bytes(alphabet[c] for c in _A.id_to_token(i))) for i in _A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p[3:5], 16)]) if _B.is_byte(i) else p.replace("▁", " ").encode()) for i in _B.encode(text) for p in [_B.id_to_piece(i)]]
    if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
        return None
    a_ends = [(i, e) for (i, _), e in zip(a, np.cumsum([len(x) for _, x in a]).tolist())]
    b_ends = [(i, e) for (i, _), e in zip(b, np.cumsum([len(x) for _, x in b]).tolist())]
    groups, begin = [], 0
    for cut in sorted({e for _, e in a_ends} & {e for _, e in b_ends}):
        groups.append(([i for i, e in a_ends if begin < e <= cut], [i for i, e in b_ends if begin < e <= cut]))
        begin = cut
    return groups


def plain(rows):
    grouped = [plain_groups(text) or [] for _, text in rows]
    linked = [Counter((a, b) for xs, ys in groups for a in xs for b in ys) for groups in grouped]
    count = Counter(pair for links in linked for pair in links)
    highest = {}
    for (a, _), n in count.items():
        highest[a] = max(n, highest.get(a, 0))
    out = []
    for (key, _), groups, links in zip(rows, grouped, linked):
        listing = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()),
                    sum(n for pair, n in links.items() if count[pair] == highest[pair[0]]), sum(n * count[pair] for pair, n in links.items()),
                    hashlib.sha256(listing.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = alignment.align(spark, frame, scratch_folder(spark, "test"), *models()).select(*COLUMNS).collect()
    return sorted((tuple(r) for r in out), key=str)


def test_the_query_agrees_with_whole_texts(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    out = queries.op11_incidence_alignment(spark, SF).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in out), key=str) == plain(rows)


ODD = [(1, None), (2, ""), (3, " "), (4, "  lead and  double  blanks "), (5, "tab\there\n\nand lines \n x"), (6, "a▁b"), (7, "<|endoftext|> <s> <0x41> </s>"),
       (8, "日本語 テキスト \U0001f600\U0001f468‍\U0001f469"), (9, "nul\0 in it"), (None, "no id"), (None, "no id"), (10, "no id"),
       (11, "  nbsp x  em"), (12, "can't won't 's 't"), (13, "x" * 3000), (14, "é é ﬁ Å"), (15, "\x1c a \x1f b\x85c"), (16, "▁ a"), (17, "...!? 123456 7")]


def test_odd_rows(spark):
    assert found(spark, ODD) == plain(ODD)


def test_random_texts(spark):
    some = ["a", "the", " ", "  ", "\n", "\t", "é", "ß", "中", "12", ".", "'s", "▁", " ", "Wort", "\U0001f600", "́"]
    rows = [(i, "".join(_random.choice(some) + _random.choice(["", " "]) for _ in range(_random.randrange(30)))) for i in range(400)]
    assert found(spark, rows) == plain(rows)


def test_small_runs_and_forgotten_pieces(spark, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()[:30]]
    known = alignment.Pieces(alignment.Pair(*models()))
    monkeypatch.setattr(alignment, "KEPT_PIECES", 50)
    for key, text in rows:
        batch = alignment.aligned_run(known, 1, alignment.pa.array([key], alignment.pa.int64()), [text or ""])
        groups = plain_groups(text) or []
        assert batch.column("n_groups").to_pylist()[0] == len(groups)
        pairs = {(a << 32 | b) for xs, ys in groups for a in xs for b in ys}
        assert set(batch.column("pairs").to_pylist()[1]) == pairs


def test_products_of_sparse_matrices():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = rng.integers(0, 3, (6, 5)) * (rng.random((6, 5)) < 0.4), rng.integers(0, 3, (5, 7)) * (rng.random((5, 7)) < 0.4)

        def csr(dense):
            rows, columns = np.nonzero(dense)
            made = alignment.Csr.of(rows, columns, *dense.shape)
            return alignment.Csr(made.ends, columns, dense[rows, columns], dense.shape[1])

        def dense(made, shape):
            out = np.zeros(shape, np.int64)
            out[made.rows(), made.columns] = made.values
            return out

        assert (dense(csr(a).times(csr(b)), (6, 7)) == a @ b).all()
        assert (dense(csr(a).transposed(), (5, 6)) == a.T).all()


def test_overlaps_share_bytes():
    links = alignment.overlap_links(np.array([2, 5]), np.array([1, 4, 5]))
    assert sorted(zip(links.rows().tolist(), links.columns.tolist(), links.values.tolist())) == [(0, 0, 1), (0, 1, 1), (1, 1, 2), (1, 2, 1)]


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(spark, empty, scratch_folder(spark, "test"), *models()).collect() == []
    other = spark.createDataFrame([(1, "a b", 5, {"a": 1})], "doc_id long, text string, run long, words map<string,int>")
    assert [r.n_groups for r in alignment.align(spark, other, scratch_folder(spark, "test"), *models()).collect()] == [2]


def test_vocabulary_that_joins_across_blanks_is_refused(monkeypatch):
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "id_to_piece", lambda self, number: "a▁b")
    with pytest.raises(ValueError):
        alignment.Pair(*models())
