"""Fingerprints and their components against a plain computation over all pairs."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from opinionlake.llm import queries, simhash
from opinionlake.llm.hot import attach
from opinionlake.session import scratch_folder

SF = "/root/testdata/sf0.001"
_random = random.Random(12)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=4):
    """{(id, fingerprint): component} by comparing all pairs of fingerprints."""
    prints = [plain_fingerprint(t) for _, t in rows]
    different = sorted(set(prints))
    label = {p: p for p in different}
    for i, a in enumerate(different):
        for b in different[:i]:
            if (a ^ b).bit_count() <= radius and label[a] != label[b]:
                old, new = label[a], label[b]
                label = {p: new if x == old else x for p, x in label.items()}
    least = {}
    for (key, _), p in zip(rows, prints):
        least[label[p]] = min([k for k in (key, least.get(label[p])) if k is not None], default=None)
    return sorted(((key, p, least[label[p]]) for (key, _), p in zip(rows, prints)), key=str)


def found(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = simhash.near_duplicates(spark, frame, scratch_folder(spark, "test")).collect()
    return sorted(((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in out), key=str)


@pytest.mark.parametrize("radius", [0, 3, 4, 7])
def test_planes_find_the_pairs_of_a_plain_comparison(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [int(x) ^ sum(1 << b for b in _random.sample(range(64), _random.randrange(9))) for x in base for _ in range(5)]
    prints = np.array([*base.tolist(), *near, 0, (1 << 64) - 1], np.uint64)
    for count in (1, 63, 64, 65, len(prints)):
        told = prints[-count:]
        got = {(i, j) for a, b in simhash.near_pairs(prints, simhash.bit_planes(told), count, radius) for i, j in zip(a.tolist(), b.tolist())}
        want = {(i, j) for i, x in enumerate(prints.tolist()) for j, y in enumerate(told.tolist()) if (x ^ y).bit_count() <= radius}
        assert got == want


@pytest.mark.parametrize("pieces", [5, 6, 7, 8])
def test_linked_fingerprints_share_a_key(pieces):
    masks = simhash.key_masks(pieces)
    for _ in range(300):
        a = _random.getrandbits(64)
        b = a ^ sum(1 << bit for bit in _random.sample(range(64), 4))
        assert any(a & m == b & m for m in masks)


def test_the_query_agrees_with_a_plain_computation(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    out = queries.op12_sliced_simhash(spark, SF).collect()
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in out), key=str) == plain_components(rows)
    assert all(len(r.fingerprint) == 16 for r in out)
    assert len({r.component_id for r in out}) < len(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(400_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b c d e"), (4, "A B\x0bC  d e"), (4, "A B C d e"), (None, "quite alone here"),
            (5, "one"), (6, "ONE"), (7, "Ä b"), (8, "ä b"), (9, long), (10, long + " x")]
    assert found(spark, rows) == plain_components(rows)


def test_parts_of_a_long_text_give_the_hashes_of_the_whole(monkeypatch):
    text = " ".join(_random.choice(["aa", "b", "cc\ndd", "é"]) for _ in range(500)).encode()
    whole = simhash.shingle_hashes(text)
    for size in (1, 7, 100):
        monkeypatch.setattr(simhash, "parts", lambda t, size=size: __import__("opinionlake.llm.texts", fromlist=["parts"]).parts(t, size))
        assert simhash.shingle_hashes(text) == whole


def test_large_keys_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    base = _random.getrandbits(64)
    prints = {base ^ sum(1 << b for b in _random.sample(range(20), 3)) for _ in range(60)} | {_random.getrandbits(64) for _ in range(60)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    edges = simhash.links(spark, frame, scratch_folder(spark, "test")).collect()
    label = {p: p for p in signed}

    def merge(pairs):
        made = dict(label)
        for a, b in pairs:
            old, new = made[a], made[b]
            made = {p: new if x == old else x for p, x in made.items()} if old != new else made
        groups = {}
        for p, x in made.items():
            groups.setdefault(x, set()).add(p)
        return sorted(map(sorted, groups.values()))

    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 4]
    assert near and merge([(e.a, e.b) for e in edges]) == merge(near)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(spark, empty, scratch_folder(spark, "test")).collect() == []
    other = spark.createDataFrame([(1, "a", "x", {"a": 1})], "doc_id long, text string, fingerprint string, label map<string,int>")
    out = simhash.near_duplicates(spark, other, scratch_folder(spark, "test")).collect()
    assert [(r.doc_id, r.component_id) for r in out] == [(1, 1)]


def test_attach_is_a_left_join(spark, monkeypatch):
    monkeypatch.setattr("opinionlake.llm.hot.SHARE", 3)
    rows = spark.createDataFrame([(i, None if i == 0 else i % 2 if i < 40 else i) for i in range(60)], "n long, k long")
    records = rows.filter("k IS NOT NULL AND k < 50").groupBy("k").count().withColumnRenamed("count", "copies").selectExpr("k", "copies", "k * 10 AS v")
    got = sorted(((r.n, r.k, r.v) for r in attach(rows, records, "k", "copies").collect()), key=str)
    assert got == sorted(((r.n, r.k, None if r.k is None or r.k >= 50 else r.k * 10) for r in rows.collect()), key=str)
