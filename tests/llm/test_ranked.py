"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import pyarrow.parquet as pq

from opinionlake.llm import queries, ranked
from opinionlake.session import scratch_folder
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.001"
_random = random.Random(13)


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(docs, items):
    """(item, rank, doc_id, score) by scoring every document for every item."""
    counted = [(key, Counter(terms(text))) for key, text in docs if terms(text)]
    size, total = len(counted), sum(sum(c.values()) for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, c in counted:
            m = 25 + 75 * sum(c.values()) * size // total
            score = sum(math.floor(1000 * math.log((2 * size + 2) / (2 * holding[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, key is None, key))
        out += [(item, rank, key, -score) for rank, (score, _, key) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:10], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, kind="long"):
    root = scratch_folder(spark, "test")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    ranked.build_index(frame).write.parquet(f"{root}/index")
    asked = spark.createDataFrame(items, f"item_id {kind}, text string")
    out = ranked.search(spark, spark.read.parquet(f"{root}/index"), asked, root)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_the_query_agrees_with_scoring_every_document(spark):
    docs, items = ([tuple(r[c] for c in (key, "text")) for r in pq.read_table(f"{SF}/{name}.parquet").to_pylist()]
                   for name, key in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert sorted((tuple(r) for r in queries.op13_max_sketch_search(spark, SF).collect()), key=str) == plain(docs, items)


def test_the_query_agrees_with_its_sql(spark):
    query = queries.llm_queries()["op13_max_sketch_search"]
    assert difference(spark, connect(SF), query, SF) is None


def test_blocks_of_items_and_terms_that_share_a_coordinate(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_BYTES", 300)
    monkeypatch.setattr(ranked, "COORDINATES", 1)
    monkeypatch.setattr(ranked, "LEAST_COORDINATES", 2)
    some = lambda n: " ".join(_random.choice("abcdefghijklmnop") * _random.randrange(1, 4) for _ in range(n))
    docs = [(i, some(_random.randrange(1, 40))) for i in range(120)] + [(200 + i, "copy of one text a b c") for i in range(30)]
    items = [(i, some(6)) for i in range(20)] + [(50, "copy text text")]
    assert found(spark, docs, items) == plain(docs, items)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "--- ..."), (None, "alpha beta"), (4, "ALPHA, beta!"), (4, "ALPHA, beta!"), (5, "alpha " * 300),
            (6, "Ä alpha_beta"), (7, "ä x beta"), (8, " ".join(f"t{i}" for i in range(300_000)))]
    items = [(1, "Alpha beta beta"), (1, "Alpha beta beta"), (None, "t5 t6"), (2, None), (3, ""), (4, "nowhere"), (5, "Ä x ä x")]
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, [("q", "beta")], "string") == plain(docs, [("q", "beta")])


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a")], []) == [] and found(spark, [], []) == []
    assert found(spark, [(1, None)], [(1, "a")]) == []


def test_bounds_are_never_below_scores():
    texts = [" ".join(_random.choice("abcdefghij") for _ in range(_random.randrange(1, 600))).encode() for _ in range(40)]
    block = ranked.Block.of([b"a b c c", b"j x"])
    for text in texts:
        counted = ranked.count_terms(text)
        names = list(counted)
        made = ranked.sketch(names, ranked.np.array(list(counted.values())))
        searcher = ranked.Searcher(block, [1] * len(block.vocabulary), 40, 1000)
        length = ranked.relative_length(sum(counted.values()), 40, 1000)
        impacts = searcher._impacts(made[None, :].T, ranked.np.array([length]))
        for name, at in zip(searcher.names, searcher.hashes & (len(made) - 1)):
            assert name not in counted or impacts[at, 0] >= ranked.impact(counted[name], length)
