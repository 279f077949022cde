"""Near duplicates by the distance of 64-bit fingerprints.

A fingerprint's bit is set where over half the hashes of a text's shingles have it
set.  Fingerprints that differ in at most ``radius`` bits link, and documents of
linked fingerprints form a component.

Fingerprints are cut into more pieces than there are bits to differ in, so linked
ones agree in some pieces; those pieces are their keys.  Only what shares a key is
compared, in blocks: the bits of many fingerprints are stored plane by plane, so one
operation on a machine word handles a bit of 64 fingerprints, and carry-save counters
add up the differences of all of them.  A word of fingerprints is left as soon as all
are too far away.  Keys of many fingerprints are cut into tiles that meet each other
in tasks of their own.

A text that is null, empty or blank has the fingerprint zero, which links like any
other.  Texts with fewer words than a shingle are one shingle.  A long text is hashed
in parts, so that it needs little memory.  Rows that repeat are all kept; a null
document id is kept and is never a component's id while another id is in it.  An
empty table gives no rows.  Columns other than id and text are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinionlake.llm.graph import components
from opinionlake.llm.hot import attach
from opinionlake.llm.texts import byte_runs, parts

WORDS = 4
SEED = 42
RADIUS = 4
BITS = 64
HASHES_AT_ONCE = 1 << 16
TILE = 4096
SALTS = 32
PAIRS_AT_ONCE = 1 << 17
_U = np.uint64


def shingle_hashes(text: bytes) -> list[int]:
    """Hashes of all shingles of a text, repeats included."""
    digest, found, carried = xxhash.xxh64_intdigest, [], []
    for part in parts(text):
        words = carried + part.lower().split()
        if len(words) >= WORDS:
            joined = b" ".join(words)
            ends = list(itertools.accumulate(map(len, words), lambda end, size: end + 1 + size))
            starts = [0, *[e + 1 for e in ends]]
            found += [digest(joined[a:b], SEED) for a, b in zip(starts, ends[WORDS - 1:])]
            carried = words[1 - WORDS:]
        else:
            carried = words
    if not found and carried:
        found.append(digest(b" ".join(carried), SEED))
    return found


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """The fingerprint of each text."""
    sizes, hashes = np.zeros(len(texts), np.int64), []
    for i, text in enumerate(texts):
        found = shingle_hashes(text)
        sizes[i] = len(found)
        hashes.append(np.array(found, _U))
    flat = np.concatenate(hashes) if hashes else np.zeros(0, _U)
    owner = np.repeat(np.arange(len(texts)), sizes)
    ones = np.zeros((len(texts), BITS), np.int64)
    for at in range(0, len(flat), HASHES_AT_ONCE):
        some, own = flat[at:at + HASHES_AT_ONCE], owner[at:at + HASHES_AT_ONCE]
        bits = np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begins = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        ones[own[begins]] += np.add.reduceat(bits, begins, axis=0, dtype=np.int64)
    most = 2 * ones > sizes[:, None]
    return np.packbits(most, axis=1, bitorder="little").view("<u8").ravel().astype(_U)


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; the fingerprint as a signed number."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprints(some) for _, some in byte_runs(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0, _U), *found]).view(np.int64))],
                                             names=["doc_id", "fingerprint"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text))
    return rows.mapInArrow(run, "doc_id long, fingerprint long")


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """Plane p, word w: bit p of fingerprints 64 w to 64 w + 63."""
    lanes = np.zeros((-(-len(prints) // BITS) * BITS, BITS), np.uint8)
    lanes[:len(prints)] = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(lanes.T, axis=1, bitorder="little")).view("<u8").astype(_U)


def _full_add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry of three one-bit numbers in every lane."""
    half = a ^ b
    return half ^ c, a & b | half & c


def _beyond(radius: int, ones: np.ndarray, twos: np.ndarray, fours: np.ndarray) -> np.ndarray:
    """Lanes whose counter is larger than ``radius``."""
    more, same = np.zeros_like(ones), np.full_like(ones, ~_U(0))
    for bit, plane in ((4, fours), (2, twos), (1, ones)):
        if radius & bit:
            same &= plane
        else:
            more |= same & plane
            same &= ~plane
    return more


def near_pairs(asked: np.ndarray, planes: np.ndarray, count: int, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers (asked, told) of fingerprints at most ``radius`` (up to 7) bits apart; the told ones are ``count`` lanes of planes."""
    if radius > 7:
        raise ValueError("counters hold distances up to 7")
    words = planes.shape[1]
    idle = np.zeros(words, _U)
    if count % BITS:
        idle[-1] = ~_U(0) << _U(count % BITS)
    turn = max(1, PAIRS_AT_ONCE // max(words, 1))
    for begin in range(0, len(asked), turn):
        some = asked[begin:begin + turn]
        # all ones where the asked bit is set
        wanted = -(some[None, :] >> np.arange(BITS, dtype=_U)[:, None] & _U(1)).astype(np.int64)
        wanted = wanted.view(_U)
        q = np.repeat(np.arange(len(some)), words)
        w = np.tile(np.arange(words), len(some))
        ones, twos, fours = (np.zeros(len(q), _U) for _ in range(3))
        over = idle[w]
        for p in range(0, BITS, 4):
            d = [planes[p + i][w] ^ wanted[p + i][q] for i in range(4)]
            ones, a = _full_add(ones, d[0], d[1])
            ones, b = _full_add(ones, d[2], d[3])
            twos, f = _full_add(twos, a, b)
            over |= fours & f
            fours ^= f
            if p % 8 == 4:
                over |= _beyond(radius, ones, twos, fours)
                alive = np.flatnonzero(over != ~_U(0))
                if not len(alive):
                    break
                if len(alive) < len(q):
                    q, w, over = q[alive], w[alive], over[alive]
                    ones, twos, fours = ones[alive], twos[alive], fours[alive]
        else:
            near = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            pair, lane = np.nonzero(near)
            yield begin + q[pair], w[pair] * BITS + lane


def spanning(count: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest number reachable from each of ``count`` numbers over all pairs."""
    label = np.arange(count)
    for i, j in pairs:
        while True:
            least = np.minimum(label[i], label[j])
            if np.array_equal(least, label[i]) and np.array_equal(least, label[j]):
                break
            for end in (label[i], label[j]):
                np.minimum.at(label, end, least)
            while not np.array_equal(label, label[label]):
                label = label[label]
    return label


def pieces_for(prints: int, radius: int = RADIUS) -> int:
    """Into how many pieces fingerprints are cut, so that a key has about a tile of them."""
    pieces = radius + 1
    while prints >> (BITS * (pieces - radius) // pieces) > TILE and pieces < 2 * radius:
        pieces += 1
    return pieces


def key_masks(pieces: int, radius: int = RADIUS) -> list[int]:
    """Masks of the bits that two fingerprints within the radius share: one for every choice of ``pieces - radius`` pieces."""
    cuts = [BITS * i // pieces for i in range(pieces + 1)]
    whole = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [sum(some) for some in itertools.combinations(whole, pieces - radius)]


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def links(spark: SparkSession, prints: DataFrame, root: str, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between different ``fingerprint`` values that connect as all links within ``radius`` do."""
    masks = key_masks(pieces_for(prints.count(), radius), radius)
    keys = [F.struct(F.lit(i).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)]
    keyed = prints.select("fingerprint", F.explode(F.array(*keys)).alias("k")).select(
        "fingerprint", "k.choice", "k.key", F.pmod(F.xxhash64("fingerprint"), F.lit(SALTS)).cast("int").alias("salt"))
    large = keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TILE)
    large = _written(spark, large.select("choice", "key", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")), f"{root}/large_keys")
    # rows of a large key are dealt by salt before they meet its number of tiles
    spread = large.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    tiled = keyed.join(spread, ["choice", "key", "salt"], "left") if large.limit(1).count() else keyed.withColumn("tiles", F.lit(None).cast("int"))
    tiled = tiled.withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.pmod(F.xxhash64(F.col("fingerprint"), F.lit(1)), F.col("tiles")).cast("int")
    # a tile meets itself and every other tile of its key
    met = tiled.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")).select(
        "choice", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        (F.col("own") <= F.col("other")).alias("asks"), "fingerprint")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b"]
        held: list[np.ndarray] = []  # columns of the group that a batch ended in

        def edges(part: np.ndarray) -> Iterator[np.ndarray]:
            if part.shape[1] < 2:
                return
            found, asks = part[5].view(_U), part[4] == 1
            order = np.argsort(found, kind="stable")  # like ones in a word, so that words are left early
            found, asks = found[order], asks[order]
            told = found if asks.all() else found[~asks]
            asked = found[asks]
            if not len(told) or not len(asked):
                return
            both = np.concatenate((asked, told)) if told is not found else found
            shift = len(asked) if told is not found else 0
            pairs = ((i, j + shift) for i, j in near_pairs(asked, bit_planes(told), len(told), radius))
            label = spanning(len(both), pairs)
            other = np.flatnonzero(label != np.arange(len(both)))
            if len(other):
                yield np.stack((both[other].view(np.int64), both[label[other]].view(np.int64)))

        def packed(found: list[np.ndarray]) -> pa.RecordBatch:
            joined = np.concatenate(found, axis=1)
            return pa.RecordBatch.from_arrays([pa.array(joined[0]), pa.array(joined[1])], names=names)

        for batch in batches:
            columns = np.stack([c.cast(pa.int64()).to_numpy(zero_copy_only=False) for c in batch.columns])
            columns = np.concatenate([*held, columns], axis=1)
            change = np.flatnonzero((columns[:4, 1:] != columns[:4, :-1]).any(axis=0)) + 1
            cuts = [0, *change.tolist()]
            found = [e for a, b in zip(cuts, cuts[1:]) for e in edges(columns[:, a:b])]
            held = [columns[:, cuts[-1]:]]
            if found:
                yield packed(found)
        found = [e for part in held for e in edges(part)]
        if found:
            yield packed(found)

    dealt = met.repartition("choice", "key", "x", "y").sortWithinPartitions("choice", "key", "x", "y")
    return dealt.select("choice", "key", "x", "y", F.col("asks").cast("int"), "fingerprint").mapInArrow(compare, "a long, b long")


def _written(spark: SparkSession, frame: DataFrame, path: str) -> DataFrame:
    frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def near_duplicates(spark: SparkSession, docs: DataFrame, root: str, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (signed) and ``component_id``, the smallest id that links reach.

    Intermediate tables go below ``root``.
    """
    rows = _written(spark, fingerprint_documents(docs, key, text), f"{root}/rows")
    prints = _written(spark, rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least")), f"{root}/prints")
    edges = _written(spark, links(spark, prints.select("fingerprint"), root, radius).distinct(), f"{root}/edges")
    linked = components(spark, edges, f"{root}/rounds").withColumnRenamed("node", "fingerprint")
    members = _written(spark, prints.join(linked, "fingerprint"), f"{root}/members")
    leasts = members.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size"))
    named = _written(spark, attach(members.select("fingerprint", "label"), _written(spark, leasts, f"{root}/leasts"), "label", "size")
                     .select("fingerprint", "component_id"), f"{root}/named")
    classes = _written(spark, prints.join(named, "fingerprint", "left").select(
        "fingerprint", "copies", F.coalesce("component_id", "least").alias("component_id")), f"{root}/classes")
    return attach(rows, classes, "fingerprint", "copies").select("doc_id", "fingerprint", "component_id")
