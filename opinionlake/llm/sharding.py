"""Sharding by fixed virtual slots.

A record's slot is a hash of its id and never changes.  Bytes are aggregated per
slot; a versioned map says which shard holds each slot.  Rebalancing edits the
map: it moves slots between shards and never rehashes records.

A null text weighs only the fixed bytes per record; a null id is a key like any
other.  Rows with equal ids share a slot; their order in the shard is by checksum
and size, and rows equal in all of these may take each other's place.  Groups of equal
texts are split, since their ids differ; rows of one id are never split, so an id that
holds more than a shard's share makes its shard larger.  Texts of any length only
count by their bytes.  An empty table gives a map and no rows.  Columns other than id and
text are not read, and are written whole by ``write_shards``.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# The map has this many entries at any size of the data.
SLOTS = 8192
RECORD_BYTES = 16


@dataclass(frozen=True)
class SlotMap:
    version: int
    shards: int
    shard_of: tuple[int, ...]

    @staticmethod
    def first(shards: int, slots: int = SLOTS) -> "SlotMap":
        """Version 1: the slots dealt out in turn."""
        return SlotMap(1, shards, tuple(slot % shards for slot in range(slots)))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.version, self.shards, slot, shard) for slot, shard in enumerate(self.shard_of)],
                                     "version int, shards int, virtual_slot int, shard int")


def save_map(spark: SparkSession, current: SlotMap, root: str) -> None:
    """Store a version of the map; storing a version again replaces it."""
    current.frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{root}/version={current.version:06d}")


def load_map(spark: SparkSession, root: str, version: int) -> SlotMap:
    rows = spark.read.parquet(f"{root}/version={version:06d}").orderBy("virtual_slot").collect()
    return SlotMap(version, rows[0]["shards"], tuple(row["shard"] for row in rows))


def read_map(spark: SparkSession, root: str, version: int) -> DataFrame:
    """(virtual_slot, shard) of a stored version: a fixed number of rows."""
    return spark.read.schema("version int, shards int, virtual_slot int, shard int").parquet(f"{root}/version={version:06d}").select("virtual_slot", "shard")


def with_slots(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """``key``, size, checksum and slot of each record."""
    return docs.select(
        F.col(key),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(slots)).cast("int").alias("virtual_slot"))


def slot_loads(records: DataFrame) -> DataFrame:
    """Bytes and records of each slot that has any; summed in every task before the shuffle."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))


def rebalance(current: SlotMap, load: Mapping[int, int], shards: int | None = None) -> SlotMap:
    """The next version: slots move from the heaviest shard to the lightest while that evens them out.

    Works on one number per slot.  Every move lowers the larger of the two
    shards; at the end no single slot can be moved with gain.
    """
    shards = shards or current.shards
    owner = list(current.shard_of)
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    total = [0] * shards
    for slot, shard in enumerate(owner):
        weight = load.get(slot, 0)
        if shard >= shards:  # the shard is given up
            shard = owner[slot] = min(range(shards), key=total.__getitem__)
        held[shard][slot] = weight
        total[shard] += weight
    heavy = [(-total[s], s) for s in range(shards)]
    heapq.heapify(heavy)
    while heavy:
        known, source = heapq.heappop(heavy)
        if -known != total[source]:
            continue
        target = min(range(shards), key=total.__getitem__)
        gap = total[source] - total[target]
        # the slot nearest to half the gap
        best = min((slot for slot, weight in held[source].items() if 0 < weight < gap),
                   key=lambda slot: (abs(gap - 2 * held[source][slot]), slot), default=None)
        if best is None:
            continue
        weight = held[source].pop(best)
        held[target][best] = weight
        owner[best] = target
        total[source] -= weight
        total[target] += weight
        heapq.heappush(heavy, (-total[source], source))
        heapq.heappush(heavy, (-total[target], target))
    return SlotMap(current.version + 1, shards, tuple(owner))


def place(records: DataFrame, shard_of: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add ``shard`` and ``slot``, the record's gapless number in its shard, by a stored map (``read_map``).

    Numbers are counted inside a virtual slot, then moved by the count of the
    shard's earlier slots.  So a window holds one slot's narrow rows, not a shard's.
    """
    # the map and the counts have one row per slot: a fixed number, whatever the data
    counted = records.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("_n")).join(F.broadcast(shard_of), "virtual_slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("virtual_slot", "shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("virtual_slot").orderBy(F.col(key), "text_crc32", "size")
    numbered = records.withColumn("_at", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(starts), "virtual_slot").withColumn(
        "slot", (F.col("_start") + F.col("_at")).cast("long")).drop("_start", "_at")


def shard(spark: SparkSession, docs: DataFrame, shards: int, root: str, key: str = "doc_id", text: str = "text",
          slots: int = SLOTS) -> tuple[DataFrame, SlotMap]:
    """Place all records in ``shards`` shards of nearly equal bytes; also the map used.

    Version 1 of the map, the slots in turn, is stored below ``root``, read back, edited by the
    bytes of the slots and stored as version 2, by which records are placed.
    """
    records = with_slots(docs, key, text, slots)
    save_map(spark, SlotMap.first(shards, slots), root)
    # one row per slot reaches the driver: a fixed number
    load = {row["virtual_slot"]: row["bytes"] for row in slot_loads(records).collect()}
    current = rebalance(load_map(spark, root, 1), load)
    save_map(spark, current, root)
    return place(records, read_map(spark, root, current.version), key), current


def write_shards(docs: DataFrame, shard_of: DataFrame, slots: int, path: str, key: str = "doc_id", folder: str = "shard") -> None:
    """Write whole rows, one folder per shard, by a stored map; tasks split a shard by virtual slot.

    ``folder`` names the folders' column, which the rows must not have.
    """
    if folder in docs.columns:
        raise ValueError(f"rows have a column {folder}; name the folders otherwise")
    at = F.pmod(F.xxhash64(F.col(key)), F.lit(slots)).cast("int")
    rows = docs.withColumn("_slot", at).join(F.broadcast(shard_of.select(F.col("virtual_slot").alias("_slot"), F.col("shard").alias(folder))), "_slot")
    rows.repartition("_slot").drop("_slot").write.mode("overwrite").partitionBy(folder).parquet(path)
