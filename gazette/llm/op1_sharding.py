"""Sharding over fixed virtual slots, with DataFrame functions only.

A record's hash puts it into one of thousands of virtual slots for good. The bytes and
rows of each slot are summed, and a slot map says which shard holds a slot. Maps
have versions: the first gives every slot a shard at random, and ``rebalance``
edits it, moving as few slots as bring the shards' bytes together (law ``bytes``). A
map has as many entries as there are slots, whatever the data's size, so it
is planned on the driver, stored as a small table, and looked up as an array. Rows are
placed by a version read back from that table.

Rows are never moved to be counted: copies are added up before the shuffle, and
a row's place in its shard is the slot's place plus its place in the slot.
"""

from __future__ import annotations

import bisect
import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.llm.shared import materialize, scratch_path, table

SLOTS = 8192
SHARDS = 8
#: Copies of one row that are made at a time.
COPIES = 65_536


@dataclass(frozen=True)
class SlotMap:
    """shard[i] holds slot i; each edit raises the version."""

    version: int
    n_shards: int
    shard: tuple[int, ...]

    def column(self, slot: Column) -> Column:
        """The shard of a slot, as an expression."""
        return lookup(self.shard, slot).cast("int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Adds this version to the map table at path."""
        slots = spark.range(len(self.shard)).select(F.col("id").cast("int").alias("slot"), self.column(F.col("id")).alias("shard"))
        slots.withColumn("n_shards", F.lit(self.n_shards)).withColumn("version", F.lit(self.version)).coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def lookup(values: tuple[int, ...], at: Column) -> Column:
    """values[at] as an array literal: one string, parsed once."""
    return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>"), at.cast("int"))


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A version of a stored map, the last by default."""
    found = spark.read.parquet(path)
    version = version or found.agg(F.max("version")).first()[0]
    rows = found.where(F.col("version") == version).orderBy("slot").collect()  # SLOTS rows
    return SlotMap(version, rows[0].n_shards, tuple(r.shard for r in rows))


def first_map(n_slots: int = SLOTS, n_shards: int = SHARDS) -> SlotMap:
    return SlotMap(1, n_shards, tuple(i % n_shards for i in range(n_slots)))


def rebalance(old: SlotMap, slot_bytes: dict[int, int], n_shards: int | None = None) -> SlotMap:
    """The next version: shards of nearly equal bytes, other slots staying where they are.

    Slots leave shards that are over the mean, largest first as far as they fit the surplus; they and
    the slots of shards that are gone go, largest first, to the emptiest shard. Then the fullest
    shard gives the emptiest the slot nearest to half their gap, while that makes the gap smaller.
    """
    n = n_shards or old.n_shards
    mean = sum(slot_bytes.values()) / n
    shard = list(old.shard)
    held: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    loose = []
    for slot, s in enumerate(shard):
        (held[s] if s < n else loose).append((slot_bytes.get(slot, 0), slot))
    load = [sum(b for b, _ in x) for x in held]
    for s in range(n):
        stay = []
        for b, slot in sorted(held[s], reverse=True):
            if b and load[s] - b >= mean:
                load[s] -= b
                loose.append((b, slot))
            else:
                stay.append((b, slot))
        held[s] = stay
    order = [(x, s) for s, x in enumerate(load)]
    heapq.heapify(order)
    for b, slot in sorted(loose, key=lambda x: (-x[0], x[1])):
        least, s = heapq.heappop(order)
        held[s].append((b, slot))
        heapq.heappush(order, (least + b, s))
    load = [sum(b for b, _ in x) for x in held]
    for x in held:
        x.sort()
    for _ in range(20 * n):
        low, high = load.index(min(load)), load.index(max(load))
        gap = load[high] - load[low]
        at = bisect.bisect_left(held[high], (gap / 2, -1))
        near = min((x for x in held[high][max(0, at - 1) : at + 1] if 0 < x[0] < gap), key=lambda x: abs(x[0] - gap / 2), default=None)
        if near is None:
            break
        held[high].remove(near)
        bisect.insort(held[low], near)
        load[high] -= near[0]
        load[low] += near[0]
    for s, x in enumerate(held):
        for _, slot in x:
            shard[slot] = s
    return SlotMap(old.version + 1, n, tuple(shard))


def measured(df: DataFrame, n_slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, copy and virtual slot of every row.

    Size is the text's UTF-8 bytes plus 1 (null: 1), the checksum of a null that of an empty text.
    Equal rows are added up and numbered, and each copy has a hash of its own, so no
    repeated row fills a slot. Blocks of copies are dealt to tasks before the copies are made.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = df.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES).cast("long")))
    copy = F.explode(F.sequence(F.col("block") * COPIES, F.least((F.col("block") + 1) * COPIES, F.col("n")) - 1))
    blocks = counted.withColumn("block", block).repartition("doc_id", "size", "text_crc32", "block")
    copies = blocks.withColumn("copy", copy).drop("block", "n")
    return copies.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32", "size", "copy"), F.lit(n_slots)).cast("int"))


def slot_totals(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """(bytes, rows) of each slot: SLOTS rows at most."""
    found = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    return {r.virtual_slot: (r.bytes, r.n) for r in found}


def place(rows: DataFrame, slots: SlotMap, totals: dict[int, tuple[int, int]]) -> DataFrame:
    """Adds shard and slot, the row's place in its shard, from 0 without gaps."""
    begin, at = [], [0] * slots.n_shards
    for i, s in enumerate(slots.shard):
        begin.append(at[s])
        at[s] += totals.get(i, (0, 0))[1]
    inside = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "copy")) - 1
    v = F.col("virtual_slot")
    return rows.withColumn("shard", slots.column(v)).withColumn("slot", lookup(tuple(begin), v) + inside)


def assign(df: DataFrame, n_shards: int = SHARDS, n_slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard, slot, map_version of every row of df.

    Shard bytes are near equal. The last map stored at map_path (by default a new table in the shared folder), or a first
    one that is stored there, is edited; the new version is added, and rows are placed by it as it is
    read back. Nulls count as empty texts, null doc_ids are ids like others,
    equal rows get places of their own, an empty table gives none; other columns are ignored.
    """
    spark = df.sparkSession
    rows = materialize(measured(df, n_slots), "slots")
    totals = slot_totals(rows)
    map_path = map_path or scratch_path(spark, "slot_map")
    path = spark._jvm.org.apache.hadoop.fs.Path(map_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        first_map(n_slots, n_shards).save(spark, map_path)
    edited = rebalance(load_map(spark, map_path), {k: v[0] for k, v in totals.items()}, n_shards)
    edited.save(spark, map_path)
    slots = load_map(spark, map_path, edited.version)
    return place(rows, slots, totals).withColumn("map_version", F.lit(slots.version)).drop("copy")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 8 shards under the law ``bytes``."""
    found = assign(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
