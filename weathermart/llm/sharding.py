"""Sharding over fixed virtual slots with a versioned slot-to-shard map.

Records hash into thousands of virtual slots, once and for all. Bytes are added up
per slot, and a map of a few thousand rows says which shard holds which slot. The
first map deals the slots out, largest first, to the lightest shard. Later maps are
edits: a new shard takes slots from the heaviest ones and nothing else moves. Every
map is a version of one Parquet table, so a reader can pin the version it started with.

Only slot totals and maps (at most ``n_slots`` rows) reach the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weathermart.llm.common import text_or_empty, utf8_crc32
from weathermart.sources.paths import materialize, scratch_dir

N_SLOTS = 4096
_SEED = 0x510751

SlotMap = dict[int, int]


def virtual_slot(key: Column, otherwise: Column, n_slots: int = N_SLOTS) -> Column:
    """Slot of a record by its key; records without a key by ``otherwise``."""
    drawn = F.when(key.isNotNull(), F.xxhash64(key, F.lit(_SEED))).otherwise(
        F.xxhash64(otherwise, F.lit(_SEED))
    )
    return F.pmod(drawn, F.lit(n_slots)).cast("int")


def deal_slots(sizes: Mapping[int, int], n_shards: int) -> SlotMap:
    """Slots, largest first, each to the shard that is lightest so far; ties by number."""
    loads = [(0, shard) for shard in range(n_shards)]
    placed: SlotMap = {}
    for slot in sorted(sizes, key=lambda s: (-sizes[s], s)):
        load, shard = heapq.heappop(loads)
        placed[slot] = shard
        heapq.heappush(loads, (load + sizes[slot], shard))
    return placed


def add_shard(placed: SlotMap, sizes: Mapping[int, int]) -> SlotMap:
    """The next version with one more shard, which only takes slots from the others.

    While the new shard is below the mean it takes, from the shard that is heaviest
    then, the largest slot that still fits.
    """
    new = max(placed.values(), default=-1) + 1
    held: dict[int, list[int]] = {}
    for slot in sorted(placed, key=lambda s: (sizes.get(s, 0), s)):
        held.setdefault(placed[slot], []).append(slot)
    loads = {shard: sum(sizes.get(s, 0) for s in slots) for shard, slots in held.items()}
    room = sum(loads.values()) // (new + 1) if new else 0
    edited = dict(placed)
    while True:
        for shard in sorted(loads, key=lambda s: (-loads[s], s)):
            fit = next((s for s in reversed(held[shard]) if 0 < sizes.get(s, 0) <= room), None)
            if fit is not None:
                break
        else:
            return edited
        held[shard].remove(fit)
        loads[shard] -= sizes[fit]
        room -= sizes[fit]
        edited[fit] = new


def write_map(spark: SparkSession, root: str, placed: SlotMap, version: int) -> None:
    """Store a map as one version; a version is written once and never changed."""
    frame = spark.createDataFrame(
        [(int(s), int(h)) for s, h in sorted(placed.items())], "virtual_slot int, shard int"
    )
    frame.coalesce(1).write.mode("errorifexists").parquet(f"{root}/version={version}")


def read_map(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int").parquet(f"{root}/version={version}")


def records(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every row; texts stay where they are."""
    text = F.col("text")
    # Equal texts without doc_id are no key: each row goes its own way. The rows are written
    # once, so every later step sees the same draw.
    spread = F.rand(_SEED)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_or_empty(text)).cast("long") + 1).alias("size"),
        utf8_crc32(text).alias("text_crc32"),
        virtual_slot(F.col("doc_id").cast("long"), spread, n_slots).alias("virtual_slot"),
    )


def slot_sizes(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each slot in use; at most as many rows as there are slots."""
    totals = rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    return {r.virtual_slot: (r.b, r.n) for r in totals.collect()}


def shard_documents(
    docs: DataFrame, n_shards: int = 16, n_slots: int = N_SLOTS, map_root: str | None = None
) -> DataFrame:
    """Place every row of ``docs`` (doc_id, text) in a shard; sizes come out near equal.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, shard, ``position`` (0, 1, ...
    without gaps in each shard), virtual_slot and ``next_shard``, the row's shard once there is
    one more. Maps are stored below ``map_root`` (default: the shared scratch folder): version 1,
    and its edit for one more shard as version 2.

    A null text counts as empty. Rows without doc_id are spread evenly. Repeated
    rows are placed together and numbered one after the other. An empty table gives no
    rows and an empty map. Other columns of ``docs`` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    rows = materialize(records(docs, n_slots), "records")
    totals = slot_sizes(rows)
    placed = deal_slots({slot: b for slot, (b, _) in totals.items()}, n_shards)
    sizes = {slot: b for slot, (b, _) in totals.items()}
    write_map(spark, map_root := map_root or f"{scratch_dir(spark)}/slot_map", placed, 1)
    write_map(spark, map_root, add_shard(placed, sizes), 2)
    before = [0] * n_shards
    starts = []
    for slot in sorted(placed):
        starts.append((slot, before[placed[slot]]))
        before[placed[slot]] += totals[slot][1]
    # At most n_slots rows on this side, whatever the corpus.
    edited = read_map(spark, map_root, 2).withColumnRenamed("shard", "next_shard")
    places = (
        read_map(spark, map_root, 1)
        .join(edited, "virtual_slot")
        .join(spark.createDataFrame(starts, "virtual_slot int, first long"), "virtual_slot")
    )
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("nth", F.row_number().over(in_slot) - 1)
        .join(F.broadcast(places), "virtual_slot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("first") + F.col("nth")).alias("position"),
            "virtual_slot",
            "next_shard",
        )
    )
