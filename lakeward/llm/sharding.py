"""Operator 6: consistent-hash ring with virtual nodes and bounded loads (DataFrame functions only).

A key hashes to one of ``RING`` slots; every shard owns ``VNODES`` virtual nodes on
the same ring, placed by a hash of their name alone. A key belongs to the first
virtual node clockwise; keys that find a shard full continue clockwise to the next
shard with room. Keys of one slot share one route, so the overflow is planned on
the ``RING`` per-slot counts (a table of fixed size, the only thing the driver
sees) and comes back as ranges of key ranks inside a slot; each row then finds its
range by its rank. One aggregation and one window, both on the slot.

With ``load_factor`` 1 the capacities add up to the number of rows, so shard sizes
differ by at most one row (law ``rows``); with a larger factor shards keep slack
and fewer keys move when a shard is added.

Defined results: null text has size 1 and checksum 0; a null key hashes by its
text; repeated rows are separate rows that share a slot and get ranks of their own;
ties of the hash are settled by key, size and checksum; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakeward.llm.common import cut, read_table

RING_BITS = 12
RING = 1 << RING_BITS
VNODES = 64
SHARDS = 16


def vnode_slots(shard: int, vnodes: int = VNODES) -> list[int]:
    """Ring slots of a shard's virtual nodes: they depend on the shard's number alone."""
    return [int.from_bytes(hashlib.sha256(f"shard {shard} vnode {v}".encode()).digest()[:8],
                           "big") >> (64 - RING_BITS) for v in range(vnodes)]


def routes(shards: int, vnodes: int = VNODES) -> list[list[int]]:
    """For each ring slot the shards in the order in which a key meets them clockwise."""
    owners: list[list[int]] = [[] for _ in range(RING)]
    for s in range(shards):
        for slot in vnode_slots(s, vnodes):
            owners[slot].append(s)
    out = []
    for slot in range(RING):
        route = dict.fromkeys(s for k in range(RING) for s in owners[(slot + k) % RING])
        out.append([*route, *(s for s in range(shards) if s not in route)])
    return out


def capacities(n: int, shards: int, load_factor: float) -> list[int]:
    if load_factor <= 1:
        return [n * (s + 1) // shards - n * s // shards for s in range(shards)]
    return [math.ceil(load_factor * n / shards)] * shards


def plan(counts: dict[int, int], shards: int, load_factor: float = 1.0,
         vnodes: int = VNODES) -> list[tuple[int, int, int, int, int]]:
    """``(slot, first rank, end rank, shard, slot number of the first)`` for all keys.

    In step k every ring slot offers the keys it still holds to the k-th shard of
    its route; a shard with room takes them in ring order.
    """
    room = capacities(sum(counts.values()), shards, load_factor)
    taken = [0] * shards
    route, done = routes(shards, vnodes), dict.fromkeys(counts, 0)
    segments = []
    for k in range(shards):
        for slot in sorted(counts):
            left = counts[slot] - done[slot]
            shard = route[slot][k]
            take = min(left, room[shard] - taken[shard])
            if take > 0:
                segments.append((slot, done[slot], done[slot] + take, shard, taken[shard]))
                done[slot] += take
                taken[shard] += take
    return segments


_SEGMENT = T.StructType([T.StructField(n, T.LongType())
                         for n in ("seg_slot", "seg_from", "seg_to", "shard", "seg_base")])


def place(rows: DataFrame, order: list[str], shards: int = SHARDS,
          load_factor: float = 1.0) -> DataFrame:
    """``rows`` (with ``ring_hash``) plus ``shard`` and ``slot``, gapless within the shard.

    ``rows`` is read twice: pass it written (``cut``) or cheap to compute.
    """
    spark = rows.sparkSession
    slotted = rows.withColumn(
        "ring_slot", F.shiftrightunsigned(F.col("ring_hash"), 64 - RING_BITS))
    counts = {r["ring_slot"]: r["n"] for r in  # RING rows at most
              slotted.groupBy("ring_slot").agg(F.count("*").alias("n")).collect()}
    segments = spark.createDataFrame(plan(counts, shards, load_factor), _SEGMENT)
    rank = F.row_number().over(Window.partitionBy("ring_slot").orderBy("ring_hash", *order)) - 1
    # At most RING * shards segments of five longs: a fixed size, so broadcast.
    return (slotted.withColumn("ring_rank", rank)
            .join(F.broadcast(segments),
                  (F.col("ring_slot") == F.col("seg_slot"))
                  & (F.col("ring_rank") >= F.col("seg_from"))
                  & (F.col("ring_rank") < F.col("seg_to")))
            .select(*rows.columns, F.col("shard").cast("int").alias("shard"),
                    (F.col("seg_base") + F.col("ring_rank") - F.col("seg_from")).alias("slot")))


def shard_documents(docs: DataFrame, shards: int = SHARDS, load_factor: float = 1.0) -> DataFrame:
    """``doc_id, size, text_crc32, ring_hash, shard, slot`` for every document."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = cut(docs.select(
        "doc_id", (F.octet_length(raw).cast("long") + 1).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.col("text")))
                   ).alias("ring_hash")), "sharding")
    return place(rows, ["doc_id", "size", "text_crc32"], shards, load_factor)


def op6_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))
