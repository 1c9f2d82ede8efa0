"""Shards of nearly equal size by longest-processing-time scheduling.

Groups that must stay together are sorted by size and go, one by one, to the least
loaded shard. Groups above a fixed share of the total are scheduled by themselves; there
can only be so many of them. All others are bundled by the hash of their key first, and
each bundle is scheduled as one group. So the heap on the driver holds a fixed number of
entries at any input size, and no shard can end further above another than by one group.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import materialize

SHARDS = 40
ENTRIES_PER_SHARD = 2048
SLOT_ROWS = 20_000


def schedule(entries: list[tuple], shards: int) -> dict:
    """Shard of each (key, size): by falling size to the least loaded, ties by key and shard."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for key, size in sorted(entries, key=lambda e: (-e[1], e[0])):
        load, shard = heapq.heappop(heap)
        placed[key] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def assign_shards(
    rows: DataFrame,
    group: str,
    size: str,
    shards: int = SHARDS,
    entries_per_shard: int = ENTRIES_PER_SHARD,
) -> DataFrame:
    """``rows`` with their ``shard``; rows of equal ``group`` (a string) stay together.

    At most ``shards * entries_per_shard`` groups hold that share of the total or more and
    are placed by themselves, all others in as many bundles; both lists are bounded by
    these numbers, whatever the input. A missing group is one group, a missing size 0.
    ``rows`` is read three times and should be a stored table.
    """
    spark = rows.sparkSession
    entries = shards * entries_per_shard
    key = F.coalesce(F.col(group), F.lit(""))
    bundle = F.pmod(F.xxhash64(key), F.lit(entries)).cast("int")
    weight = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    total = rows.agg(F.sum(weight).alias("n")).first()["n"] or 0
    least = max(1, -(-total // entries))
    sizes = rows.groupBy(key.alias("_group")).agg(F.sum(weight).alias("_size"))
    sizes = materialize(sizes, "group-sizes")
    large = sizes.filter(F.col("_size") >= least)
    bundles = (
        sizes.filter(F.col("_size") < least)
        .groupBy(F.pmod(F.xxhash64("_group"), F.lit(entries)).cast("int").alias("_bundle"))
        .agg(F.sum("_size").alias("_size"))
    )
    placed = schedule(
        [((0, r["_group"]), r["_size"]) for r in large.collect()]
        + [((1, r["_bundle"]), r["_size"]) for r in bundles.collect()],
        shards,
    )
    by_group = T.StructType(
        [T.StructField("_group", T.StringType()), T.StructField("_own", T.IntegerType())]
    )
    by_bundle = T.StructType(
        [T.StructField("_bundle", T.IntegerType()), T.StructField("_shared", T.IntegerType())]
    )
    own = spark.createDataFrame([(k[1], s) for k, s in placed.items() if k[0] == 0], by_group)
    shared = spark.createDataFrame([(k[1], s) for k, s in placed.items() if k[0] == 1], by_bundle)
    return (
        rows.withColumns({"_group": key, "_bundle": bundle})
        .join(F.broadcast(own), "_group", "left")
        .join(F.broadcast(shared), "_bundle", "left")
        .withColumn("shard", F.coalesce("_own", "_shared"))
        .drop("_group", "_bundle", "_own", "_shared")
    )


def number_slots(rows: DataFrame, order: list[Column], slot_rows: int = SLOT_ROWS) -> DataFrame:
    """``rows`` with ``slot``, their place within ``shard``, without gaps from 0.

    A shard is cut by the hash of ``order`` into parts of about ``slot_rows`` rows; rows
    are numbered within parts, parts start where the ones before end. No task sees a
    whole shard. Rows alike in all of ``order`` take neighbouring slots in any order.
    """
    counted = rows.count()
    parts = max(1, -(-counted // (SHARDS * slot_rows)))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "_part")
        .agg(F.count("*").alias("_rows"))
        .select("shard", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("shard", "_part").orderBy(*order)
    return (
        rows.withColumn("_at", F.row_number().over(within) - 1)
        .join(starts, ["shard", "_part"])
        .withColumn("slot", (F.col("_start") + F.col("_at")).cast("bigint"))
        .drop("_part", "_at", "_start")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every document; equal texts share a shard, sizes are near equal.

    Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law (``bytes``),
    shard, slot and grown_shard (always null: adding a shard means a new schedule). A
    missing text counts as an empty one; rows without doc_id and repeated rows each take a
    slot; columns other than doc_id and text are not looked at. An empty table gives no
    rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("text_key"),
    )
    rows = materialize(rows, "document-sizes")
    placed = assign_shards(rows, "text_key", "size", shards)
    slots = number_slots(placed, [F.col("doc_id"), F.col("text_key")])
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
