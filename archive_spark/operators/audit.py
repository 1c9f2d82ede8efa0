"""Data-quality audits of segments and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP = 4096
CHUNK = 10_000


def missing_durations(segments: DataFrame, duration: str = "broadcast_duration") -> DataFrame:
    return segments.filter(F.coalesce(F.col(duration), F.lit("")) == "")


def id_gap_ranges(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Runs of ids without a page between the lowest and the highest id.

    Ids are looked at in groups of ``GROUP`` consecutive values, then the groups in
    groups of ``GROUP``, and so on: each window holds at most ``GROUP`` rows, and after
    four levels the last one has at most 2 * 2**63 / GROUP**4 = 65,536 for any bigint.
    """
    runs = pages.filter(F.col(page_id).isNotNull()).select(F.col(page_id).alias("lo")).distinct()
    runs = runs.withColumn("hi", F.col("lo"))
    gaps = None
    width = 1
    for level in range(5):
        width *= GROUP
        group = _group_start("lo", width) if level < 4 else F.lit(0)
        grouped = runs.withColumn("group", group)
        window = Window.partitionBy("group").orderBy("lo")
        found = (
            grouped.withColumn("next", F.lead("lo").over(window))
            .filter(F.col("next") - 1 > F.col("hi"))
            .select((F.col("hi") + 1).alias("gap_start"), (F.col("next") - 1).alias("gap_end"))
        )
        gaps = found if gaps is None else gaps.unionByName(found)
        runs = (
            grouped.groupBy("group")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .drop("group")
        )
    return gaps.withColumn("n_missing", F.col("gap_end") - F.col("gap_start") + 1)


def _group_start(column: str, width: int) -> Column:
    return F.col(column) - F.pmod(F.col(column), F.lit(width).cast("bigint"))


def id_gaps(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Every missing id as a row; long runs are unfolded in pieces of ``CHUNK`` ids."""
    pieces = id_gap_ranges(pages, page_id).select(
        F.explode(F.sequence("gap_start", "gap_end", F.lit(CHUNK).cast("bigint"))).alias("start"),
        "gap_end",
    )
    stop = F.least(F.col("start") + (CHUNK - 1), F.col("gap_end"))
    return pieces.select(F.explode(F.sequence("start", stop)).alias(page_id))


def malformed_meta(pages: DataFrame, tags: tuple[str, ...] = ("dl", "dt", "dd")) -> DataFrame:
    """Pages in which one of the tags is not opened as often as it is closed."""
    counts = {}
    for tag in tags:
        counts[f"{tag}_open"] = F.regexp_count("html", F.lit(rf"(?i)<{tag}(?=[\s>/])"))
        counts[f"{tag}_close"] = F.regexp_count("html", F.lit(rf"(?i)</{tag}\s*>"))
    counted = pages.withColumns(counts).drop("html")
    uneven = F.lit(False)
    for tag in tags:
        uneven = uneven | (F.col(f"{tag}_open") != F.col(f"{tag}_close"))
    return counted.filter(uneven)


def duplicate_segments(segments: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    keys = keys or ("broadcast_order",)
    return segments.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
