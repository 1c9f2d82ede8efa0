"""The year subset: filter, count, match with stored pages, export and reconcile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import (
    archive_size_mb,
    count_by_year,
    file_match_counts,
    reconcile,
    stored_size_mb,
)
from ..operators.filters import year_range
from ..sources.segments import export_subset, read_segments_jsonl


def year_subset_job(
    segments: DataFrame,
    files: DataFrame,
    lo: int,
    hi: int,
    path: str,
    mode: str = "errorifexists",
) -> tuple[DataFrame, DataFrame]:
    """Write the subset of the years ``lo`` to ``hi`` and report on it.

    ``files`` are stored segment pages, one per ``page_id``. Returns the rows per year
    and one row of totals. Both read the written subset; the rows of the source are counted
    as it is written. ``subset_sizes`` tells what the two data sets take in storage.
    """
    spark = segments.sparkSession
    source = Observation()
    counted = segments.observe(source, F.count(F.lit(1)).alias("total"))
    subset = year_range(counted, lo, hi)
    export_subset(subset, files, path, mode)

    written = read_segments_jsonl(spark, f"{path}/data", subset.schema)
    stored = spark.read.schema(files.schema).parquet(f"{path}/html")
    if mode == "ignore":  # may have written, and so counted, nothing
        totals = segments.agg(F.count("*").alias("total"))
    else:
        totals = spark.range(1).select(F.lit(source.get["total"]).cast("bigint").alias("total"))
    parts = [
        totals,
        file_match_counts(written, stored, "broadcast_order", "page_id"),
        reconcile(written, stored, "broadcast_order", "page_id"),
        archive_size_mb(stored),
    ]
    columns = ["total", "copied", "missing", "records", "files", "ok", "size_mb"]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    report = merged.agg(*[F.max(c).alias(c) for c in columns])
    return count_by_year(written), report




def subset_sizes(spark: SparkSession, path: str) -> DataFrame:
    """One row per data set of a written subset, ``data`` and ``html``: MB in storage."""
    data, html = (
        stored_size_mb(spark, f"{path}/{part}").select(F.lit(part).alias("part"), "stored_mb")
        for part in ("data", "html")
    )
    return data.unionByName(html)
