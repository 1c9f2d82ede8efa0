"""Counts, sizes and reconciliation; every result is small.

Rows are pre-aggregated by key before any join, so a key with very many records
reaches the join as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .filters import require_key


def count_by_year(df: DataFrame, year: str = "year") -> DataFrame:
    return df.groupBy(year).agg(F.count("*").alias("n")).orderBy(year)


def links_per_page(links: DataFrame) -> DataFrame:
    """Evening and special links of each source page."""
    return links.groupBy("src_url").agg(
        F.count_if(F.col("list") == "evening").alias("evening_links"),
        F.count_if(F.col("list") == "special").alias("special_links"),
    )


def progress(
    months: DataFrame, done_months: DataFrame, links: DataFrame, segments: DataFrame, date: str
) -> DataFrame:
    """One row: months found and read, segments expected and emitted, date range."""
    no_date = F.lit(None).cast("string")

    def part(df: DataFrame, name: str, day: Column = no_date) -> DataFrame:
        return df.agg(
            F.count("*").alias("n"), F.min(day).alias("low"), F.max(day).alias("high")
        ).withColumn("part", F.lit(name))

    parts = (
        part(months, "months_total")
        .unionByName(part(done_months, "months_done"))
        .unionByName(part(links, "segments_expected"))
        .unionByName(part(segments, "segments_emitted", F.col(date).cast("string")))
    )
    names = ["months_total", "months_done", "segments_expected", "segments_emitted"]
    return parts.agg(
        *[F.max(F.when(F.col("part") == n, F.col("n"))).alias(n) for n in names],
        F.max("low").alias("first_date"),
        F.max("high").alias("last_date"),
    )


def _records_per_key(df: DataFrame, key: str) -> DataFrame:
    return (
        require_key(df, key)
        .groupBy(F.col(key).alias("_key"))
        .agg(F.count("*").alias("_records"))
    )


def file_match_counts(df: DataFrame, files: DataFrame, key: str, file_key: str) -> DataFrame:
    """One row: records with a stored file and without; improper keys count in neither."""
    present = files.select(F.col(file_key).alias("_key")).distinct().withColumn("_file", F.lit(True))
    matched = _records_per_key(df, key).join(present, "_key", "left")
    has_file = F.col("_file").isNotNull()
    return matched.agg(
        F.coalesce(F.sum(F.when(has_file, F.col("_records"))), F.lit(0)).alias("copied"),
        F.coalesce(F.sum(F.when(~has_file, F.col("_records"))), F.lit(0)).alias("missing"),
    )


def archive_size_mb(files: DataFrame, html: str = "html") -> DataFrame:
    """Bytes of all pages in MB to one decimal."""
    size = F.sum(F.octet_length(html)) / F.lit(1024 * 1024)
    return files.agg(F.round(F.coalesce(size, F.lit(0.0)), 1).alias("size_mb"))


def stored_size_mb(spark: SparkSession, path: str) -> DataFrame:
    """One row: MB that the files below ``path`` take, compressed as they are."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    size = F.coalesce(F.sum("length"), F.lit(0)) / F.lit(1024 * 1024)
    return files.agg(F.round(size, 1).alias("stored_mb"))


def reconcile(df: DataFrame, files: DataFrame, key: str, file_key: str) -> DataFrame:
    """One row: records, stored files among their keys, and whether the two agree.

    Two records of one id share a file and therefore fail the check.
    """
    present = files.select(F.col(file_key).alias("_key")).distinct().withColumn("_file", F.lit(1))
    counted = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_records"))
    proper = F.coalesce(F.col("_key"), F.lit(0)) != 0
    return (
        counted.join(present, "_key", "left")
        .agg(
            F.coalesce(F.sum("_records"), F.lit(0)).alias("records"),
            F.count_if(proper & F.col("_file").isNotNull()).alias("files"),
        )
        .withColumn("ok", F.col("records") == F.col("files"))
    )


def row_counts(df: DataFrame, kept: Column) -> DataFrame:
    """One row: all records and those that meet ``kept``."""
    return df.agg(F.count("*").alias("total"), F.count_if(kept).alias("filtered"))
