"""Named queries over a folder of tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def landed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The driver's pages in the shape of landed pages."""
    return table(spark, folder, "pages").select(
        F.lit("broadcast").alias("page_kind"),
        "page_id",
        "url",
        F.lit(200).alias("status"),
        "html",
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("fetched_at"),
    )


# Printed date of an order in both dialects, for example ``Friday, May 29, 1998``.
LONG_DATE = "EEEE, MMM dd, yyyy"
LONG_DATE_SQL = "strftime(o_orderdate, '%A, %b %d, %Y')"
