"""Sources and sinks: tables are written to scratch space and read back."""

from __future__ import annotations

import gzip

from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import REPORTERS, SEGMENTS
from ..session import scratch_path
from ..sources import (
    export_subset,
    read_page_archive,
    read_raw_pages,
    read_segments_csv,
    read_segments_jsonl,
    save_raw_pages,
    write_segments_csv,
    write_segments_json,
    write_segments_jsonl,
)
from .registry import LONG_DATE, LONG_DATE_SQL, landed_pages, query, table
from .site import SITE


def order_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in the shape of segments, some without a date or a duration."""
    key = F.col("o_orderkey")
    values = {
        "date": F.when(key % 9 > 0, F.date_format("o_orderdate", LONG_DATE)),
        "program_title": F.col("o_orderpriority"),
        "program_duration": F.lit("28 minutes"),
        "broadcast_title": F.concat(F.lit('Order "'), key, F.lit('", é')),
        "broadcast_duration": F.when(key % 7 > 0, F.lit("00:01:00")).otherwise(""),
        "broadcast_time": F.lit(""),
        "broadcast_order": F.when(key % 21 > 0, key),
        "broadcast_abstract": F.concat(F.lit("a,\n\\ "), F.col("o_custkey"), F.lit("\n")),
        REPORTERS: F.col("o_orderstatus"),
    }
    return table(spark, folder, "orders").select(*[values[c].alias(c) for c in SEGMENTS.names])


ORDER_SEGMENTS_SQL = f"""
  SELECT CASE WHEN o_orderkey % 9 > 0 THEN {LONG_DATE_SQL} END AS date,
         o_orderpriority AS program_title, '28 minutes' AS program_duration,
         'Order "' || o_orderkey || '", é' AS broadcast_title,
         CASE WHEN o_orderkey % 7 > 0 THEN '00:01:00' ELSE '' END AS broadcast_duration,
         '' AS broadcast_time,
         CASE WHEN o_orderkey % 21 > 0 THEN o_orderkey END AS broadcast_order,
         'a,' || chr(10) || chr(92) || ' ' || o_custkey || chr(10) AS broadcast_abstract,
         o_orderstatus AS "broadcast_reporter(s)"
  FROM orders"""


@query("write_segments_jsonl", ORDER_SEGMENTS_SQL)
def _(spark, folder):
    path = scratch_path(spark, "jsonl")
    write_segments_jsonl(order_segments(spark, folder), path)
    return read_segments_jsonl(spark, path)


@query(
    "write_segments_csv",
    f"""SELECT * REPLACE (COALESCE(date, '') AS date) FROM ({ORDER_SEGMENTS_SQL})""",
)
def _(spark, folder):
    path = scratch_path(spark, "csv")
    write_segments_csv(order_segments(spark, folder), path)
    return read_segments_csv(spark, path)


@query("write_segments_json", ORDER_SEGMENTS_SQL)
def _(spark, folder):
    path = scratch_path(spark, "json")
    write_segments_json(order_segments(spark, folder), path)
    return read_segments_jsonl(spark, path)


@query(
    "write_modes",
    f"""{ORDER_SEGMENTS_SQL}
        UNION ALL {ORDER_SEGMENTS_SQL} WHERE o_orderkey % 3 = 0""",
)
def _(spark, folder):
    path = scratch_path(spark, "modes")
    segments = order_segments(spark, folder)
    number = F.regexp_extract("broadcast_title", r"(\d+)", 1).cast("bigint")
    write_segments_json(segments.filter(number % 3 == 0), path)
    write_segments_json(segments, path, "overwrite")
    write_segments_json(segments.filter(number % 3 == 0), path, "append")
    return read_segments_jsonl(spark, path)


def _store_files(pages: DataFrame, path: str) -> None:
    """One compressed file per page, as a crawler leaves them."""

    def store(rows) -> None:
        store, base = FileSystem.from_uri(path)
        store.create_dir(base)
        for row in rows:
            with store.open_output_stream(f"{base}/{row.page_id}.html.gz", compression=None) as out:
                out.write(gzip.compress(row.html.encode()))

    pages.foreachPartition(store)


@query(
    "read_raw_pages",
    f"""
    SELECT 'broadcast' AS page_kind, page_id, '{SITE}/broadcasts/' || page_id AS url,
           md5(html) AS digest
    FROM pages
    """,
)
def _(spark, folder):
    path = scratch_path(spark, "raw")
    _store_files(table(spark, folder, "pages").select("page_id", "html"), path)
    read = read_raw_pages(spark, path, "broadcast", SITE)
    return read.select("page_kind", "page_id", "url", F.md5("html").alias("digest"))


@query(
    "save_raw_pages",
    """
    SELECT page_id, url, md5(html) AS digest,
           CASE WHEN page_id % 2 = 0 THEN 'program' ELSE 'broadcast' END AS page_kind
    FROM pages
    """,
)
def _(spark, folder):
    path = scratch_path(spark, "pages")
    pages = landed_pages(spark, folder).withColumn(
        "page_kind", F.when(F.col("page_id") % 2 == 0, "program").otherwise("broadcast")
    )
    older = pages.withColumns(
        {
            "html": F.lit("<p>old</p>"),
            "fetched_at": F.col("fetched_at") - F.expr("INTERVAL 1 DAY"),
        }
    )
    save_raw_pages(older.unionByName(pages), path)
    return read_page_archive(spark, path).select(
        "page_id", "url", F.md5("html").alias("digest"), "page_kind"
    )


@query(
    "export_subset",
    """
    SELECT 'data' AS part, doc_id AS id, md5(text) AS digest FROM documents WHERE doc_id % 3 > 0
    UNION ALL
    SELECT 'html', page_id, md5(html) FROM pages
    WHERE page_id % 3 > 0 AND page_id IN (SELECT doc_id FROM documents)
    """,
)
def _(spark, folder):
    path = scratch_path(spark, "subset")
    records = (
        table(spark, folder, "documents")
        .filter("doc_id % 3 > 0")
        .select(F.col("doc_id").alias("broadcast_order"), "text")
    )
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    stored = pages.withColumn("page_kind", F.lit("broadcast")).unionByName(
        pages.withColumns({"page_kind": F.lit("program"), "html": F.lit("<p>program</p>")})
    )
    export_subset(records, stored, path)
    data = read_segments_jsonl(spark, f"{path}/data", records.schema)
    html = spark.read.parquet(f"{path}/html")
    return data.select(
        F.lit("data").alias("part"), F.col("broadcast_order").alias("id"), F.md5("text").alias("digest")
    ).unionByName(
        html.select(
            F.lit("html").alias("part"), F.col("page_id").alias("id"), F.md5("html").alias("digest")
        )
    )
