"""Joins, deduplication and set operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as jn
from ..operators.audit import (
    duplicate_segments,
    id_gap_ranges,
    id_gaps,
    malformed_meta,
    missing_durations,
)
from ..operators.dedup import latest
from ..plans.incremental import upsert_segments
from ..session import scratch_path
from ..sources.snapshots import merge_snapshot, read_snapshot
from .registry import query, table


@query(
    "segments_with_pages",
    """
    SELECT o_orderkey, o_custkey, CAST(COALESCE(n, 0) AS BIGINT) AS n, COALESCE(flags, '') AS flags
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, min(l_returnflag) AS flags
                           FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    """,
)
def _(spark, folder):
    listing = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    pages = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("n"), F.min("l_returnflag").alias("flags"))
    )
    joined = jn.segments_with_pages(listing, pages, "o_orderkey", "empty", ("flags",))
    return joined.fillna(0, ["n"])


@query(
    "segments_with_pages_dropped",
    """
    SELECT o_orderkey, o_custkey, count(*) AS n
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2
    """,
)
def _(spark, folder):
    listing = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    pages = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("n"))
    )
    return jn.segments_with_pages(listing, pages, "o_orderkey", "drop")


@query(
    "carry_program",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderpriority AS program_title
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def _(spark, folder):
    programs = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("program_title")
    )
    listing = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return jn.carry_program(programs, listing, "l_orderkey")


def _records(spark, folder):
    records = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    files = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"))
    return records, files


@query(
    "records_with_file",
    """SELECT doc_id, lang FROM documents
       WHERE doc_id <> 0 AND doc_id IN (SELECT doc_id FROM labels)""",
)
def _(spark, folder):
    return jn.records_with_file(*_records(spark, folder), "doc_id", "page_id").drop("n_chars")


@query(
    "records_without_file",
    """SELECT doc_id, lang FROM documents
       WHERE doc_id <> 0 AND doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def _(spark, folder):
    return jn.records_without_file(*_records(spark, folder), "doc_id", "page_id").drop("n_chars")


@query(
    "broken_links",
    """
    SELECT url AS src_url, replace(url, 'http://', 'https://') AS url_key FROM pages
    WHERE replace(url, 'http://', 'https://') NOT IN (SELECT url FROM pages)
    """,
)
def _(spark, folder):
    pages = table(spark, folder, "pages").select(F.col("url").alias("url_key"))
    secure = F.replace(F.col("url_key"), F.lit("http://"), F.lit("https://"))
    links = pages.select(F.col("url_key").alias("src_url"), secure.alias("url_key"))
    return jn.broken_links(links, pages)


@query(
    "keep_reachable",
    """
    SELECT page_id, length(html) AS n FROM pages
    WHERE page_id IN (SELECT doc_id FROM labels)
    """,
)
def _(spark, folder):
    wanted = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"))
    kept = jn.keep_reachable(table(spark, folder, "pages"), wanted, "page_id")
    return kept.select("page_id", F.length("html").cast("bigint").alias("n"))


@query(
    "latest_page",
    """
    SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r
      FROM events) WHERE r = 1
    """,
)
def _(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")
    return latest(events, ["user_id"], [F.col("ts").desc(), "event_id"]).drop("ts")


@query(
    "all_segments",
    """
    SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN html END AS date FROM pages
    """,
)
def _(spark, folder):
    pages = table(spark, folder, "pages").select(
        "page_id", "url", F.col("html").alias("date")
    )
    evening = pages.filter("page_id % 2 = 1").drop("date")
    return jn.all_segments(evening, pages.filter("page_id % 2 = 0"))


def _upsert_inputs(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year")
    )
    keyless = orders.filter("o_orderkey % 7 = 0").withColumn(
        "o_orderkey", F.lit(None).cast("bigint")
    )
    base = orders.withColumn("state", F.lit("old"))
    delta = orders.filter("o_orderkey % 3 = 0").withColumn("state", F.lit("new"))
    stale = delta.withColumn("state", F.lit("stale"))
    base = base.unionByName(keyless.withColumn("state", F.lit("base")))
    changes = delta.unionByName(stale).unionByName(keyless.withColumn("state", F.lit("delta")))
    return base, changes


_UPSERT_SQL = """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
           CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE 'old' END AS state
    FROM orders
    UNION ALL
    SELECT NULL, CAST(year(o_orderdate) AS INTEGER), state
    FROM orders, (VALUES ('base'), ('delta')) AS s(state) WHERE o_orderkey % 7 = 0
    """


@query("upsert_segments", _UPSERT_SQL)
def _(spark, folder):
    base, changes = _upsert_inputs(spark, folder)
    return upsert_segments(base, changes, "o_orderkey", [F.col("state")])


@query("merge_snapshot", _UPSERT_SQL)
def _(spark, folder):
    """The same merge on a stored table: only buckets with changed keys are written again."""
    base, changes = _upsert_inputs(spark, folder)
    path = scratch_path(spark, "snapshot")
    merge_snapshot(base, path, "o_orderkey", [F.col("state")])
    merge_snapshot(changes, path, "o_orderkey", [F.col("state")])
    return read_snapshot(spark, path, base.schema)


@query(
    "missing_durations",
    """
    SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.doc_id IS NULL
    """,
)
def _(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id")
    labels = table(spark, folder, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("broadcast_duration")
    )
    return missing_durations(documents.join(labels, "doc_id", "left")).select("doc_id")


_GAPS_SQL = """
    SELECT doc_id + 1 AS gap_start, next - 1 AS gap_end, next - doc_id - 1 AS n_missing
    FROM (SELECT doc_id, lead(doc_id) OVER (ORDER BY doc_id) AS next
          FROM (SELECT DISTINCT doc_id FROM labels)) WHERE next > doc_id + 1"""


@query("id_gap_ranges", _GAPS_SQL)
def _(spark, folder):
    return id_gap_ranges(table(spark, folder, "labels"), "doc_id")


@query(
    "id_gaps",
    f"SELECT unnest(generate_series(gap_start, gap_end)) AS doc_id FROM ({_GAPS_SQL})",
)
def _(spark, folder):
    return id_gaps(table(spark, folder, "labels"), "doc_id")


def _tag_counts(tag: str) -> str:
    return (
        rf"CAST(len(regexp_extract_all(html, '<{tag}[\s>/]')) AS INTEGER) AS {tag}_open, "
        rf"CAST(len(regexp_extract_all(html, '</{tag}\s*>')) AS INTEGER) AS {tag}_close"
    )


@query(
    "malformed_meta",
    f"""
    SELECT * FROM (SELECT page_id, {_tag_counts("b")}, {_tag_counts("p")} FROM pages)
    WHERE b_open <> b_close OR p_open <> p_close
    """,
)
def _(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "html")
    return malformed_meta(pages, ("b", "p"))


@query(
    "duplicate_segments",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def _(spark, folder):
    lines = table(spark, folder, "lineitem")
    return duplicate_segments(lines, "l_orderkey", "l_linenumber")
