"""Scalar functions and filters on texts made from the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn

from ..operators import filters
from .registry import LONG_DATE, LONG_DATE_SQL, landed_pages, query, table


def _pick(key: str, *choices: Column) -> Column:
    """One of the choices by remainder of the key, so that every form occurs."""
    picked = F.when(F.col(key) % len(choices) == 0, choices[0])
    for i, choice in enumerate(choices[1:], 1):
        picked = picked.when(F.col(key) % len(choices) == i, choice)
    return picked


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_orderdate")


def _printed(pattern: str) -> Column:
    return F.date_format("o_orderdate", pattern)


@query(
    "parse_flexible_date",
    """
    SELECT o_orderkey, CAST(CASE
             WHEN o_orderkey % 16 IN (4, 5) THEN date_trunc('month', o_orderdate)
             WHEN o_orderkey % 16 IN (7, 8) AND day(o_orderdate) <= 12
               THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
             WHEN o_orderkey % 16 IN (9, 14) THEN date_trunc('year', o_orderdate)
             WHEN o_orderkey % 16 IN (11, 12, 13) THEN NULL
             ELSE o_orderdate END AS DATE)::VARCHAR AS parsed
    FROM orders
    """,
)
def _(spark, folder):
    text = _pick(
        "o_orderkey",
        _printed("yyyy-MM-dd"),
        _printed("yyyy/M/d"),
        _printed("MM/dd/yyyy"),
        _printed("M-d-yyyy"),
        _printed("yyyy-MM"),
        _printed("yyyy/M"),
        _printed("yyyyMMdd"),
        _printed("dd-MM-yyyy"),
        _printed("d/M/yyyy"),
        _printed("yyyy"),
        _printed("yyyy-M-d"),
        F.concat(_printed("yyyy"), F.lit("-13")),
        F.concat(F.lit(" "), _printed("yyyy-MM-dd")),
        F.lit(""),
        F.concat(_printed("yyyy"), F.lit("11")),
        _printed("MM-dd-yyyy"),
    )
    parsed = fn.parse_flexible_date(text)
    return _orders(spark, folder).select("o_orderkey", parsed.cast("string").alias("parsed"))


@query(
    "date_from_url",
    """
    SELECT o_orderkey, CAST(CASE o_orderkey % 10
             WHEN 5 THEN date_trunc('year', o_orderdate)
             WHEN 6 THEN date_trunc('year', o_orderdate)
             WHEN 7 THEN NULL WHEN 8 THEN NULL
             ELSE date_trunc('month', o_orderdate) END AS DATE)::VARCHAR AS found
    FROM orders
    """,
)
def _(spark, folder):
    month = F.lower(F.date_format("o_orderdate", "MMMM"))
    path = _pick(
        "o_orderkey",
        F.concat(F.lit("/"), _printed("yyyy/M"), F.lit("/")),
        F.concat(F.lit("/x/"), _printed("yyyy-MM")),
        F.concat(F.lit("/"), month, F.lit("-"), _printed("yyyy"), F.lit("/")),
        F.concat(F.lit("/"), _printed("MMM"), F.lit("-"), _printed("yyyy")),
        F.concat(F.lit("/"), _printed("yyyyMM"), F.lit("/")),
        F.concat(F.lit("/"), _printed("yyyy"), F.lit("/13/")),
        F.concat(F.lit("/"), _printed("yyyy"), F.lit("/news")),
        F.concat(F.lit("/word-"), _printed("yyyy")),
        F.lit("/siteindex/"),
        F.concat(F.lit("/"), _printed("yyyyMM"), F.lit("77")),
    )
    url = F.concat(F.lit("https://news.example.org"), path)
    return _orders(spark, folder).select(
        "o_orderkey", fn.date_from_url(url).cast("string").alias("found")
    )


@query(
    "month_number",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL
             WHEN o_orderkey % 5 = 3 THEN 9 ELSE CAST(month(o_orderdate) AS INTEGER) END AS month
    FROM orders
    """,
)
def _(spark, folder):
    name = _pick(
        "o_orderkey",
        _printed("MMMM"),
        F.upper(_printed("MMM")),
        F.lower(_printed("MMM")),
        F.lit("Sept"),
        F.concat(_printed("MMM"), F.lit("x")),
    )
    return _orders(spark, folder).select("o_orderkey", fn.month_number(name).alias("month"))


@query(
    "year_from_text",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (1, 3) THEN NULL
             WHEN o_orderkey % 4 = 2 THEN 1999
             ELSE CAST(year(o_orderdate) AS INTEGER) END AS year
    FROM orders
    """,
)
def _(spark, folder):
    text = _pick(
        "o_orderkey",
        _printed(LONG_DATE),
        F.concat(_printed("yyyy"), F.lit("0 no year")),
        F.concat(F.lit("in 1999 or "), _printed("yyyy")),
        F.lit(""),
    )
    return _orders(spark, folder).select("o_orderkey", fn.year_from_text(text).alias("year"))


_LAST = "list_last(string_split(url, '/'))"


@query(
    "id_from_url",
    f"""
    SELECT page_id, CASE WHEN regexp_matches({_LAST}, '^[0-9]+$')
             THEN CAST({_LAST} AS BIGINT) END AS id FROM pages
    """,
)
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", fn.id_from_url("url").alias("id"))


@query(
    "page_slug",
    "SELECT page_id, COALESCE(NULLIF(string_split(url, '/')[-2], ''), 'index') AS slug FROM pages",
)
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", fn.page_slug("url").alias("slug"))


@query(
    "page_file_name",
    """SELECT page_id, 'programs/' || page_id || '.html.gz' AS program_file,
              'broadcasts/' || page_id || '.html.gz' AS broadcast_file FROM pages""",
)
def _(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id",
        fn.page_file_name("program", "page_id").alias("program_file"),
        fn.page_file_name("broadcast", "page_id").alias("broadcast_file"),
    )


def _info_line() -> Column:
    date = _printed(LONG_DATE)
    title = F.concat(F.lit(" NEWS "), F.col("o_orderkey"))
    return _pick(
        "o_orderkey",
        F.concat(title, F.lit(" for "), date, F.lit("\n")),
        F.concat(title, F.lit(" for Two for "), date),
        F.concat(title, F.lit(" of "), date),
        F.lit(None).cast("string"),
    )


@query(
    "split_title_date_special",
    f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN 'NEWS ' || o_orderkey ELSE '' END AS title,
           CASE WHEN o_orderkey % 4 < 2 THEN {LONG_DATE_SQL} ELSE '' END AS date
    FROM orders
    """,
)
def _(spark, folder):
    title, date = fn.split_title_date(_info_line(), "special")
    return _orders(spark, folder).select("o_orderkey", title.alias("title"), date.alias("date"))


@query(
    "split_title_date_evening",
    f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN {LONG_DATE_SQL} END AS date FROM orders
    """,
)
def _(spark, folder):
    return _orders(spark, folder).select(
        "o_orderkey", fn.split_title_date(_info_line(), "evening")[1].alias("date")
    )


@query(
    "headline_title",
    f"""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 2 THEN 'NEWS ' || o_orderkey || ' of ' ||
             {LONG_DATE_SQL} WHEN 3 THEN '' ELSE 'NEWS ' || o_orderkey END AS title
    FROM orders
    """,
)
def _(spark, folder):
    return _orders(spark, folder).select(
        "o_orderkey", fn.headline_title(_info_line()).alias("title")
    )


@query(
    "program_duration",
    """
    SELECT p_partkey, CASE p_partkey % 4 WHEN 2 THEN p_size || ' min' WHEN 3 THEN ''
             ELSE p_size || ' minutes' END AS duration
    FROM part
    """,
)
def _(spark, folder):
    size = F.col("p_size")
    text = _pick(
        "p_partkey",
        F.concat(F.lit("This program is "), size, F.lit(" minutes long. It is long.")),
        F.concat(F.lit("\nThis program is\xa0"), size, F.lit(" minutes\xa0long")),
        F.concat(F.lit(" "), size, F.lit(" min\t")),
        F.lit(None).cast("string"),
    )
    return table(spark, folder, "part").select(
        "p_partkey", fn.program_duration(text).alias("duration")
    )


@query(
    "time_range",
    """
    SELECT event_id, strftime(ts, '%I:%M:%S %p') || '-' || strftime(ts + INTERVAL 90 SECOND,
             '%I:%M:%S %p') AS time
    FROM events
    """,
)
def _(spark, folder):
    clock = "hh:mm:ss a"
    later = F.col("ts") + F.expr("INTERVAL 90 SECONDS")
    text = F.concat(
        F.lit("\n "), F.date_format("ts", clock), F.lit(" — "), F.date_format(later, clock),
        F.lit("\t"),
    )
    return table(spark, folder, "events").select("event_id", fn.time_range(text).alias("time"))


_WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}]"


@query(
    "py_strip",
    rf"""
    SELECT doc_id, regexp_replace(regexp_replace(text, '^{_WS}+', ''), '{_WS}+$', '') AS text
    FROM documents
    """,
)
def _(spark, folder):
    padded = F.concat(F.lit("\x1c\xa0\n "), F.col("text"), F.lit("\r\n\t \x1f"))
    return table(spark, folder, "documents").select("doc_id", fn.py_strip(padded).alias("text"))


@query(
    "or_default",
    """
    SELECT d.doc_id, COALESCE(l.quality, -1) AS quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def _(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id", "left").select(
        "doc_id", fn.or_default("quality", -1).alias("quality")
    )


def _entry(position: int, is_label: bool, *texts: Column, list_id: int = 1, in_list: bool = True):
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(list_id).alias("list_id"),
        F.lit(in_list).alias("in_list"),
        F.lit(is_label).alias("is_label"),
        F.array(*texts).alias("texts"),
    )


def _entries() -> Column:
    """Definition list of a line: duration, then reporters named after its columns."""
    duration = F.concat(F.lit("00:00:"), F.col("l_linenumber"))
    names = [F.concat(F.lit(n), F.col(c)) for n, c in (("S", "l_suppkey"), (";P", "l_partkey"))]
    full = F.array(
        _entry(0, True, F.lit("Duration:")),
        _entry(1, False, duration),
        _entry(2, True, F.lit("Reporters:")),
        _entry(3, False, duration),
        _entry(4, False, names[0], names[1]),
        _entry(5, False, F.lit("!")),
    )
    apart = F.array(
        _entry(0, True, F.lit("Reporters:")),
        _entry(1, False, names[0]),
        _entry(2, True, F.lit("Duration:"), list_id=2, in_list=False),
        _entry(3, False, duration, list_id=2, in_list=False),
    )
    near = F.array(
        _entry(0, False, names[1]),
        _entry(1, True, F.lit("Duration: ")),
        _entry(2, False, duration),
    )
    return _pick("l_partkey", full, apart, near)


_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "meta_first",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_partkey % 3 = 0 THEN '00:00:' || l_linenumber ELSE '' END AS in_list,
           CASE WHEN l_partkey % 3 < 2 THEN '00:00:' || l_linenumber ELSE '' END AS in_any_list
    FROM lineitem
    """,
)
def _(spark, folder):
    return table(spark, folder, "lineitem").select(
        *_LINE_KEYS,
        fn.meta_first(_entries(), "Duration:").alias("in_list"),
        fn.meta_first(_entries(), "Duration:", any_list=True).alias("in_any_list"),
    )


@query(
    "reporters",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE l_partkey % 3 WHEN 0 THEN 'S' || l_suppkey || ';P' || l_partkey || '!'
             WHEN 1 THEN 'S' || l_suppkey ELSE '' END AS reporters
    FROM lineitem
    """,
)
def _(spark, folder):
    duration = F.concat(F.lit("00:00:"), F.col("l_linenumber"))
    return table(spark, folder, "lineitem").select(
        *_LINE_KEYS, fn.reporters(_entries(), "Reporters:", duration).alias("reporters")
    )


# Filters and parameters


@query(
    "temporal_filter",
    """
    SELECT o_orderkey FROM orders
    WHERE o_orderkey % 7 = 0
       OR date_trunc('month', o_orderdate) BETWEEN DATE '1996-03-15' AND DATE '1999-05-08'
    """,
)
def _(spark, folder):
    url = F.when(F.col("o_orderkey") % 7 > 0, F.concat(F.lit("/x/"), _printed("yyyy-MM")))
    links = _orders(spark, folder).withColumn("url", url)
    start, end = filters.resolve_bounds("1996-03-15", "1999-05-08")
    return filters.temporal_filter(links, start, end).select("o_orderkey")


@query(
    "resolve_bounds",
    """
    SELECT event_id, CAST(ts AS VARCHAR)[:10] AS day FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-23'
    """,
)
def _(spark, folder):
    start, end = filters.resolve_bounds("01/10/2024", "soon", 7, today=dt.date(2024, 1, 30))
    day = F.col("ts").cast("date")
    rows = table(spark, folder, "events").filter(day.between(start, end))
    return rows.select("event_id", day.cast("string").alias("day"))


@query(
    "month_filter",
    f"""
    SELECT o_orderkey FROM orders
    WHERE CASE WHEN o_orderkey % 9 = 0 THEN 'all'
          ELSE strftime(o_orderdate, '%Y-%m') END SIMILAR TO '(1998-1.*|all.*)'
    """,
)
def _(spark, folder):
    href = F.when(F.col("o_orderkey") % 9 == 0, F.lit("none")).otherwise(
        F.concat(F.lit("/months/"), _printed("yyyy-MM"))
    )
    links = _orders(spark, folder).withColumn("href", href)
    return filters.month_filter(links, "1998-1|all").select("o_orderkey")


@query(
    "year_range",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    WHERE o_orderkey % 11 > 0 AND year(o_orderdate) BETWEEN 1996 AND 1999
    """,
)
def _(spark, folder):
    date = F.when(F.col("o_orderkey") % 11 > 0, _printed(LONG_DATE)).otherwise("undated")
    dated = _orders(spark, folder).withColumn("date", date)
    return filters.year_range(dated, 1996, 1999).select("o_orderkey", "year")


_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


@query(
    "limit_items",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    ORDER BY {", ".join(_ORDER)} LIMIT 500
    """,
)
def _(spark, folder):
    lines = table(spark, folder, "lineitem").select(*_ORDER)
    return filters.limit_items(lines, 500, _ORDER).select(*_LINE_KEYS)


@query(
    "require_id",
    f"SELECT page_id FROM pages WHERE regexp_matches({_LAST}, '^[0-9]+$')",
)
def _(spark, folder):
    pages = table(spark, folder, "pages").withColumn("id", fn.id_from_url("url"))
    return filters.require_id(pages, "id").select("page_id")


@query(
    "require_key",
    f"""
    SELECT page_id FROM pages
    WHERE page_id <> 0 AND NOT regexp_matches({_LAST}, '#')
    """,
)
def _(spark, folder):
    key = F.when(~F.col("url").contains("#"), F.col("page_id"))
    pages = table(spark, folder, "pages").withColumn("key", key)
    return filters.require_key(pages, "key").select("page_id")


@query(
    "ok_pages",
    """
    SELECT page_id FROM pages
    WHERE CASE WHEN page_id % 2 = 0 THEN page_id % 5 = 0 ELSE page_id % 5 < 3 END
    """,
)
def _(spark, folder):
    status = _pick("page_id", *[F.lit(s) for s in (200, 204, 299, 301, 404)])
    kind = F.when(F.col("page_id") % 2 == 0, "index").otherwise("broadcast")
    pages = landed_pages(spark, folder).withColumns({"status": status, "page_kind": kind})
    return filters.ok_pages(pages).select("page_id")


