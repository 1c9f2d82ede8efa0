"""Filters, limits and their parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import date_from_url, parse_flexible_date, year_from_text
from ..session import materialize


def resolve_bounds(
    start: str | None = None,
    end: str | None = None,
    buffer_days: int = 0,
    today: dt.date | None = None,
) -> tuple[Column, Column]:
    """Start (null = no bound) and end date of a run as constant columns.

    A missing or unreadable end is today; a missing or unreadable start is no bound;
    ``today`` is a word for the start only. A buffer moves the end back.
    """
    now = F.lit(today) if today else F.current_date()
    nothing = F.lit(None).cast("date")
    upper = F.coalesce(parse_flexible_date(F.lit(end)), now) if end else now
    if not start:
        lower = nothing
    elif start.lower() == "today":
        lower = now
    else:
        lower = parse_flexible_date(F.lit(start))
    if int(buffer_days) > 0:
        upper = F.date_sub(upper, int(buffer_days))
    return lower, upper


def temporal_filter(
    links: DataFrame, start: Column | None, end: Column, url: str = "url"
) -> DataFrame:
    """Keep links whose URL is undated or dated within the bounds.

    A URL is dated by month, as its first day: a start in mid-month drops that month.
    """
    found = date_from_url(url)
    inside = found <= end
    if start is not None:
        inside = inside & (start.isNull() | (found >= start))
    return links.filter(F.coalesce(inside, F.lit(True)))


def month_filter(links: DataFrame, regex: str | None, href: str = "href") -> DataFrame:
    """Keep links whose last href part starts with a match of ``regex``."""
    if not regex:
        return links
    last = F.try_element_at(F.split(href, "/"), F.lit(-1))
    month = F.when(F.col(href).contains("/"), last).otherwise(F.lit("all"))
    return links.filter(month.rlike(rf"\A(?:{regex})"))


def year_range(df: DataFrame, lo: int, hi: int, text: str = "date") -> DataFrame:
    """Add the ``year`` named in ``text`` and keep the years ``lo`` to ``hi``."""
    return df.withColumn("year", year_from_text(text)).filter(F.col("year").between(lo, hi))


# Up to this many rows, the first n are taken as a top k per task and merged; above,
# by selection over a range-partitioned sort.
TOP_K_ROWS = 10_000
ROWS_PER_RANGE = 1_000_000


def limit_items(
    df: DataFrame, n: int, order_by: tuple[str, ...] = ("broadcast_order",), top_k_rows: int = TOP_K_ROWS
) -> DataFrame:
    """The first ``n`` rows in a fixed order; 0 is no limit.

    Ties are broken by the other columns, so that a run can be repeated; rows equal in
    all columns are interchangeable. Up to ``top_k_rows`` each task keeps its first ``n``
    and one task merges them. Above, no task sees more than one range: rows are sorted
    into ranges (bounds from a sample), the ranges are counted, every range before the
    one holding the n-th row is kept whole, and only that range is ranked. The rows come
    in no particular order then.
    """
    if n <= 0:
        return df
    others = [F.col(f"`{c}`") for c in df.columns if c not in order_by]
    order = [F.col(f"`{c}`") for c in order_by] + others
    if n <= top_k_rows:
        return df.orderBy(*order).limit(n)
    parts = max(1, -(-df.count() // ROWS_PER_RANGE))
    ranged = materialize(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = sorted((r["_range"], r["n"]) for r in ranged.groupBy("_range").agg(F.count("*").alias("n")).collect())
    whole, before, edge, need = [], 0, None, 0
    for part, size in counts:
        if before + size <= n:
            whole.append(part)
            before += size
        else:
            edge, need = part, n - before
            break
    kept = ranged.filter(F.col("_range").isin(whole))
    if edge is not None and need > 0:
        ranks = Window.partitionBy("_range").orderBy(*order)
        cut = ranged.filter(F.col("_range") == edge).withColumn("_rank", F.row_number().over(ranks))
        kept = kept.unionByName(cut.filter(F.col("_rank") <= need).drop("_rank"))
    return kept.drop("_range")


def require_id(df: DataFrame, column: str = "page_id") -> DataFrame:
    """Drop rows without a numeric id."""
    return df.filter(F.col(column).isNotNull())


def require_key(df: DataFrame, column: str = "broadcast_order") -> DataFrame:
    """Drop rows whose key is missing or zero."""
    return df.filter(F.coalesce(F.col(column), F.lit(0)) != 0)


def ok_pages(pages: DataFrame) -> DataFrame:
    """Pages that were answered: status 200 for an index, any success for the others."""
    success = F.col("status").between(200, 299)
    return pages.filter(F.when(F.col("page_kind") == "index", F.col("status") == 200).otherwise(success))
