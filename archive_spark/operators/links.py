"""Links: extraction from parsed pages, resolving, and the hop to their pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import host_of, resolve_all, resolve_url, time_range, url_key
from .dedup import latest
from .joins import join_to_one


def exploded_links(parsed: DataFrame, hrefs: str, kind: str, list_name: str | None) -> DataFrame:
    """``links`` rows of one href array; empty hrefs are dropped, positions are kept.

    URLs are resolved before the explode and are plain columns after it. Otherwise each
    filter on the URL would be pushed below and repeat the whole expression.
    """
    return (
        parsed.select(
            F.col("url").alias("src_url"), F.posexplode(resolve_all("url", hrefs)).alias("pos", "link")
        )
        .select(
            "src_url",
            "link.*",
            F.lit(kind).alias("kind"),
            F.lit(list_name).cast("string").alias("list"),
            "pos",
        )
        .filter(F.col("href") != "")
    )


def month_links(parsed_index: DataFrame) -> DataFrame:
    """Links of the site index to month pages."""
    return exploded_links(parsed_index, "hrefs", "month", None)


def tag_and_union(evening: DataFrame, special: DataFrame) -> DataFrame:
    """Both lists in one frontier, told apart by ``list``."""
    return evening.withColumn("list", F.lit("evening")).unionByName(
        special.withColumn("list", F.lit("special"))
    )


def segment_links(parsed_months: DataFrame) -> DataFrame:
    """Links of month pages to segment pages, evening and special.

    Both lists leave the page in one pass, so the pages are read once.
    """
    lists = F.array(
        F.struct(F.lit("evening").alias("list"), F.col("evening_hrefs").alias("hrefs")),
        F.struct(F.lit("special").alias("list"), F.col("special_hrefs").alias("hrefs")),
    )
    return (
        parsed_months.select(F.col("url").alias("src_url"), F.inline(lists))
        .select("src_url", "list", F.posexplode(resolve_all("src_url", "hrefs")).alias("pos", "link"))
        .select("src_url", "link.*", F.lit("broadcast").alias("kind"), "list", "pos")
        .filter(F.col("href") != "")
    )


def program_link(parsed_broadcasts: DataFrame) -> DataFrame:
    """The one link of an evening page to its program; none where there is no href."""
    return parsed_broadcasts.filter(F.coalesce(F.col("program_href"), F.lit("")) != "").select(
        F.col("url").alias("src_url"),
        F.col("program_href").alias("href"),
        resolve_url("url", "program_href").alias("url"),
        F.lit("program").alias("kind"),
        F.lit(None).cast("string").alias("list"),
        F.lit(0).alias("pos"),
    )


def program_listing(parsed_programs: DataFrame, *keep: str) -> DataFrame:
    """Segments listed on a program page: id text, time and link.

    The three lists are paired by place and cut to the shortest.
    """
    length = F.least(F.size("ids"), F.size("timestamps"), F.size("hrefs"))
    zipped = F.arrays_zip(
        F.slice("ids", 1, length).alias("broadcast_id"),
        F.slice("timestamps", 1, length).alias("timestamp"),
        resolve_all("url", F.slice("hrefs", 1, length)).alias("link"),
    )
    return parsed_programs.select(
        F.col("url").alias("src_url"), *keep, F.posexplode(zipped).alias("pos", "entry")
    ).select(
        "src_url",
        *keep,
        "pos",
        "entry.broadcast_id",
        time_range("entry.timestamp").alias("broadcast_time"),
        "entry.link.*",
    )


def host_filter(links: DataFrame, hosts: list[str], url: str = "url") -> DataFrame:
    """Links to one of the hosts or to a host below one."""
    names = "|".join(rf"\Q{name.lower()}\E" for name in hosts)
    return links.filter(host_of(url).rlike(rf"(?:\A|\.)(?:{names})\z"))


def distinct_requests(links: DataFrame) -> DataFrame:
    """Each URL once: the evening list before the special one, then by source and place."""
    return latest(
        links.withColumn("url_key", url_key("url")), ["url_key"], ["list", "src_url", "pos"]
    )


def hop(
    links: DataFrame, pages: DataFrame, how: str = "inner", distinct: bool = False
) -> DataFrame:
    """Follow links to their pages, which must be one per ``url_key``.

    ``distinct`` tells that the links are ``distinct_requests``. Otherwise very many of
    them may share a target, and such targets are salted.
    """
    if distinct:
        return links.join(pages, "url_key", how)
    return join_to_one(links, pages, "url_key", how)
