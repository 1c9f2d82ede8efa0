"""From landed pages to segment rows.

The walk site index -> month -> segment page -> program -> segment page is a chain of
joins. Date and month filters are applied to links, before the pages behind them are
read. HTML is parsed where it is scanned and never shuffled: only the parsed, much
narrower rows meet the links.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    concat_text,
    headline_title,
    id_from_url,
    meta_first,
    or_default,
    program_duration,
    py_strip,
    reporters,
    split_title_date,
    url_key,
)
from ..operators.dedup import latest
from ..operators.filters import (
    limit_items,
    month_filter,
    ok_pages,
    require_id,
    resolve_bounds,
    temporal_filter,
)
from ..operators.joins import all_segments, segments_with_pages
from ..operators.links import (
    distinct_requests,
    hop,
    host_filter,
    month_links,
    program_link,
    program_listing,
    segment_links,
)
from ..operators.parse import ARCHIVE_PROFILES, Profile, parse_kinds, parse_pages
from ..schema import REPORTERS, SEGMENTS
from ..session import BROADCAST_BYTES, materialize, row_bytes

# Labels of the definition list on segment pages.
DURATION_LABEL = "Duration:"
SPECIAL_REPORTERS_LABEL = "Reporters:"
EVENING_REPORTERS_LABEL = "Reporter(s):"

# Of many links without an index, the most that are worth a shuffle of the pages.
PAGES_PER_LINK = 2

# Stored pages of these kinds have the id of their URL as ``page_id``, or none.
KINDS_WITH_ID = ("broadcast", "program")

SEGMENTS_COLUMNS = [f"`{name}`" for name in SEGMENTS.names]
_PAGE_TEXTS = ("broadcast_title", "broadcast_duration", "broadcast_abstract", REPORTERS)


def parse_kind(
    pages: DataFrame, kind: str, profiles: dict[str, Profile] = ARCHIVE_PROFILES
) -> DataFrame:
    """Answered pages of one kind, parsed, with their URL key."""
    answered = ok_pages(pages.filter(F.col("page_kind") == kind))
    return parse_pages(answered, profiles[kind], ["url", "fetched_at"]).withColumn(
        "url_key", url_key("url")
    )


def last_visits(parsed: DataFrame) -> DataFrame:
    """The last visit of each URL; visits of one time go by URL, then by a hash of the row."""
    same_time = F.xxhash64(*parsed.columns)
    return latest(
        parsed, ["url_key"], [F.col("fetched_at").desc_nulls_last(), F.col("url"), same_time]
    )


def parse_every_kind(pages: DataFrame, profiles: dict[str, Profile] = ARCHIVE_PROFILES) -> DataFrame:
    """``parse_kind`` for all kinds in one pass over the pages, told apart by ``page_kind``."""
    parsed = parse_kinds(ok_pages(pages), profiles, ["url", "fetched_at"])
    return parsed.withColumn("url_key", url_key("url"))


def last_visits_by_kind(parsed: DataFrame, profiles: dict[str, Profile] = ARCHIVE_PROFILES) -> DataFrame:
    """``last_visits`` of each kind, settled by the same columns as there."""
    hashes = [
        F.when(F.col("page_kind") == kind, F.xxhash64("url", "fetched_at", *[c.name for c in profile.columns], "url_key"))
        for kind, profile in profiles.items()
    ]
    order = [F.col("fetched_at").desc_nulls_last(), F.col("url"), F.coalesce(*hashes)]
    return latest(parsed, ["page_kind", "url_key"], order)


def _page_fields(parsed: DataFrame, kind: str, *keep: str) -> DataFrame:
    """Segment columns that come from the segment page itself, and those to ``keep``."""
    label = SPECIAL_REPORTERS_LABEL if kind == "special" else EVENING_REPORTERS_LABEL
    duration = meta_first("meta", DURATION_LABEL, any_list=kind == "evening")
    return parsed.withColumn("broadcast_duration", duration).select(
        *keep,
        "broadcast_duration",
        split_title_date("info", kind)[1].alias("date"),
        py_strip(or_default("title", "")).alias("broadcast_title"),
        concat_text("description").alias("broadcast_abstract"),
        reporters("meta", label, "broadcast_duration").alias(REPORTERS),
    )


def request_id(url: str):
    """Id in a link's URL as it is requested, that is without its fragment."""
    link = F.col(url)
    return id_from_url(F.when(link.contains("#"), F.regexp_replace(link, r"(?s)#.*", "")).otherwise(link))


def special_segments(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per parsed special page, which is its whole source; ``keep`` is carried."""
    described = {
        "program_title": split_title_date("info", "special")[0],
        "program_duration": F.lit(""),
        "broadcast_time": F.lit(""),
        "broadcast_order": request_id("url"),
    }
    rows = _page_fields(parsed.withColumns(described), "special", *described, *keep)
    return require_id(rows.select(*SEGMENTS_COLUMNS, *keep), "broadcast_order")


def programs(parsed: DataFrame) -> DataFrame:
    """Listing rows of parsed program pages with title and duration of the program."""
    attributed = require_id(parsed.withColumn("program_id", request_id("url")), "program_id")
    attributed = attributed.withColumns(
        {
            "program_title": headline_title("headline"),
            "program_duration": program_duration("duration_text"),
        }
    )
    return program_listing(attributed, "program_id", "program_title", "program_duration")


def evening_segments(listing: DataFrame, parsed: DataFrame, missing: str = "empty") -> DataFrame:
    """One row per listing entry, joined to its parsed segment page by ``url_key``.

    ``listing`` is read twice, once to find entries that share a page very often, and
    should be a stored table; ``parsed`` has one row per page.
    """
    entries = require_id(
        listing.withColumn("broadcast_order", request_id("url")), "broadcast_order"
    ).select(
        url_key("url").alias("url_key"),
        "program_title",
        "program_duration",
        "broadcast_time",
        "broadcast_order",
    )
    fields = _page_fields(parsed, "evening", "url_key")
    joined = segments_with_pages(entries, fields, "url_key", missing, _PAGE_TEXTS)
    return joined.select(*SEGMENTS_COLUMNS)


def parse_behind(
    pages: DataFrame, links: DataFrame, kind: str, limit: int, index: DataFrame | None = None
) -> tuple[DataFrame, bool]:
    """Last visits of the pages of ``kind``; only those behind ``links`` if these are few.

    ``links`` have distinct values of ``url_key``. Few keys are broadcast to the scan, so pages outside are not even parsed. Too many
    to broadcast: with the ``index`` of a bucketed archive (``pages`` then has ``bucket``),
    links joined to it name the buckets to read, only pages there are parsed, and the
    parsed rows are joined to the links; without one, links to at most one in
    ``PAGES_PER_LINK`` stored pages are joined to the pages before these are parsed, as a
    page is shuffled for a fraction of what its parsing takes, and otherwise all pages of
    the kind are parsed where they are scanned, which the second value tells. If all links name an id, the
    least and the greatest one bound the scan, so that row groups of an archive sorted by
    id are skipped; ids are given out in order of time, so those of a month stand close
    together.
    """
    keys = links.select("url_key")
    page_id = request_id("url_key")
    found = keys.agg(
        F.sum(row_bytes(keys)).alias("bytes"),
        F.min(page_id).alias("least"),
        F.max(page_id).alias("greatest"),
        F.count_if(page_id.isNull()).alias("without"),
        F.count("*").alias("links"),
    ).first()
    every = pages.filter(F.col("page_kind") == kind)
    many = (found["bytes"] or 0) > limit
    if index is None and many and found["links"] * PAGES_PER_LINK > every.count():
        return last_visits(parse_kind(every, kind)), True
    of_kind = every
    if kind in KINDS_WITH_ID and found["least"] is not None and not found["without"]:
        between = F.col("page_id").between(found["least"], found["greatest"])
        of_kind = of_kind.filter(between | F.col("page_id").isNull())
    if index is None or not many:
        keys = keys.hint("merge") if many else F.broadcast(keys)
        of_kind = of_kind.join(keys, url_key("url") == F.col("url_key"), "left_semi")
        return last_visits(parse_kind(of_kind.drop("bucket"), kind)), False
    # At most kinds x buckets values, a number fixed by the archive.
    wanted = keys.join(index.filter(F.col("page_kind") == kind), "url_key").select("bucket").distinct()
    buckets = sorted(r.bucket for r in wanted.collect())
    of_kind = of_kind.filter(F.col("bucket").isin(buckets))
    parsed = last_visits(parse_kind(of_kind.drop("bucket"), kind))
    return parsed.join(keys, "url_key", "left_semi"), False


# Last visits of the parsed pages of a kind, at least of those behind the links if there are
# any; the second value tells that these are all pages of the kind.
Visits = Callable[[str, DataFrame | None], tuple[DataFrame, bool]]


def segments_from(
    visits: Visits,
    start: str | None = None,
    end: str | None = None,
    buffer_days: int = 0,
    month_regex: str | None = None,
    max_items: int = 0,
    hosts: list[str] | None = None,
    missing: str = "empty",
    today: dt.date | None = None,
) -> DataFrame:
    """Segment rows of everything reachable from the site index pages that ``visits`` gives.

    Frontiers and parsed segment pages have several readers and are written once as
    scratch tables. Segment pages are visited twice, first for their program link and
    then, per listing entry, for their content; they are parsed once.
    """
    lower, upper = resolve_bounds(start, end, buffer_days, today)

    def allowed(links: DataFrame) -> DataFrame:
        return host_filter(links, hosts) if hosts else links

    months = temporal_filter(month_links(visits("index", None)[0]), lower, upper)
    months = materialize(
        distinct_requests(allowed(month_filter(months, month_regex))), "months"
    )

    month_pages, _ = visits("month", months)
    target = months.select("url_key", F.col("url").alias("link_url"))
    month_pages = hop(target, month_pages.drop("url"), distinct=True).withColumnRenamed("link_url", "url")
    frontier = materialize(distinct_requests(allowed(segment_links(month_pages))), "frontier")

    first, complete = visits("broadcast", frontier)
    first = materialize(first.drop("url"), "segment-pages")
    visited = hop(frontier.select("url_key", "url", "list"), first, distinct=True)
    special = special_segments(visited.filter(F.col("list") == "special"))

    program_links = allowed(program_link(visited.filter(F.col("list") == "evening")))
    program_links = materialize(distinct_requests(program_links), "program-links")
    program_pages, _ = visits("program", program_links)
    program_target = program_links.select("url_key", "url")
    reached = hop(program_target, program_pages.drop("url"), distinct=True)
    listing = materialize(programs(reached), "listing")

    segment_pages = first
    if not complete:
        known = first.select("url_key")
        listed = listing.select(url_key("url").alias("url_key")).distinct()
        second, everything = visits("broadcast", listed.join(known, "url_key", "left_anti"))
        second = second.drop("url")
        if everything:
            second = second.join(known, "url_key", "left_anti")
        segment_pages = first.unionByName(second)
    evening = evening_segments(listing, segment_pages, missing)
    return limit_items(all_segments(evening, special), max_items)


def build_segments(
    pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, index: DataFrame | None = None, **options
) -> DataFrame:
    """Segment rows of everything reachable from the landed site index pages.

    ``page_id`` of a segment or program page must be the id in its ``url``, or null.
    With the ``index`` of a bucketed archive, many links read only their buckets.
    ``options`` are those of ``segments_from``: bounds, month filter, hosts and limit.
    """
    plain = pages.drop("bucket")

    def visits(kind: str, links: DataFrame | None) -> tuple[DataFrame, bool]:
        if links is None:
            return last_visits(parse_kind(plain, kind)), True
        return parse_behind(pages if index is not None else plain, links, kind, broadcast_bytes, index)

    return segments_from(visits, **options)
