"""Runs over a date range and merging their rows into a base table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import latest
from ..operators.joins import join_to_one
from .crawl import build_segments


def incremental_segments(
    pages: DataFrame, start: str | None, end: str | None = None, **options
) -> DataFrame:
    """Segments of the months within the range.

    Pages of other months are not parsed; row groups without an id in the range of the
    links' ids are not read, if the archive is sorted by id as ``save_raw_pages`` leaves it.
    """
    return build_segments(pages, start=start, end=end, **options)


def upsert_segments(
    base: DataFrame,
    delta: DataFrame,
    key: str,
    order: list[Column],
) -> DataFrame:
    """Rows of ``base`` with those of the same key replaced by the last ones of ``delta``.

    ``order`` tells which of several delta rows of one key wins (the first). Rows without a
    key replace nothing and are all kept, on both sides.
    """
    kept = join_to_one(base, delta.select(key).distinct(), key, "left_anti")
    keyless = F.col(f"`{key}`").isNull()
    merged = kept.unionByName(latest(delta.filter(~keyless), [key], order))
    merged = merged.unionByName(delta.filter(keyless))
    return merged.select(*[F.col(f"`{c}`") for c in base.columns])
