"""Joins of segments, programs, pages and stored files.

The page, program and file sides have one row per key, so no key can multiply rows. A
key that fills much of the other side is salted by ``join_to_one``. AQE's own skew join
is not enough here: it splits only joins whose two inputs are plain shuffles, and the
one-row-per-key side usually comes out of an aggregate or a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_BYTES, fits_broadcast
from .filters import require_key

HOT_ROWS = 100_000


def join_to_one(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join to a side with one row per key (inner, left, left_semi or left_anti).

    A key of ``left`` is hot with ``hot_rows`` rows or more and at least a quarter of the
    rows that one of the shuffle partitions gets on average, so there are at most four hot
    keys for each partition, which bounds the broadcast. A hot key is cut into as many salts
    as it holds such quarters, rows without a key into a salt of their own for each row
    hash, and only the rows of ``right`` with a hot key are repeated. The salt comes from the row
    and the number of the sending task, so rows that stand together part as well, and a task
    that runs again sends its rows to the same places. ``left`` is read twice more, both
    times for its key alone; store it before, if it is costly to compute. Neither side is
    broadcast: the planner takes parsed or exploded rows for much smaller than they are, and
    would gather them in the driver.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = left.agg(F.count("*").alias("n")).scalar()
    share = F.greatest(F.lit(hot_rows).cast("double"), total / F.lit(4.0 * partitions))
    hot = (
        left.groupBy(key)
        .agg(F.count("*").alias("_n"))
        .filter(F.col(key).isNotNull())
        .filter(F.col("_n") >= share)
        .select(key, F.ceil(F.col("_n") / share).cast("bigint").alias("_salts"))
    )
    plain = [F.col(f"`{c}`") for c, kind in left.dtypes if "map<" not in kind and "variant" not in kind]
    mixed = F.xxhash64(F.spark_partition_id(), *plain)
    salt = F.when(F.col(key).isNull(), mixed).otherwise(
        F.pmod(mixed, F.coalesce(F.col("_salts"), F.lit(1)))
    )
    salted = (
        left.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_salts")
    )
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    repeated = (
        right.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_salts")
    )
    return salted.join(repeated.hint("merge"), [key, "_salt"], how).drop("_salt")


def keep_reachable(
    pages: DataFrame, wanted: DataFrame, key: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Pages with a key among ``wanted``, read before HTML is parsed or shuffled.

    The distinct keys are measured first. Within the limit they are broadcast and the
    pages are not shuffled; beyond it this is a plain semi join.
    """
    keys = wanted.select(key).distinct()
    return pages.join(F.broadcast(keys) if fits_broadcast(keys, limit) else keys, key, "left_semi")


def segments_with_pages(
    listing: DataFrame,
    pages: DataFrame,
    key: str,
    missing: str = "empty",
    texts: tuple[str, ...] = (),
) -> DataFrame:
    """Listing rows with their page; without one kept with empty texts, or dropped."""
    if missing not in ("empty", "drop"):
        raise ValueError(f"missing must be 'empty' or 'drop', not {missing!r}")
    joined = join_to_one(listing, pages, key, "left" if missing == "empty" else "inner")
    return joined.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in texts})


def carry_program(programs: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """Listing rows with the attributes of their program."""
    return join_to_one(listing, programs, key)


def _distinct_keys(df: DataFrame, column: str, key: str) -> DataFrame:
    return df.select(F.col(column).alias(key)).distinct()


def records_with_file(df: DataFrame, files: DataFrame, key: str, file_key: str) -> DataFrame:
    """Records whose key has a stored file; keys that are missing or zero have none."""
    stored = _distinct_keys(files, file_key, key)
    return join_to_one(require_key(df, key), stored, key, "left_semi")


def records_without_file(df: DataFrame, files: DataFrame, key: str, file_key: str) -> DataFrame:
    """Records with a proper key but no stored file."""
    stored = _distinct_keys(files, file_key, key)
    return join_to_one(require_key(df, key), stored, key, "left_anti")


def broken_links(links: DataFrame, pages: DataFrame, key: str = "url_key") -> DataFrame:
    """Links whose target was never landed, with the page they stand on."""
    return join_to_one(links, _distinct_keys(pages, key, key), key, "left_anti")


def all_segments(evening: DataFrame, special: DataFrame) -> DataFrame:
    """Both kinds of segments; columns of one side only are null on the other."""
    return evening.unionByName(special, allowMissingColumns=True)
