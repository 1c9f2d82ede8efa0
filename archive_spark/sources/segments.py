"""Segment tables as JSON lines, CSV and compressed exports.

``mode`` is Spark's write mode: ``append`` adds to an output, ``overwrite``
replaces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.filters import require_key
from ..operators.joins import keep_reachable
from ..schema import SEGMENTS


# Keys of a record that its schema does not name are kept here, as one VARIANT object.
UNKNOWN = "_unknown"


def read_segments_jsonl(
    spark: SparkSession, path: str, schema: T.StructType = SEGMENTS, keep_unknown: bool = False
) -> DataFrame:
    """One object per line; blank lines are skipped, a broken line fails the job.

    With ``keep_unknown`` (or a column ``_unknown`` in ``schema``) keys that ``schema`` does
    not name are kept, values as they are, in the VARIANT column ``_unknown`` (null if
    there are none), which ``write_segments_jsonl`` writes back as keys of the line.
    Columns of ``schema`` that are folders of the path (such as ``year``) come from there.
    """
    keep_unknown = keep_unknown or UNKNOWN in schema.names
    if not keep_unknown:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    fields = [f for f in schema.fields if f.name != UNKNOWN]
    lines = spark.read.text(path)
    folders = [c for c in lines.columns if c != "value"]
    in_line = T.StructType([f for f in fields if f.name not in folders])
    lines = lines.filter(F.trim("value") != "")
    known = F.from_json("value", in_line, {"mode": "FAILFAST"})
    names = F.array(*[F.lit(f.name) for f in fields])
    rest = F.map_filter(F.parse_json("value").cast("map<string,variant>"), lambda k, v: ~F.array_contains(names, k))
    unknown = F.when(F.size(rest) > 0, F.parse_json(F.to_json(rest)))
    parsed = lines.select(known.alias("_known"), unknown.alias(UNKNOWN), *folders)
    columns = [F.col(f"_known.`{f.name}`") if f.name not in folders else F.col(f"`{f.name}`") for f in fields]
    return parsed.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, fields)], UNKNOWN)


def write_segments_jsonl(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    compression: str = "none",
    partition_by: str | None = None,
) -> None:
    """One object per line, keys with null kept.

    With ``partition_by`` (such as ``year``) there is one folder per value, and an
    overwrite replaces only the folders of the values present in ``df``; the others stay.
    Rows are first brought together by that value, large values split over tasks (AQE),
    so each folder gets few files. Keys kept in ``_unknown`` are written back into each
    line after the named ones.
    """
    if partition_by:
        df = df.hint("rebalance", partition_by)
    lines = UNKNOWN in df.columns
    if lines:
        named = [F.col(f"`{c}`") for c in df.columns if c not in (UNKNOWN, partition_by)]
        line = F.to_json(F.struct(*named), {"ignoreNullFields": "false"})
        extra = F.to_json(F.col(UNKNOWN))
        spliced = F.concat(F.expr("substring(_line, 1, length(_line) - 1)"), F.lit(","), F.expr("substring(_extra, 2)"))
        keep = [partition_by] if partition_by else []
        df = df.select(line.alias("_line"), extra.alias("_extra"), *keep).select(
            F.when(F.col("_extra").isNull() | (F.col("_extra") == "{}"), F.col("_line")).otherwise(spliced).alias("value"),
            *keep,
        )
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    if lines:
        writer.text(path)
    else:
        writer.option("ignoreNullFields", "false").json(path)


def write_segments_by_year(df: DataFrame, path: str, year: str = "year") -> None:
    """Gzip JSON lines, one folder per year; the years in ``df`` replace theirs, others stay."""
    write_segments_jsonl(df, path, "overwrite", "gzip", partition_by=year)


def read_segments_years(
    spark: SparkSession, path: str, lo: int, hi: int, schema: T.StructType = SEGMENTS, year: str = "year"
) -> DataFrame:
    """Rows of the years ``lo`` to ``hi`` of a table written by year; other folders are not read."""
    full = T.StructType([*schema.fields, T.StructField(year, T.IntegerType())])
    return read_segments_jsonl(spark, path, full).filter(F.col(year).between(lo, hi))


def write_segments_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON feed. Written as JSON lines, which stay splittable at any size."""
    write_segments_jsonl(df, path, mode)


def write_segments_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header and the columns in alphabetical order.

    CSV has no null: a missing text is an empty field, as an empty text is.
    """
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    (
        df.select(*columns)
        .write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_segments_csv(
    spark: SparkSession, path: str, schema: T.StructType = SEGMENTS
) -> DataFrame:
    """CSV as written here; quoted texts may hold quotes, commas and line ends.

    An empty field is an empty text, or null in a column of another type.
    """
    ordered = T.StructType(sorted(schema.fields, key=lambda f: f.name))
    df = (
        spark.read.schema(ordered)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    values = [
        F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in texts else F.col(f"`{c}`")
        for c in schema.names
    ]
    return df.select(*values)


def export_subset(
    segments: DataFrame, pages: DataFrame, path: str, mode: str = "errorifexists"
) -> None:
    """Two data sets: ``data`` (gzip JSON lines) and ``html`` (pages of these segments).

    Rows with a ``year`` are stored in one folder per year; an overwrite then replaces
    only the years written.

    The ids of the pages are read back from the data, so the source is read once; only an
    appended output, which holds older rows too, takes them from ``segments`` again.

    Ids are unique within a page kind only, so in a mixed archive segment pages alone count.
    """
    if "page_kind" in pages.columns:
        pages = pages.filter(F.col("page_kind") == "broadcast")
    by_year = "year" if "year" in segments.columns else None
    write_segments_jsonl(segments, f"{path}/data", mode, compression="gzip", partition_by=by_year)
    if mode != "append":
        segments = read_segments_jsonl(segments.sparkSession, f"{path}/data", segments.schema)
    wanted = require_key(segments).select(F.col("broadcast_order").alias("page_id"))
    keep_reachable(pages, wanted, "page_id").write.mode(mode).option(
        "compression", "zstd"
    ).parquet(f"{path}/html")
