"""Schemas of the landed pages and of the tables derived from them."""

from pyspark.sql import types as T

RAW_PAGES = T.StructType(
    [
        T.StructField("page_kind", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("html", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

REPORTERS = "broadcast_reporter(s)"

SEGMENTS = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("program_title", T.StringType()),
        T.StructField("program_duration", T.StringType()),
        T.StructField("broadcast_title", T.StringType()),
        T.StructField("broadcast_duration", T.StringType()),
        T.StructField("broadcast_time", T.StringType()),
        T.StructField("broadcast_order", T.LongType()),
        T.StructField("broadcast_abstract", T.StringType()),
        T.StructField(REPORTERS, T.StringType()),
    ]
)

SEGMENTS_YEAR = T.StructType(SEGMENTS.fields + [T.StructField("year", T.IntegerType())])
