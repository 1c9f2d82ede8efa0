"""A keyed table kept as snapshots: a merge rewrites only the buckets it touches.

Rows live in ``v=<version>/bucket=<b>`` folders. A merge writes the buckets that its
changes touch as a new version and then publishes them by a manifest
(``_manifest/v=<version>``), which appears whole when its job commits: that is the one
pointer readers follow. For every bucket, readers take the newest published version. A
merge killed before its manifest leaves the table as it was; the next one reuses the
version and overwrites what was left. Untouched buckets keep their files and names.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.incremental import upsert_segments

BUCKETS = 64
MANIFEST = "_manifest"


def key_bucket(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def published(spark: SparkSession, path: str) -> dict[int, int]:
    """Newest published version of each bucket: at most ``buckets`` entries."""
    try:
        manifest = spark.read.parquet(f"{path}/{MANIFEST}")
    except AnalysisException:
        return {}
    return {r.bucket: r.version for r in manifest.groupBy("bucket").agg(F.max("version").alias("version")).collect()}


def _next_version(spark: SparkSession, path: str) -> int:
    try:
        return (spark.read.parquet(f"{path}/{MANIFEST}").agg(F.max("version")).first()[0] or 0) + 1
    except AnalysisException:
        return 0


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, buckets=None) -> DataFrame:
    """The current rows, of the given buckets or all."""
    paths = [f"{path}/v={v}/bucket={b}" for b, v in sorted(published(spark, path).items()) if buckets is None or b in buckets]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def merge_snapshot(
    changes: DataFrame, path: str, key: str, order: list[Column], buckets: int = BUCKETS
) -> int:
    """Merge ``changes`` as ``upsert_segments`` does; returns the published version.

    Rows of a key in ``changes`` replace those of the table (the first in ``order`` wins);
    rows without a key are added. Only buckets holding a key of ``changes`` are read and
    written again. Into an empty path, the first row of each key and all rows without a
    key are written.
    """
    spark = changes.sparkSession
    version = _next_version(spark, path)
    current = published(spark, path)
    changes = changes.withColumn("_bucket", key_bucket(key, buckets))
    touched = sorted(r["_bucket"] for r in changes.select("_bucket").distinct().collect())
    schema = T.StructType([f for f in changes.schema.fields if f.name != "_bucket"])
    old = read_snapshot(spark, path, schema, set(touched)) if current else spark.createDataFrame([], schema)
    merged = upsert_segments(old, changes.drop("_bucket"), key, order).withColumn("bucket", key_bucket(key, buckets))
    merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/v={version}")
    rows = [(b, version) for b in touched]
    spark.createDataFrame(rows, "bucket int, version long").write.mode("overwrite").parquet(f"{path}/{MANIFEST}/v={version}")
    return version
