"""Session settings, scratch tables on shared storage and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# AQE splits skewed join partitions and merges small ones; it is forced because
# a skewed join followed by an aggregation on the same key would be left alone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.topKSortFallbackThreshold": "1000000",
    "spark.sql.parquet.compression.codec": "zstd",
}

BROADCAST_BYTES = 64 * 1024 * 1024
_LOCAL: dict[str, str] = {}


def get_session(app: str = "archive_spark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    Without that setting only a session on one machine has a place: a temporary folder of
    its own. On a cluster each executor would write to its own disk, so that is refused.
    The settings of the session stay as they are.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder, master is {master}")
        base = _LOCAL.setdefault("base", "") or tempfile.mkdtemp(prefix="archive-spark-")
        _LOCAL["base"] = base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch table and read it back.

    Used where one expensive result has several readers: it is computed once, the
    lineage ends at the files, and each reader scans only the columns it needs.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of the string columns of a row plus 16 for every column."""
    width = F.lit(16 * len(df.columns)).cast("bigint")
    for name, dtype in df.dtypes:
        if dtype == "string":
            width = width + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    return width


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return (df.agg(F.sum(row_bytes(df)).alias("n")).first()["n"] or 0) <= limit
