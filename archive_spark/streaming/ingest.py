"""Segments from pages as they land, with the last visit of every page kept as state.

Each micro-batch is scanned once: one pass parses the pages of all kinds, and one shuffle
and write merges them into the state of their kind: the last visit per URL key, stored in
buckets of the key. A batch rewrites only the buckets it touches, into a new version named
by its batch id, and publishes them by writing its manifest last. Readers take, per bucket, the newest published version. A
batch run again after a lost executor or a restart rebuilds its versions from those
published before it, so rows are neither lost nor doubled, and no file is rewritten
while it is read.

Which list a page stands on, and which program lists it, may be known only after the page
has landed. So the walk from the site index to segments is done on reading, over the
stored last visits, which no longer need a window over all visits ever parsed; the result
does not depend on the order of arrival.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.parse import ARCHIVE_PROFILES
from ..plans.crawl import last_visits_by_kind, parse_every_kind, parse_kind, segments_from
from ..schema import RAW_PAGES
from ..session import materialize

BUCKETS = 64
SPLITS_PER_CORE = 4
MANIFEST = "state/_manifest"


def bucket_of(key: str = "url_key", buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _parsed_schema(spark: SparkSession, kind: str) -> T.StructType:
    return parse_kind(spark.createDataFrame([], RAW_PAGES), kind).schema


def versions(spark: SparkSession, out: str, below: int | None = None) -> dict[tuple[str, int], int]:
    """Newest published version of each (kind, bucket): at most kinds x buckets entries."""
    try:
        manifest = spark.read.parquet(f"{out}/{MANIFEST}")
    except AnalysisException:
        return {}
    if below is not None:
        manifest = manifest.filter(F.col("version") < below)
    newest = manifest.groupBy("kind", "bucket").agg(F.max("version").alias("v")).collect()
    return {(r.kind, r.bucket): r.v for r in newest}


def _folder(spark: SparkSession, path: str):
    """A folder and its file system."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _paths(spark: SparkSession, out: str, kind: str, found: dict, buckets=None) -> list[str]:
    """Folders of the published buckets; versions written kind by kind have one folder a kind."""
    wanted = [(b, v) for (k, b), v in sorted(found.items()) if k == kind and (buckets is None or b in buckets)]
    base = {}
    for v in {v for _, v in wanted}:
        folder, fs = _folder(spark, f"{out}/state/v={v}")
        base[v] = f"{out}/state/v={v}/page_kind={kind}" if fs.exists(folder) else f"{out}/state/{kind}/v={v}"
    return [f"{base[v]}/bucket={b}" for b, v in wanted]


def _read(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def _written_buckets(spark: SparkSession, path: str) -> set[int]:
    """Buckets a partitioned write made under ``path``, from folder names (no data read)."""
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return set()
    names = [st.getPath().getName() for st in fs.listStatus(folder) if st.isDirectory()]
    return {int(n.split("=", 1)[1]) for n in names if n.startswith("bucket=")}


def merge_batch(spark: SparkSession, batch: DataFrame, batch_id: int, out: str, buckets: int = BUCKETS) -> None:
    """Merge one batch of raw pages into the state of every kind and publish it.

    The batch is scanned and parsed once. If there is state already, its parsed rows are
    stored first: they name the buckets to read, and are then merged with them.
    """
    before = versions(spark, out, below=batch_id)
    parsed = parse_every_kind(batch)
    if before:
        parsed = materialize(parsed, "batch")
        # at most kinds x ``buckets`` values
        touched = parsed.select("page_kind", bucket_of(buckets=buckets).alias("b")).distinct().collect()
        for kind in sorted({r.page_kind for r in touched}):
            paths = _paths(spark, out, kind, before, {r.b for r in touched if r.page_kind == kind})
            earlier = _read(spark, paths, _parsed_schema(spark, kind)).withColumn("page_kind", F.lit(kind))
            parsed = parsed.unionByName(earlier, allowMissingColumns=True)
    merged = last_visits_by_kind(parsed).withColumn("bucket", bucket_of(buckets=buckets))
    # a bucket's rows are brought together (AQE splits large ones), so it gets few files
    _write_state(merged, f"{out}/state/v={batch_id}")
    _publish(spark, out, batch_id)


def _write_state(pages: DataFrame, target: str) -> None:
    spread = pages.hint("rebalance", "page_kind", "bucket")
    spread.write.mode("overwrite").partitionBy("page_kind", "bucket").parquet(target)


def _publish(spark: SparkSession, out: str, version: int) -> None:
    """Publish all buckets that were written for a version: at most kinds x buckets rows."""
    target = f"{out}/state/v={version}"
    published = [
        (kind, b, version)
        for kind in ARCHIVE_PROFILES
        for b in sorted(_written_buckets(spark, f"{target}/page_kind={kind}"))
    ]
    manifest = spark.createDataFrame(published, "kind string, bucket int, version long").coalesce(1)
    manifest.write.mode("overwrite").parquet(f"{out}/{MANIFEST}/batch_id={version}")


def _finer_splits(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` that cuts files into several splits a core.

    Kinds differ much in work per byte, so with one split a core the batch waits for a few
    tasks. A stream plans its scans by the settings of the session that reads the source.
    """
    setting = "spark.sql.files.minPartitionNum"
    finer = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            finer.conf.set(name, value)
    if finer.conf.get(setting, None) is None:
        finer.conf.set(setting, SPLITS_PER_CORE * spark.sparkContext.defaultParallelism)
    return finer


def stream_segments(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    schema: T.StructType = RAW_PAGES,
    file_format: str = "parquet",
    max_files: int | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Parse pages that are new in ``source`` and merge them into the state in ``out``.

    Runs until all present files are read (``availableNow``). Each batch is scanned once.
    The stream runs in a session of its own beside ``spark``, with the same settings.
    """
    reader = _finer_splits(spark).readStream.format(file_format).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch.sparkSession, batch.select(*RAW_PAGES.names), batch_id, out, buckets)

    return (
        reader.load(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def parsed_pages(spark: SparkSession, out: str, kind: str, buckets=None) -> DataFrame:
    """Last visits of the pages of ``kind`` parsed so far, of the given buckets or all."""
    return _read(spark, _paths(spark, out, kind, versions(spark, out), buckets), _parsed_schema(spark, kind))


def read_current(spark: SparkSession, out: str, buckets: int = BUCKETS, **options) -> DataFrame:
    """Segments of all pages parsed so far; ``options`` are those of ``segments_from``.

    A kind's state is read only in the buckets of the links that lead to it, and only
    pages behind these links are kept.
    """
    found = versions(spark, out)

    def visits(kind: str, links: DataFrame | None) -> tuple[DataFrame, bool]:
        schema = _parsed_schema(spark, kind)
        if links is None:
            return _read(spark, _paths(spark, out, kind, found), schema), True
        keys = links.select("url_key").distinct()
        wanted = {r.b for r in keys.select(bucket_of(buckets=buckets).alias("b")).distinct().collect()}
        pages = _read(spark, _paths(spark, out, kind, found, wanted), schema)
        return pages.join(keys, "url_key", "left_semi"), False

    return segments_from(visits, **options)


def compact(spark: SparkSession, out: str, into: str, buckets: int = BUCKETS) -> None:
    """Write the state found in ``out`` as the one version (-1) of a new folder ``into``.

    Run it while no stream writes to ``out``. Let the stream go on into the new folder with
    the same checkpoint: its next batches have higher numbers than those gathered.
    """
    every = [
        parsed_pages(spark, out, kind).withColumn("page_kind", F.lit(kind)) for kind in ARCHIVE_PROFILES
    ]
    pages = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), every)
    _write_state(pages.withColumn("bucket", bucket_of(buckets=buckets)), f"{into}/state/v=-1")
    _publish(spark, into, -1)
