"""The walk over a small site: batch, bounded, incremental and streamed."""

import pytest
from pyspark.sql import functions as F
from small_site import EVENING_1, EXPECTED, PAGES, SITE, SPECIAL_1, SPECIAL_11, UNDATED

from archive_spark.operators.aggregates import links_per_page, progress
from archive_spark.operators.audit import duplicate_segments, missing_durations
from archive_spark.operators.joins import broken_links
from archive_spark.operators.links import distinct_requests, month_links, program_link, segment_links
from archive_spark.operators.parse import ARCHIVE_PROFILES
from archive_spark.plans.crawl import (
    build_segments,
    last_visits,
    last_visits_by_kind,
    parse_behind,
    parse_every_kind,
    parse_kind,
    request_id,
)
from archive_spark.plans.incremental import incremental_segments, upsert_segments
from archive_spark.schema import RAW_PAGES, SEGMENTS
from archive_spark.session import scratch_path
from archive_spark.sources import read_page_archive, save_raw_pages
from archive_spark.streaming import compact, read_current, stream_segments
from archive_spark.streaming.ingest import _finer_splits

HOSTS = ["news.example.org"]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, RAW_PAGES).repartition(3)


def rows(df):
    assert df.columns == SEGMENTS.names
    return sorted((tuple(r) for r in df.collect()), key=repr)


def expected(*parts):
    return sorted((row for part in parts for row in part), key=repr)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_whole_site(pages, broadcast_bytes):
    built = build_segments(pages, hosts=HOSTS, broadcast_bytes=broadcast_bytes)
    assert rows(built) == expected(EXPECTED)


def test_missing_pages_can_be_dropped(pages):
    built = build_segments(pages, hosts=HOSTS, missing="drop")
    assert rows(built) == expected([r for r in EXPECTED if r[6] != 19])


def test_month_regex_and_bounds(pages):
    eleven = build_segments(pages, hosts=HOSTS, month_regex="2024-11")
    assert rows(eleven) == expected(SPECIAL_11)
    until = build_segments(pages, hosts=HOSTS, end="2024-05-08")
    assert rows(until) == expected(EVENING_1, SPECIAL_1, UNDATED)
    since = incremental_segments(pages, "2024-01-02", hosts=HOSTS)
    assert rows(since) == expected(SPECIAL_11, UNDATED)


def test_limit_keeps_the_first_ids(pages):
    built = build_segments(pages, hosts=HOSTS, max_items=3)
    assert [r[6] for r in built.collect()] == [11, 11, 12]


def test_two_increments_equal_one_run(pages):
    base = incremental_segments(pages, None, "2024-05-01", hosts=HOSTS)
    delta = incremental_segments(pages, "2024-05-01", hosts=HOSTS)
    assert rows(upsert_segments(base, delta, "broadcast_order", [F.col("broadcast_title")])) == expected(EXPECTED)


def test_saved_archive_gives_the_same_rows(spark, pages):
    path = scratch_path(spark, "small-site")
    save_raw_pages(pages, path)
    saved = read_page_archive(spark, path)
    assert saved.count() == len(PAGES) - 1
    assert rows(build_segments(saved, hosts=HOSTS)) == expected(EXPECTED)


def test_links_of_each_hop(pages):
    months = month_links(parse_kind(pages, "index"))
    assert [r["href"] for r in months.orderBy("pos").collect()] == [
        "/siteindex/2024-1", "/siteindex/2024-11", "undated", "/siteindex/2024-1",
        "/siteindex/2023-05",
    ]
    segments = segment_links(parse_kind(pages, "month"))
    per_page = {r[0].rsplit("/")[-1]: tuple(r[1:]) for r in links_per_page(segments).collect()}
    assert per_page == {"2024-1": (4, 2), "2024-11": (2, 2), "undated": (0, 1)}
    assert distinct_requests(segments).count() == 10
    programs = program_link(last_visits(parse_kind(pages, "broadcast")))
    assert {r["url"] for r in programs.collect()} == {f"{SITE}/programs/{i}" for i in (1, 2, 3)}
    landed = parse_kind(pages, "program").select("url_key")
    lost = broken_links(distinct_requests(programs), landed)
    assert [tuple(r) for r in lost.select("url", "src_url").collect()] == [
        (f"{SITE}/programs/3", f"{SITE}/broadcasts/31")
    ]


def test_audits(spark, pages):
    built = build_segments(pages, hosts=HOSTS)
    assert {r["broadcast_order"] for r in missing_durations(built).collect()} == {19, 21, 92, 93}
    assert [tuple(r) for r in duplicate_segments(built).collect()] == [(11, 2)]
    months = month_links(parse_kind(pages, "index"))
    done = parse_kind(pages, "month")
    found = segment_links(done)
    row = progress(months, done, found, built, "date").first()
    assert tuple(row)[:4] == (5, 3, 11, len(EXPECTED))


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_stream_equals_batch(spark, pages, files_per_batch):
    path = scratch_path(spark, "streamed")

    def run(out):
        stream_segments(
            spark, f"{path}/in", f"{path}/{out}", f"{path}/ckpt", max_files=files_per_batch
        ).awaitTermination()

    # segment and program pages come before the pages that lead to them
    early = F.col("page_kind").isin("broadcast", "program") & (F.col("page_id") < 20)
    pages.filter(early).repartition(2).write.mode("append").parquet(f"{path}/in")
    run("out")
    pages.filter(F.coalesce(~early, F.lit(True))).coalesce(2).write.mode("append").parquet(f"{path}/in")
    run("out")
    run("out")  # nothing new
    expected = rows(build_segments(pages, hosts=HOSTS))
    assert rows(read_current(spark, f"{path}/out", hosts=HOSTS)) == expected
    if files_per_batch is None:
        compact(spark, f"{path}/out", f"{path}/packed")
        assert rows(read_current(spark, f"{path}/packed", hosts=HOSTS)) == expected


def test_stream_batch_written_twice_counts_once(spark, pages):
    path = scratch_path(spark, "replayed")
    pages.write.parquet(f"{path}/in")
    for checkpoint in ("first", "second"):  # the same batch ids again, as after a lost checkpoint
        stream_segments(
            spark, f"{path}/in", f"{path}/out", f"{path}/{checkpoint}"
        ).awaitTermination()
    once = rows(build_segments(pages, hosts=HOSTS))
    assert rows(read_current(spark, f"{path}/out", hosts=HOSTS)) == once


def test_page_without_answer_is_not_parsed(pages):
    assert parse_kind(pages, "month").filter(F.col("url").endswith("2023-05")).count() == 0


def test_ids_come_from_links_without_their_fragment(spark):
    urls = [("https://h/broadcasts/12#clip",), ("/programs/10#top",), ("/a/7",), ("/a#8",)]
    df = spark.createDataFrame(urls, "url string").select(request_id("url").alias("id"))
    assert [r.id for r in df.collect()] == [12, 10, 7, None]


def test_upsert_keeps_rows_without_a_key(spark):
    base = spark.createDataFrame([(1, "old"), (None, "base")], "k long, v string")
    delta = spark.createDataFrame([(1, "b"), (1, "a"), (None, "x"), (None, "x")], "k long, v string")
    got = upsert_segments(base, delta, "k", [F.col("v")]).collect()
    assert sorted((str(r.k), r.v) for r in got) == [
        ("1", "a"), ("None", "base"), ("None", "x"), ("None", "x")
    ]


def test_scan_is_bounded_by_the_ids_of_links(spark, pages):
    path = scratch_path(spark, "bounded")
    save_raw_pages(pages, path)
    links = spark.createDataFrame([(f"{SITE}/broadcasts/{i}",) for i in (11, 13, 12)], "url_key string")
    behind, everything = parse_behind(read_page_archive(spark, path), links, "broadcast", 1 << 20)
    plan = behind._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(page_id,13)" in plan and "GreaterThanOrEqual(page_id,11)" in plan
    assert not everything
    wanted = links.join(last_visits(parse_kind(pages, "broadcast")), "url_key", "left_semi")
    assert behind.count() == wanted.count() > 0
    odd = links.unionByName(links.limit(1).select(F.concat("url_key", F.lit("?x=1")).alias("url_key")))
    behind, _ = parse_behind(read_page_archive(spark, path), odd, "broadcast", 1 << 20)
    assert "LessThanOrEqual(page_id" not in behind._jdf.queryExecution().executedPlan().toString()


def test_stream_state_rewrites_touched_buckets_only(spark, pages):
    from archive_spark.streaming.ingest import merge_batch, versions

    path = scratch_path(spark, "state")
    merge_batch(spark, pages, 0, path)
    first = versions(spark, path)
    merge_batch(spark, pages, 0, path)  # the same batch again, as after a restart
    assert versions(spark, path) == first
    one = pages.filter(F.col("page_kind") == "program").limit(1)
    merge_batch(spark, one, 1, path)
    now = versions(spark, path)
    changed = {key for key in now if now[key] != first.get(key)}
    assert len(changed) == 1 and next(iter(changed))[0] == "program"
    expected = rows(build_segments(pages, hosts=HOSTS))
    assert rows(read_current(spark, path, hosts=HOSTS)) == expected


def test_many_links_read_only_their_buckets(spark, pages):
    from archive_spark.sources import read_page_index

    path = scratch_path(spark, "bucketed")
    save_raw_pages(pages, path, buckets=8)
    archive, index = read_page_archive(spark, path, bucket=True), read_page_index(spark, path)
    assert index.count() == read_page_archive(spark, path).count()
    links = spark.createDataFrame([(f"{SITE}/broadcasts/{i}",) for i in (11, 13)], "url_key string")
    behind, everything = parse_behind(archive, links, "broadcast", 0, index)  # too many to broadcast
    plan = behind._jdf.queryExecution().executedPlan().toString()
    assert not everything and "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:300]
    wanted = last_visits(parse_kind(pages, "broadcast")).join(links, "url_key", "left_semi")
    assert sorted(map(tuple, behind.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)
    expected = rows(build_segments(pages, hosts=HOSTS))
    assert rows(build_segments(archive, broadcast_bytes=0, index=index, hosts=HOSTS)) == expected


def test_all_kinds_are_parsed_in_one_pass(spark, pages):
    twice = pages.unionByName(pages.withColumn("html", F.concat("html", F.lit("<p class='broadcast-info'>x</p>"))))
    parsed = parse_every_kind(twice)
    assert parsed._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    last = last_visits_by_kind(parsed)
    for kind in ARCHIVE_PROFILES:
        alone = parse_kind(twice, kind)
        for got, want in [(parsed, alone), (last, last_visits(alone))]:
            got = got.filter(F.col("page_kind") == kind).select(want.columns)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        others = set(parsed.columns) - set(alone.columns) - {"page_kind"}
        filled = parsed.filter(F.col("page_kind") == kind).filter(F.coalesce(*[F.col(c).cast("string") for c in others]).isNotNull())
        assert filled.count() == 0


def test_state_written_kind_by_kind_is_read_and_merged(spark, pages):
    from archive_spark.streaming.ingest import BUCKETS, MANIFEST, bucket_of, merge_batch

    path = scratch_path(spark, "old-state")
    early = F.col("page_kind").isin("broadcast", "program")
    published = []
    for kind in ("broadcast", "program"):
        state = last_visits(parse_kind(pages.filter(early), kind)).withColumn("bucket", bucket_of(buckets=BUCKETS))
        state.write.partitionBy("bucket").parquet(f"{path}/state/{kind}/v=0")
        published += [(kind, r.bucket, 0) for r in state.select("bucket").distinct().collect()]
    manifest = spark.createDataFrame(published, "kind string, bucket int, version long")
    manifest.write.parquet(f"{path}/{MANIFEST}/batch_id=0")
    merge_batch(spark, pages.filter(~early), 1, path)
    merge_batch(spark, pages.filter(early).limit(3), 2, path)
    assert rows(read_current(spark, path, hosts=HOSTS)) == rows(build_segments(pages, hosts=HOSTS))


def test_stream_cuts_files_finer_in_its_own_session(spark):
    setting = "spark.sql.files.minPartitionNum"
    finer = _finer_splits(spark)
    assert int(finer.conf.get(setting)) > spark.sparkContext.defaultParallelism
    assert finer.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert finer.conf.get("spark.checkpoint.dir") == spark.conf.get("spark.checkpoint.dir")
    assert spark.conf.get(setting, None) is None


def test_many_links_to_few_of_the_pages_are_joined_before_parsing(spark, pages):
    path = scratch_path(spark, "some")
    save_raw_pages(pages, path)
    archive = read_page_archive(spark, path)
    landed = archive.filter("page_kind = 'broadcast'").count()
    last = last_visits(parse_kind(pages, "broadcast"))
    keys = sorted(r.url_key for r in last.select("url_key").collect())
    for number, joined in [(2, True), (len(keys), False)]:
        links = spark.createDataFrame([(k,) for k in keys[:number]], "url_key string")
        parsed, complete = parse_behind(archive, links, "broadcast", 0)
        text = parsed._jdf.queryExecution().executedPlan().toString()
        assert (number * 2 <= landed) == joined == (not complete) == ("LeftSemi" in text)
        assert not joined or text.index("MapInArrow") < text.index("LeftSemi")
        want = last.filter(F.col("url_key").isin(keys[:number]))
        assert rows_of(parsed.join(links, "url_key", "left_semi")) == rows_of(want.select(parsed.columns))


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.select(sorted(df.columns)).collect())
