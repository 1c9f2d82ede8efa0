"""Files written and read back."""

import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from archive_spark.operators.aggregates import archive_size_mb, file_match_counts, reconcile
from archive_spark.operators.filters import year_range
from archive_spark.plans.subset import subset_sizes, year_subset_job
from archive_spark.schema import SEGMENTS
from archive_spark.sources import (
    read_raw_pages,
    read_segments_csv,
    read_segments_jsonl,
    write_segments_csv,
    write_segments_jsonl,
)

ROWS = [
    ("Thursday, Aug 29, 2019", "A", "", "t", "", "", 1, 'say "hi", é\nnew', "Doe;"),
    (None, "", "x", "", "", "", 2, "\\ back", ""),
    ("Friday, Jan 3, 2020", "B", "", "", "", "", 3, "", ""),
    ("Friday, Jan 3, 2025", "B", "", "", "", "", 3, "", ""),
    ("Friday, Jan 2, 2026", "B", "", "", "", "", 4, "", ""),
    ("in 2021", "B", "", "", "", "", None, "", ""),
    ("in 2022", "B", "", "", "", "", 0, "", ""),
    ("in 2022", "B", "", "", "", "", 9, "", ""),
]


@pytest.fixture(scope="module")
def segments(spark):
    return spark.createDataFrame(ROWS, SEGMENTS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_gz_pages(spark, tmp_path):
    for name, html in {"16": "<p>é\n1</p>", "7": "<p>2</p>", "note": "x"}.items():
        (tmp_path / f"{name}.html.gz").write_bytes(gzip.compress(html.encode()))
    pages = read_raw_pages(spark, str(tmp_path), "broadcast", "https://news.example.org/")
    got = {(r["page_id"], r["url"], r["html"]) for r in pages.collect()}
    assert got == {
        (16, "https://news.example.org/broadcasts/16", "<p>é\n1</p>"),
        (7, "https://news.example.org/broadcasts/7", "<p>2</p>"),
        (None, None, "x"),
    }


def test_jsonl_round_trip_keeps_null_keys(spark, segments, tmp_path):
    path = str(tmp_path / "out")
    write_segments_jsonl(segments, path)
    assert rows(read_segments_jsonl(spark, path)) == sorted(ROWS, key=repr)
    lines = [json.loads(x) for f in (tmp_path / "out").glob("part*") for x in f.open() if x.strip()]
    assert all(set(line) == set(SEGMENTS.names) for line in lines)


def test_jsonl_blank_and_broken_lines(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_text('{"broadcast_order": 1}\n\n   \n{"broadcast_order": 2, "date": "\\u00e9"}\n')
    got = read_segments_jsonl(spark, str(good)).select("broadcast_order", "date")
    assert rows(got) == [(1, None), (2, "é")]
    broken = tmp_path / "broken.jsonl"
    broken.write_text('{"broadcast_order": 1}\n{"broadcast_order": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_segments_jsonl(spark, str(broken)).collect()


def test_csv_round_trip(spark, segments, tmp_path):
    path = str(tmp_path / "csv")
    write_segments_csv(segments.coalesce(1), path)
    expected = [tuple("" if v is None and i != 6 else v for i, v in enumerate(r)) for r in ROWS]
    assert rows(read_segments_csv(spark, path)) == sorted(expected, key=repr)
    (part,) = (tmp_path / "csv").glob("part*")
    assert part.read_text().splitlines()[0].split(",") == sorted(SEGMENTS.names)


def test_year_subset_job(spark, segments, tmp_path):
    files = spark.createDataFrame([(1, "a"), (3, "b" * 300_000), (4, "c")], "page_id long, html string")
    years, report = year_subset_job(segments, files, 2020, 2025, str(tmp_path / "sub"))
    assert [tuple(r) for r in years.collect()] == [(2020, 1), (2021, 1), (2022, 2), (2025, 1)]
    got = report.first().asDict()
    assert got == {
        "total": 8, "copied": 2, "missing": 1, "records": 5, "files": 1, "ok": False, "size_mb": 0.3,
    }
    stored = spark.read.parquet(str(tmp_path / "sub/html"))
    assert [r["page_id"] for r in stored.collect()] == [3]
    sizes = {r["part"]: r["stored_mb"] for r in subset_sizes(spark, str(tmp_path / "sub")).collect()}
    assert set(sizes) == {"data", "html"} and all(0 <= v < 0.3 for v in sizes.values())


@pytest.mark.parametrize("mode", ["append", "ignore"])
def test_year_subset_job_again_and_of_nothing(spark, segments, tmp_path, mode):
    files = spark.createDataFrame([(3, "b")], "page_id long, html string")
    path = str(tmp_path / "sub")
    _, report = year_subset_job(segments.limit(0), files, 2020, 2025, path)
    assert (report.first()["total"], report.first()["records"]) == (0, 0)
    _, report = year_subset_job(segments, files, 2020, 2025, path, mode)
    assert (report.first()["total"], report.first()["records"]) == (8, 5 if mode == "append" else 0)


def test_counts_of_nothing(spark, segments):
    none = segments.limit(0)
    files = spark.createDataFrame([], "page_id long, html string")
    assert tuple(file_match_counts(none, files, "broadcast_order", "page_id").first()) == (0, 0)
    assert tuple(reconcile(none, files, "broadcast_order", "page_id").first()) == (0, 0, True)
    assert archive_size_mb(files).first()[0] == 0.0
    assert year_range(none, 2020, 2025).count() == 0


def test_write_modes(spark, segments, tmp_path):
    path = str(tmp_path / "modes")
    write_segments_jsonl(segments, path)
    write_segments_jsonl(segments.filter(F.col("broadcast_order") == 3), path, "append")
    assert read_segments_jsonl(spark, path).count() == len(ROWS) + 2
    write_segments_jsonl(segments, path, "overwrite")
    assert read_segments_jsonl(spark, path).count() == len(ROWS)


def test_years_are_folders_and_a_rewrite_keeps_other_years(spark, tmp_path):
    import glob

    from archive_spark.sources import read_segments_years, write_segments_by_year

    df = spark.createDataFrame(
        [(f"t{i}", 1995 + i % 4, i) for i in range(40)] + [("none", None, 99)], "title string, year int, k int"
    )
    path = str(tmp_path / "years")
    write_segments_by_year(df, path)
    before = {y: sorted(glob.glob(f"{path}/year={y}/*")) for y in (1995, 1996, 1997, 1998)}
    write_segments_by_year(df.filter("year = 1997 AND k < 10"), path)
    after = {y: sorted(glob.glob(f"{path}/year={y}/*")) for y in (1995, 1996, 1997, 1998)}
    assert all(before[y] == after[y] for y in (1995, 1996, 1998)) and before[1997] != after[1997]
    schema = df.drop("year").schema
    got = read_segments_years(spark, path, 1996, 1997, schema)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan.split("PartitionFilters")[1][:200]
    counts = {r.year: r.n for r in got.groupBy("year").agg(F.count("*").alias("n")).collect()}
    assert counts == {1996: 10, 1997: 2}


def test_pages_in_other_charsets_are_read(spark, tmp_path):
    from archive_spark.operators.parse import ARCHIVE_PROFILES, parse_pages

    pages = {
        "1": gzip.compress('<meta charset="iso-8859-1"><p>café</p>'.encode("latin-1")),
        "2": "﻿<p>naïve</p>".encode("utf-16-le"),
        "3": b"<p>bad \xff\xfe bytes \xe9</p>",
        "4": gzip.compress(b"\xef\xbb\xbf<p>plain</p>"),
        "5": b"",
    }
    for name, body in pages.items():
        (tmp_path / f"{name}.html.gz").write_bytes(body)
    got = {r["page_id"]: r["html"] for r in read_raw_pages(spark, str(tmp_path), "broadcast", "https://h/").collect()}
    assert got[1].endswith("<p>café</p>") and got[2] == "<p>naïve</p>" and got[4] == "<p>plain</p>"
    assert 5 not in got  # Spark lists no empty file
    assert got[3] == "<p>bad �� bytes �</p>"
    parsed = parse_pages(read_raw_pages(spark, str(tmp_path), "broadcast", "https://h/"), ARCHIVE_PROFILES["broadcast"])
    assert parsed.count() == 4


def test_unknown_keys_survive_a_round_trip(spark, tmp_path):
    src = tmp_path / "in.jsonl"
    src.write_text(
        '{"broadcast_order": 1, "date": "Friday, Jan 3, 2020", "zz": {"a": [1, 2.5, "x"]}, "n": 5, "s": null}\n'
        "\n"
        '{"broadcast_order": 2, "date": "in 2021"}\n'
    )
    got = read_segments_jsonl(spark, str(src), keep_unknown=True)
    assert got.columns == SEGMENTS.names + ["_unknown"]
    out = str(tmp_path / "out")
    write_segments_jsonl(got.withColumn("year", F.lit(2020)), out, "overwrite", partition_by="year")
    lines = [json.loads(x) for f in (tmp_path / "out").glob("year=2020/part*") for x in f.open() if x.strip()]
    lines.sort(key=lambda d: d["broadcast_order"])
    assert lines[0]["zz"] == {"a": [1, 2.5, "x"]} and lines[0]["n"] == 5 and "s" in lines[0]
    assert set(lines[1]) == set(SEGMENTS.names)
    again = read_segments_jsonl(spark, out, T.StructType(SEGMENTS.fields + [T.StructField("year", T.IntegerType())]), True)
    assert {r.broadcast_order: r.year for r in again.collect()} == {1: 2020, 2: 2020}
    broken = tmp_path / "broken.jsonl"
    broken.write_text('{"broadcast_order": 1}\n{"broadcast_order": \n')
    with pytest.raises(Exception):
        read_segments_jsonl(spark, str(broken), keep_unknown=True).collect()
