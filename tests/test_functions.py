"""Edge cases of the scalar functions, many of them against plain Python."""

import datetime as dt
import itertools
import random
import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from archive_spark.functions.urls import _is_plain, _resolve_steps, resolve_all, resolve_url
from archive_spark import functions as fn
from archive_spark.operators import filters

DAY = dt.date(2024, 1, 15)


def apply(spark, function, values, schema="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    result = rows.select("i", function(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(result, key=lambda r: r["i"])]


FLEXIBLE = {
    "2024-01-15": DAY, "2024/01/15": DAY, "01/15/2024": DAY, "20240115": DAY,
    "15-01-2024": DAY, "15/01/2024": DAY, "01-15-2024": DAY,
    "2024-1-5": dt.date(2024, 1, 5), "2024/1/5": dt.date(2024, 1, 5),
    "01-02-2024": dt.date(2024, 1, 2),
    "2024-01": dt.date(2024, 1, 1), "2024/1": dt.date(2024, 1, 1), "2024": dt.date(2024, 1, 1),
    "202411": dt.date(2024, 1, 1), "202412": dt.date(2024, 1, 2),
    "2024111": dt.date(2024, 11, 1),
    "202401": None, "2024-13": None, "2024-02-30": None, "24-01-15": None,
    " 2024-01-15": None, "2024-01-15\n": None, "0000": None, "": None, None: None,
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parse_flexible_date(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = apply(spark, fn.parse_flexible_date, list(FLEXIBLE))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert dict(zip(FLEXIBLE, got)) == FLEXIBLE


# The accepted layouts, as Python writes them.
LAYOUTS = "%Y-%m-%d %Y/%m/%d %m/%d/%Y %m-%d-%Y %Y-%m %Y/%m %Y%m%d %d-%m-%Y %d/%m/%Y %Y".split()


def first_layout(text):
    def attempt(layout):
        try:
            return dt.datetime.strptime(text, layout).date()
        except ValueError:
            return None

    return next(filter(None, map(attempt, LAYOUTS)), None)


def test_parse_flexible_date_on_generated_texts(spark):
    rng = random.Random(1)
    parts = ["1", "2", "11", "12", "13", "29", "30", "31", "02", "00", "2024", "2023", "0001", "9"]
    texts = {
        rng.choice(["-", "/", ""]).join(rng.choices(parts, k=rng.choice([1, 2, 3])))
        for _ in range(4000)
    }
    texts |= {"".join(rng.choices("0123456789", k=rng.randint(3, 9))) for _ in range(3000)}
    texts = sorted(texts)
    got = apply(spark, fn.parse_flexible_date, texts)
    assert {t: g for t, g in zip(texts, got) if g != first_layout(t)} == {}


URLS = {
    "/2024/1/": dt.date(2024, 1, 1), "/2024/01/15": dt.date(2024, 1, 1),
    "/2024-01/": dt.date(2024, 1, 1), "/january-2024/": dt.date(2024, 1, 1),
    "/Jan-2024": dt.date(2024, 1, 1), "/202401/": dt.date(2024, 1, 1),
    "/sept-2019": dt.date(2019, 9, 1), "/2024/13/": dt.date(2024, 1, 1),
    "/121112": dt.date(1211, 12, 1), "/12-0005": dt.date(12, 5, 1),
    "/2024/13/may-2020": dt.date(2020, 5, 1), "/2024/123": dt.date(2024, 12, 1),
    "/1140139": None, "/1-2024/": None, "/foo-2024/": None, "/siteindex/": None,
    "/0000/01/": None, "/0000/": None, "": None, None: None,
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_date_from_url(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = apply(spark, fn.date_from_url, list(URLS))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert dict(zip(URLS, got)) == URLS


def test_month_and_year(spark):
    assert apply(spark, fn.month_number, ["SEPT", "may", "foo", "", None]) == [9, 5, None, None, None]
    years = {
        "Thursday, Aug 29, 1968": 1968, "1899": None, "21000": None, "": None, None: None,
        "1999 2001": 1999, "x1999": None, "(2020)": 2020, "é1999": None, "1999é 2001": 2001,
    }
    assert dict(zip(years, apply(spark, fn.year_from_text, list(years)))) == years


def test_id_from_url_like_python(spark):
    urls = [
        "https://h/programs/12", "/12/", "/12?x=1", "/a", "0", "/0", "/-5", "/+5", "/1_000", "/_1",
        "/1__0", "/ 7 ", "/\xa07\n", "/12#top", "", "/1.5", "/1e3", "https://h", "/007",
    ]

    def number(url):
        try:
            return int(url.split("/")[-1])
        except ValueError:
            return None

    assert dict(zip(urls, apply(spark, fn.id_from_url, urls))) == {u: number(u) for u in urls}


def test_slug_and_file_name(spark):
    urls = ["http://h/siteindex/", "a//b", "http://h"]
    assert apply(spark, fn.page_slug, urls) == ["siteindex", "index", "index"]
    assert apply(spark, lambda c: fn.page_file_name("program", c), ["3"]) == ["programs/3.html.gz"]


def test_py_strip_knows_all_python_white_space(spark):
    spaces = [chr(c) for c in range(0x10000) if chr(c).isspace()]
    texts = [f"{s}a {s} b{s}{s}" for s in spaces] + ["".join(spaces), "​a", "᠎a", None]
    expected = [t.strip() if t is not None else None for t in texts]
    assert apply(spark, fn.py_strip, texts) == expected


def test_split_title_date(spark):
    texts = ["A for B for C", "A", " A for  B ", "", None, " for "]

    def both(kind):
        return lambda c: F.struct(*[p.alias(n) for n, p in zip("td", fn.split_title_date(c, kind))])

    special = [tuple(r) for r in apply(spark, both("special"), texts)]
    evening = [r["d"] for r in apply(spark, both("evening"), texts)]
    assert special == [("A", "C"), ("", ""), ("A", "B"), ("", ""), ("", ""), ("", "")]
    assert evening == ["C", None, "B", None, None, ""]


def test_headline_and_time(spark):
    assert apply(spark, fn.headline_title, [" A for B ", "A  for B", "A", None]) == ["A", "A ", "A", ""]
    times = [" 05:33:40 pm — 05:35:50 pm ", "", None]
    assert apply(spark, fn.time_range, times) == ["05:33:40 pm-05:35:50 pm", "", None]


def test_program_duration_like_python(spark):
    texts = [
        "This program is about 1 hour long.", "This program is\xa0about 1 hour\xa0long",
        "This\xa0program is 1 hour long", " 25 min ", "", "This program is  long",
        "x This program is 2\r hours long long", "This program is 2\nhours long",
        "This program is\x1c5 min\x1flong",
    ]

    def expected(text):
        match = re.search(r"This program is\s(.*?)\slong", text)
        return match.group(1) if match else text.strip()

    got = apply(spark, fn.program_duration, texts + [None])
    assert got == [expected(t) for t in texts] + [""]


def test_concat_text(spark):
    rows = spark.createDataFrame([([" a ", "b", "\t"],), ([],), (None,)], "v array<string>")
    assert [r[0] for r in rows.select(fn.concat_text("v")).collect()] == ["ab", "", None]


def test_resolve_url_like_urljoin(spark):
    bases = [
        "https://h.org/a/b/c.html", "https://h.org/a/b/", "https://h.org", "http://h.org/x?q=1#f",
        "https://h.org:8080/a/./b",
    ]
    hrefs = [
        "/x", "x", "x/y/", "../x", "../../../x", "./x", ".", "..", "/a/../b", "/../x", "?q=2",
        "#frag", "", "//other.org/z", "http://o.org/p", "mailto:a@b", "x?y=../z", "x#../z", "a/./b",
        "/x/.", "/x/..", "é ü",
    ]
    pairs = list(itertools.product(bases, hrefs))
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, b string, h string")
    result = rows.select("i", fn.resolve_url("b", "h").alias("u")).collect()
    got = {pairs[r["i"]]: r["u"] for r in result}
    assert {p: (u, urljoin(*p)) for p, u in got.items() if u != urljoin(*p)} == {}


def test_url_key_and_host(spark):
    urls = ["http://H.org/a?b=2&a=1#x", "http://h.org/a#y", "http://u@h.org:80/", "/x?b&a"]
    assert apply(spark, fn.url_key, urls) == [
        "http://H.org/a?a=1&b=2", "http://h.org/a", "http://u@h.org:80/", "/x?a&b",
    ]
    assert apply(spark, fn.host_of, urls) == ["h.org", "h.org", "h.org", ""]


META = (
    "v array<struct<position:int,list_id:int,in_list:boolean,is_label:boolean,texts:array<string>>>"
)


def test_meta_and_reporters(spark):
    normal = [
        (0, 1, True, True, ["Duration:"]), (1, 1, True, False, ["00:01:00"]),
        (2, 1, True, True, ["Reporter(s):"]), (3, 1, True, False, ["Doe, Ann;"]),
        (4, 1, True, False, ["00:01:00", "Roe, Bo"]),
    ]
    empty_dd = [(0, 1, True, True, ["Duration:"]), (1, 1, True, False, []), (2, 1, True, False, ["x"])]
    elsewhere = [(0, 1, True, True, ["Duration:"]), (1, 2, False, True, ["Duration:"]),
                 (2, 2, False, False, ["y"])]
    unstripped = [(0, 1, True, True, ["Duration: "]), (1, 1, True, False, ["z"])]
    rows = spark.createDataFrame(
        [(i, v) for i, v in enumerate([normal, empty_dd, elsewhere, unstripped, [], None])],
        f"i int, {META}",
    )
    duration = fn.meta_first("v", "Duration:")
    got = rows.orderBy("i").select(
        duration, fn.meta_first("v", "Duration:", any_list=True),
        fn.reporters("v", "Reporter(s):", duration),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("00:01:00", "00:01:00", "Doe, Ann;Roe, Bo"), ("x", "x", ""), ("", "y", ""),
        ("", "", ""), ("", "", ""), ("", "", ""),
    ]


def test_bounds_and_temporal_filter(spark):
    today = dt.date(2025, 5, 20)

    def bounds(*args):
        lower, upper = filters.resolve_bounds(*args, today=today)
        return tuple(spark.range(1).select(lower, upper).first())

    assert bounds(None, None, 0) == (None, today)
    assert bounds("Today", "today", 0) == (today, today)
    assert bounds("soon", "2025-01", 7) == (None, dt.date(2024, 12, 25))
    links = spark.createDataFrame([("/2025-05",), ("/2025-04",), ("/x",), (None,)], "url string")

    def kept(start, end):
        lower, upper = filters.resolve_bounds(start, end, today=today)
        return {r[0] for r in filters.temporal_filter(links, lower, upper).collect()}

    assert kept("2025-05-08", None) == {"/x", None}
    assert kept(None, "2025-05-08") == {"/2025-05", "/2025-04", "/x", None}


def test_month_filter(spark):
    links = spark.createDataFrame([("/m/2019-11",), ("/m/2018-19",), ("all",)], "href string")
    kept = lambda regex: {r[0] for r in filters.month_filter(links, regex).collect()}
    assert kept("2019-1") == {"/m/2019-11"}
    assert kept("19") == set()
    assert kept("al|2018") == {"/m/2018-19", "all"}
    assert len(kept(None)) == 3


def test_plain_paths_skip_the_steps_of_others(spark):
    hrefs = ["/a/b", "/a:b", "/", "//h/x", "/./a", "/a/..", "/.x", "/a?b", "/a#b", "a", "", None]
    plain = [h in ("/a/b", "/a:b", "/") for h in hrefs]
    assert apply(spark, _is_plain, hrefs) == plain
    assert apply(spark, lambda h: fn.resolve_url(F.lit("http://h.org/p/q"), h), hrefs[:3]) == [
        "http://h.org/a/b", "http://h.org/a:b", "http://h.org/",
    ]


def test_short_ways_of_resolving_equal_the_steps(spark):
    bases = [f"https://h.org{p}{q}" for p, q in itertools.product(
        ["", "/", "/a", "/a/", "/a/b", "/a/b/c", "/a/b/", "//a/b", "/a//b", "/./b", "/a/../b", "/a/.x/b", "/a b/c"], ["", "?q=/x/y", "#f/g/h"])]
    bases += ["", "x/y/z", None]
    parts = ["", "a", ".", "..", ".a", "a.b", "b c"]
    hrefs = ["/".join(p) for n in (1, 2, 3, 4) for p in itertools.product(parts, repeat=n)]
    hrefs += [h + end for h in ("/a/b", "../a", "../a/b", "..", "../", "/") for end in ("?x", "#x", " ", "\n", "\xa0", "//")]
    hrefs += [" /a", " ../a", "http://x/y", "../a:b", None]
    df = spark.createDataFrame([(b, hrefs) for b in bases], "base string, hrefs array<string>").repartition(8)
    both = df.select("base", resolve_all("base", "hrefs").alias("got"), _resolve_steps(F.col("base"), F.col("hrefs")).alias("want"))
    for row in both.collect():
        for got, want in zip(row.got, row.want, strict=True):
            assert got == want, (row.base, got, want)
    one = df.select("base", F.explode("hrefs").alias("href")).select(
        resolve_url("base", "href").alias("got"), F.get(_resolve_steps(F.col("base"), F.array("href")), F.lit(0))["url"].alias("want")
    )
    assert one.filter(~F.col("got").eqNullSafe(F.col("want"))).count() == 0
    assert df.select(resolve_all("base", F.lit(None).cast("array<string>")).alias("x")).filter("x IS NOT NULL").count() == 0
