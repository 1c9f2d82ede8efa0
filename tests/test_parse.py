"""What the page parser takes from sound and from broken HTML."""

import pyarrow as pa
import pytest

from archive_spark.operators import parse
from archive_spark.operators.parse import (
    ARCHIVE_PROFILES,
    GENERIC_PROFILE,
    El,
    PageParser,
    Profile,
    Rule,
    _parts,
    parse_page,
    parse_pages,
)


def values(html, *path, take="text"):
    return parse_page(html, Profile((Rule("v", path, take),)))["v"]


@pytest.mark.parametrize(
    ("html", "path", "expected"),
    [
        ("<p class='a b'>x</p>", (El("p", "b"),), ["x"]),
        ("<p class='a b'>x</p>", (El("p", attr="b"),), []),
        ("<P CLASS=b>x</P>", (El("p", attr="b"),), ["x"]),
        ("<p>one<p>two", (El("p"),), ["one", "two"]),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul>", (El("ul"), El("li", child=True)), ["a", "b", "c", "d"]),
        ("<p>a<br>b<!-- c -->d</p>", (El("p"),), ["a", "b", "d"]),
        ("<p>a<b>c</b>d</p>", (El("p"),), ["a", "d"]),
        ("<div><p>a</div>b", (El("p"),), ["a"]),
        ("<p>a</i>b</p>", (El("p"),), ["a", "b"]),
        ("<script>'<p>no</p>'</script><p>yes</p>", (El("p"),), ["yes"]),
        ("<p>a &amp; b &lt; &#233;&#xe9; &nbsp</p>", (El("p"),), ["a & b < éé &nbsp"]),
        ("<p>&amp;nbsp; 1 < 2</p>", (El("p"),), ["&nbsp; 1 < 2"]),
        ("<td>a<td>b<tr><td>c", (El("td"),), ["a", "b", "c"]),
        ("<p title='a>b'>x", (El("p"),), ["x"]),
        ("", (El("p"),), []),
    ],
)
def test_text(html, path, expected):
    assert values(html, *path) == expected


def test_inner_text_leaves_out_direct_text():
    html = "<div class=d>skip<p>a<b>c</b></p>skip<div class=d>e<i>f</i></div></div>g"
    assert values(html, El("div", "d"), take="inner") == ["a", "c", "e", "f"]


def test_attributes_and_paths():
    html = '<table class="t"><tr><td><a href="1&amp;2">x</a><p><a href=no>y</a><td><a>z</a></table>'
    path = (El("table", attr="t"), El("td"), El("a", child=True))
    assert values(html, *path, take="href") == ["1&2"]


def test_broken_definition_list():
    html = (
        '<dl class="video-meta"><dt>Duration:<dd>00:01</dl><dt>Reporter(s):</dt><dd>A<b>x</b>B<dd>C'
    )
    meta = parse_page(html, ARCHIVE_PROFILES["broadcast"])["meta"]
    assert [(m["is_label"], m["in_list"], m["texts"]) for m in meta] == [
        (True, True, ["Duration:"]),
        (False, True, ["00:01"]),
        (True, False, ["Reporter(s):"]),
        (False, False, ["A", "B"]),
        (False, False, ["C"]),
    ]


@pytest.mark.parametrize("piece", ["<a", '<a "', "<!--", "<script>", "<p><b>", "<dd>", "<td>x", "&#"])
def test_hostile_pages_stay_cheap(piece):
    parse_page(piece * 5000, GENERIC_PROFILE)


def test_parse_pages_on_spark(spark):
    pages = spark.createDataFrame([(1, "<h1>a</h1>"), (2, None)], "page_id long, html string")
    rows = parse_pages(pages, GENERIC_PROFILE).orderBy("page_id").collect()
    assert [(r["page_id"], r["h1"], r["nav_hrefs"]) for r in rows] == [(1, "a", []), (2, None, [])]


def test_a_place_met_before_is_not_worked_out_again():
    read = PageParser(ARCHIVE_PROFILES["program"])
    page = '<ul><li class="listing"><p class="id"><em>{0}</em></p><a href="/b/{0}">x</a></ul>'
    read.read([page.format(0)])
    places = read.places
    found, begins, _ = read.read([page.format(i) for i in range(50)])
    assert read.places == places
    assert found[4] == [f"/b/{i}" for i in range(50)] and begins[4] == list(range(51))


def test_what_is_kept_between_pages_is_bounded(monkeypatch):
    monkeypatch.setattr(parse, "KEPT", 20)
    read = PageParser(ARCHIVE_PROFILES["broadcast"])
    pages = [f'<dl class="video-meta"><x{i}><dt class="c{i}">a{i}<dd>b</x{i}></dl>' for i in range(200)]
    _, begins, entries = read.read(pages)
    assert max(read.places, len(read.tags), len(read.shapes)) <= 40
    assert begins[-1] == list(range(0, 401, 2)) and entries[-1][398:] == [["a199"], ["b"]]


def test_a_batch_is_handed_back_in_parts():
    html = ["x" * 300_000] * 7 + [None, "y" * 3_000_000] + ["z"] * 1200
    parts = [*_parts(pa.record_batch({"html": html}), "html")]
    assert [v for p in parts for v in p["html"].to_pylist()] == html
    assert all(p.num_rows == 1 or (p.num_rows <= 500 and p["html"].nbytes < 1.1 * (1 << 20)) for p in parts)
    assert len(parts) < 10
