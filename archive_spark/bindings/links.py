"""Page parsing and link operators on the driver's pages and the rendered site."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import links as ln
from ..operators.dedup import listing_position
from ..operators.parse import GENERIC_PROFILE, parse_pages
from ..plans.crawl import parse_kind
from .registry import query, table
from .site import ORDERS_SQL, SITE, site_pages


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return parse_pages(table(spark, folder, "pages"), GENERIC_PROFILE)


def _nav_links(spark: SparkSession, folder: str) -> DataFrame:
    """Navigation links, alternately called evening and special."""
    found = ln.exploded_links(_parsed(spark, folder), "nav_hrefs", "broadcast", None)
    return found.withColumn("list", F.when(F.col("pos") % 2 == 0, "evening").otherwise("special"))


def _decoded(expression: str) -> str:
    return f"replace(replace({expression}, '&quot;', '\"'), '&amp;', '&')"


_NAV_HREFS = r"""regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), 'href="([^"]*)"', 1)"""
_NAV_TEXTS = r"regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'), '>([^<>]+)</a>', 1)"
_ROOT = r"regexp_extract(url, '^[^:]+://[^/]*')"

_LINKS_SQL = f"""
  SELECT src_url, href, {_ROOT.replace("url", "src_url", 1)} || href AS url, CAST(pos AS INTEGER) AS pos,
         CASE WHEN pos % 2 = 0 THEN 'evening' ELSE 'special' END AS list
  FROM (SELECT url AS src_url, {_decoded("unnest(hrefs)")} AS href,
               unnest(generate_series(0, len(hrefs) - 1)) AS pos
        FROM (SELECT url, {_NAV_HREFS} AS hrefs FROM pages))"""


@query(
    "parse_pages",
    f"""
    SELECT page_id, {_decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title,
           {_decoded("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS h1,
           {_decoded(f"array_to_string({_NAV_HREFS}, ' ')")} AS hrefs
    FROM pages
    """,
)
def _(spark, folder):
    return _parsed(spark, folder).select(
        "page_id", "title", "h1", F.array_join("nav_hrefs", " ").alias("hrefs")
    )


@query(
    "concat_text",
    r"""
    SELECT page_id, array_to_string(list_transform(
             regexp_extract_all(article, '>([^<>]+)', 1),
             lambda x: trim(replace(replace(x, '&quot;', '"'), '&amp;', '&'), E' \n\t\r')), '') AS text
    FROM (SELECT page_id, regexp_extract(html, '(?s)<article>.*</article>') AS article FROM pages)
    """,
)
def _(spark, folder):
    return _parsed(spark, folder).select("page_id", fn.concat_text("texts").alias("text"))


@query(
    "resolve_url",
    rf"""
    SELECT page_id, CASE page_id % 7
        WHEN 0 THEN {_ROOT} || '/top'
        WHEN 1 THEN regexp_extract(url, '^[^?#]*/') || 'side'
        WHEN 2 THEN regexp_extract(url, '^[^?#]*') || '?page=3'
        WHEN 3 THEN regexp_extract(url, '^[^#]*') || '#end'
        WHEN 4 THEN regexp_extract(url, '^[a-z]+:') || '//cdn.example.org/x'
        WHEN 5 THEN 'https://example.org/y'
        ELSE {_ROOT} || '/up' END AS resolved
    FROM pages
    """,
)
def _(spark, folder):
    hrefs = ["/top", "side", "?page=3", "#end", "//cdn.example.org/x", "https://example.org/y"]
    href = F.when(F.col("page_id") % 7 == 6, F.lit("./../../../up"))
    for i, text in enumerate(hrefs):
        href = href.when(F.col("page_id") % 7 == i, F.lit(text))
    return table(spark, folder, "pages").select(
        "page_id", fn.resolve_url("url", href).alias("resolved")
    )


@query(
    "host_filter",
    r"""
    SELECT src_url, href, url, pos FROM (
      SELECT *, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS host FROM ("""
    + _LINKS_SQL
    + r"""))
    WHERE host IN ('example.com', 'm.example.net') OR host LIKE '%.example.com'
       OR host LIKE '%.m.example.net'
    """,
)
def _(spark, folder):
    hosts = ["example.com", "M.example.net"]
    return ln.host_filter(_nav_links(spark, folder), hosts).select("src_url", "href", "url", "pos")


@query("tag_and_union", f"SELECT src_url, href, list FROM ({_LINKS_SQL})")
def _(spark, folder):
    found = _nav_links(spark, folder)
    evening = found.filter("list = 'evening'").drop("list")
    special = found.filter("list = 'special'").drop("list")
    return ln.tag_and_union(evening, special).select("src_url", "href", "list")


@query(
    "distinct_requests",
    f"""
    SELECT url, list, src_url, pos FROM (
      SELECT *, row_number() OVER (PARTITION BY url ORDER BY list, src_url, pos) AS r
      FROM (SELECT src_url, '{SITE}' || href AS url, list, pos FROM ({_LINKS_SQL})))
    WHERE r = 1
    """,
)
def _(spark, folder):
    on_one_site = _nav_links(spark, folder).withColumn("url", F.concat(F.lit(SITE), "href"))
    return ln.distinct_requests(on_one_site).select("url", "list", "src_url", "pos")


@query(
    "listing_position",
    f"SELECT src_url, pos, href AS item FROM ({_LINKS_SQL})",
)
def _(spark, folder):
    parsed = _parsed(spark, folder).withColumnRenamed("url", "src_url")
    return listing_position(parsed, "nav_hrefs", "src_url")


@query(
    "program_link",
    f"""SELECT src_url, href, url FROM ({_LINKS_SQL}) WHERE pos = 0""",
)
def _(spark, folder):
    first = F.get("nav_hrefs", F.lit(0)).alias("program_href")
    found = ln.program_link(_parsed(spark, folder).select("url", first))
    return found.select("src_url", "href", "url")


@query(
    "program_listing",
    f"""
    SELECT url AS src_url, CAST(pos - 1 AS INTEGER) AS pos, {_decoded("ids[pos]")} AS broadcast_id,
           {_decoded("times[pos]")} AS broadcast_time, {_decoded("hrefs[pos]")} AS href
    FROM (SELECT *, unnest(generate_series(1, least(len(ids), len(times), len(hrefs)))) AS pos
          FROM (SELECT url, {_NAV_TEXTS} AS ids, {_NAV_HREFS} AS hrefs,
                       {_NAV_TEXTS}[3:] AS times FROM pages))
    """,
)
def _(spark, folder):
    parsed = _parsed(spark, folder).select(
        "url",
        F.col("nav_texts").alias("ids"),
        F.slice("nav_texts", 3, F.greatest(F.size("nav_texts") - 2, F.lit(0))).alias("timestamps"),
        F.col("nav_hrefs").alias("hrefs"),
    )
    return ln.program_listing(parsed).select(
        "src_url", "pos", "broadcast_id", "broadcast_time", "href"
    )


@query(
    "month_links",
    f"""
    SELECT '{SITE}/siteindex/' || k || '/' AS src_url, '/months/k-' || k || '/' || ym AS href,
           '{SITE}/months/k-' || k || '/' || ym AS url
    FROM ({ORDERS_SQL})
    """,
)
def _(spark, folder):
    parsed = parse_kind(site_pages(spark, folder, "index"), "index")
    return ln.month_links(parsed).select("src_url", "href", "url")


_SEGMENT_LINKS_SQL = f"""
    SELECT src_url, list, url FROM (
      SELECT '{SITE}/months/k-' || k || '/' || ym AS src_url, 'evening' AS list,
             unnest(list_concat(
               list_transform(generate_series(1, n), lambda i: '{SITE}/broadcasts/' || k || i),
               ['{SITE}/broadcasts/' || k || '1#again', 'https://other.example.com/broadcasts/1']
             )) AS url, k
      FROM ({ORDERS_SQL})
      UNION ALL
      SELECT '{SITE}/months/k-' || k || '/' || ym, 'special', '{SITE}/broadcasts/' || k || '9', k
      FROM ({ORDERS_SQL}) WHERE k % 4 = 0)
    WHERE k % 50 <> 7"""


@query("segment_links", _SEGMENT_LINKS_SQL)
def _(spark, folder):
    parsed = parse_kind(site_pages(spark, folder, "month"), "month")
    return ln.segment_links(parsed).select("src_url", "list", "url")


@query(
    "hop",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def _(spark, folder):
    site = F.lit("https://news.example.org/programs/")
    followed = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        fn.url_key(F.concat(site, F.col("l_orderkey"), F.lit("#x"))).alias("url_key"),
    )
    landed = (
        table(spark, folder, "orders")
        .select(F.concat(site, F.col("o_orderkey")).alias("url_key"), "o_custkey", "o_orderpriority")
    )
    return ln.hop(followed, landed).drop("url_key")
