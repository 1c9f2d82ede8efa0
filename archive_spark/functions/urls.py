"""URL scalars: resolving, keys, ids and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._column import as_column
from .text import SPACE_CLASS

_HTML_SPACES = "\t\n\x0c\r "


def _without_dot_segments(path: Column) -> Column:
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, part: F.when(
            part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        )
        .when(part == ".", done)
        .otherwise(F.concat(done, F.array(part))),
    )
    closing = F.when(path.rlike(r"/\.{1,2}\z"), "/").otherwise("")
    return F.regexp_replace(F.concat(F.array_join(kept, "/"), closing), r"\A(?!/)", "/")


def _is_plain(text: Column) -> Column:
    """A path from the root without dot segments, query and fragment; false for null."""
    other = text.startswith("//") | text.contains("/.") | text.contains("?") | text.contains("#")
    return F.coalesce(text.startswith("/") & ~other, F.lit(False))


def _upper(base: Column) -> Column:
    """The folder above that of a page without empty or dotted parts in its path; null for others."""
    part = r"/[^/?#.\s][^/?#\s]*"
    found = F.regexp_extract(base, rf"\A([^:/?#]+://[^/?#]*(?:{part})*?/){part[1:]}/[^/?#.\s][^/?#\s]*\z", 1)
    return F.nullif(found, F.lit(""))


def _is_bare_above(href: Column) -> Column:
    """``../`` and a path without dotted or empty parts, query, fragment and white space at its end."""
    rest = href.substr(F.lit(3), F.length(href))
    return href.startswith("../") & (F.length(href) > 3) & ~rest.contains("//") & _is_bare(rest)


def _root(base: Column) -> Column:
    return F.regexp_extract(base, r"\A([^:/?#]+://[^/?#]*)", 1)


def _is_bare(href: Column) -> Column:
    """A plain path without white space at its end, so that only the root is put before it."""
    spaced = F.lit(False)
    for space in _HTML_SPACES:
        spaced = spaced | href.endswith(space)
    return _is_plain(href) & ~spaced


def resolve_all(base: Column | str, hrefs: Column | str) -> Column:
    """Array of structs ``href`` and absolute ``url`` for the hrefs of the page ``base``.

    A plain path from the root, the commonest href, is put behind the root of the base, and
    one from the folder above behind that folder, which are found once for all hrefs; any
    other href goes through ``_resolve_steps``.
    """
    base = as_column(base)
    page = F.array(
        F.struct(_root(base).alias("root"), _upper(base).alias("upper"), as_column(hrefs).alias("hrefs"))
    )
    resolved = F.transform(
        page,
        lambda p: F.transform(
            p["hrefs"],
            lambda href: F.struct(
                href.alias("href"),
                F.when(_is_bare(href), F.concat(p["root"], href))
                .when(
                    p["upper"].isNotNull() & _is_bare_above(href),
                    F.concat(p["upper"], href.substr(F.lit(4), F.length(href))),
                )
                .otherwise(F.get(_resolve_steps(base, F.array(href)), F.lit(0))["url"])
                .alias("url"),
            ),
        ),
    )
    return F.get(resolved, F.lit(0))


def _resolve_steps(base: Column, hrefs: Column) -> Column:
    """``resolve_all`` for hrefs of any form.

    Each step is an array of its own, so that no part is computed more than once.
    """
    trimmed = F.transform(
        hrefs,
        lambda href: F.struct(href.alias("href"), F.btrim(href, F.lit(_HTML_SPACES)).alias("text")),
    )
    parts = F.transform(
        trimmed,
        lambda e: F.struct(
            e["href"].alias("href"),
            e["text"].alias("text"),
            _is_plain(e["text"]).alias("plain"),
            _root(base).alias("root"),
        ),
    )
    parts = F.transform(
        parts,
        lambda e: F.struct(
            e["href"].alias("href"),
            e["text"].alias("text"),
            e["plain"].alias("plain"),
            e["root"].alias("root"),
            F.when(e["plain"], e["text"])
            .otherwise(F.regexp_extract(e["text"], r"\A([^?#]*)", 1))
            .alias("path"),
            F.when(~e["plain"], F.regexp_extract(base, r"\A[^:/?#]+://[^/?#]*([^?#]*)", 1)).alias("base_path"),
        ),
    )
    paths = F.transform(
        parts,
        lambda e: F.struct(
            e["href"].alias("href"),
            e["text"].alias("text"),
            e["plain"].alias("plain"),
            e["root"].alias("root"),
            e["base_path"].alias("base_path"),
            F.when(e["path"].startswith("/"), e["path"])
            .otherwise(
                F.regexp_replace(
                    F.concat(
                        F.regexp_replace(e["base_path"], r"[^/]*\z", ""), F.lit("/"), e["path"]
                    ),
                    "/{2,}",
                    "/",
                )
            )
            .alias("path"),
        ),
    )
    return F.transform(
        paths,
        lambda e: F.struct(
            e["href"].alias("href"),
            F.when(e["plain"], F.concat(e["root"], e["text"]))
            .when(e["text"] == "", base)
            .when(e["text"].rlike(r"\A[A-Za-z][A-Za-z0-9+.\-]*:"), e["text"])
            .when(
                e["text"].startswith("//"),
                F.concat(F.regexp_extract(base, r"\A([^:/?#]+:)", 1), e["text"]),
            )
            .when(
                e["text"].startswith("#"),
                F.concat(F.regexp_replace(base, r"(?s)#.*", ""), e["text"]),
            )
            .when(e["text"].startswith("?"), F.concat(e["root"], e["base_path"], e["text"]))
            .when(
                e["text"].isNotNull(),
                F.concat(
                    e["root"],
                    F.when(
                        e["path"].rlike(r"/\.{1,2}(/|\z)"), _without_dot_segments(e["path"])
                    ).otherwise(e["path"]),
                    F.regexp_extract(e["text"], r"(?s)\A[^?#]*([?#].*)\z", 1),
                ),
            )
            .alias("url"),
        ),
    )


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute URL of ``href`` found on the page ``base``; null stays null."""
    base, href = as_column(base), as_column(href)
    other = F.get(_resolve_steps(base, F.array(href)), F.lit(0))["url"]
    return F.when(_is_bare(href), F.concat(_root(base), href)).otherwise(other)


def url_key(url: Column | str) -> Column:
    """URL without fragment and with sorted query: equal keys are one request."""
    url = as_column(url)
    plain = F.regexp_replace(url, r"(?s)#.*", "")
    query = F.regexp_extract(plain, r"(?s)\?(.*)\z", 1)
    sorted_query = F.array_join(F.array_sort(F.split(query, "&")), "&")
    return F.when(~url.contains("#") & ~url.contains("&"), url).when(
        query.contains("&"),
        F.concat(F.regexp_extract(plain, r"\A([^?]*)", 1), F.lit("?"), sorted_query),
    ).otherwise(plain)


def host_of(url: Column | str) -> Column:
    """Lower-case host name, empty where the URL has none."""
    return F.lower(
        F.regexp_extract(as_column(url), r"\A[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    )


def id_from_url(url: Column | str) -> Column:
    """Whole number in the last path part, null for anything else."""
    digits = F.regexp_extract(
        as_column(url), rf"(?:\A|/){SPACE_CLASS}*([+-]?\d+(?:_\d+)*){SPACE_CLASS}*\z", 1
    )
    return F.replace(digits, F.lit("_"), F.lit("")).try_cast("bigint")


def page_slug(url: Column | str) -> Column:
    """Second last part of a URL, ``index`` where it is empty."""
    part = F.try_element_at(F.split(as_column(url), "/"), F.lit(-2))
    return F.coalesce(F.nullif(part, F.lit("")), F.lit("index"))


def page_file_name(kind: Column | str, page_id: Column | str) -> Column:
    """Name of a stored page; ``kind`` is a page kind such as ``broadcast`` or a column."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(kind, F.lit("s/"), as_column(page_id).cast("string"), F.lit(".html.gz"))
