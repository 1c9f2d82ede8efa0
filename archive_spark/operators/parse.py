"""One pass over each page: from HTML to a flat row of texts, links and list entries.

``parse_pages`` is the only place where Python sees rows. It runs as ``mapInArrow``,
so a page is decoded once per scan however many columns are used later, and no
filter can be pushed through it and make it run twice. What to look for is data: a
profile per page kind. Everything after it is built-in expressions.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from itertools import accumulate, chain, pairwise

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The code below travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

META_ENTRY = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("list_id", T.IntegerType()),
        T.StructField("in_list", T.BooleanType()),
        T.StructField("is_label", T.BooleanType()),
        T.StructField("texts", T.ArrayType(T.StringType())),
    ]
)
_ARROW_META = pa.list_(
    pa.struct(
        [
            ("position", pa.int32()),
            ("list_id", pa.int32()),
            ("in_list", pa.bool_()),
            ("is_label", pa.bool_()),
            ("texts", pa.list_(pa.string())),
        ]
    )
)


@dataclass(frozen=True)
class El:
    """An element: its tag, a class it carries, or the exact class attribute."""

    tag: str
    cls: str | None = None
    attr: str | None = None
    child: bool = False


@dataclass(frozen=True)
class Rule:
    """What one output column takes from the elements reached by ``path``.

    ``take``: ``text`` = text nodes directly inside, ``inner`` = text nodes of the
    elements inside, otherwise the attribute of that name.
    """

    column: str
    path: tuple[El, ...]
    take: str
    many: bool = True


@dataclass(frozen=True)
class Profile:
    rules: tuple[Rule, ...]
    meta_list: str | None = None

    @property
    def columns(self) -> list[T.StructField]:
        texts = T.ArrayType(T.StringType())
        fields = [
            T.StructField(r.column, texts if r.many else T.StringType()) for r in self.rules
        ]
        if self.meta_list is not None:
            fields.append(T.StructField("meta", T.ArrayType(META_ENTRY)))
        return fields


# The elements and classes that carry the fields in the archive.
ARCHIVE_PROFILES = {
    "index": Profile(
        (
            Rule(
                "hrefs",
                (El("table", attr="broadcastindex"), El("td"), El("a", child=True)),
                "href",
            ),
        )
    ),
    "month": Profile(
        (
            Rule("evening_hrefs", (El("li", attr="elist_segment"), El("a", child=True)), "href"),
            Rule("special_hrefs", (El("li", attr="slist_segment"), El("a", child=True)), "href"),
        )
    ),
    "broadcast": Profile(
        (
            Rule("program_href", (El("p", "broadcast-info"), El("a")), "href", many=False),
            Rule("info", (El("p", "broadcast-info"),), "text", many=False),
            Rule("title", (El("h4", "video-title"),), "text", many=False),
            Rule("description", (El("div", "video-description"),), "inner"),
        ),
        meta_list="video-meta",
    ),
    "program": Profile(
        (
            Rule("headline", (El("h4", "program-headline"),), "text", many=False),
            Rule("duration_text", (El("p", "program-duration"),), "text", many=False),
            Rule("ids", (El("li", "listing"), El("p", "id"), El("em")), "text"),
            Rule("timestamps", (El("li", "listing"), El("p", "timestamp")), "text"),
            Rule("hrefs", (El("li", "listing"), El("a")), "href"),
        )
    ),
}

# Profile for pages of any other make: head line, title, navigation, article text.
GENERIC_PROFILE = Profile(
    (
        Rule("title", (El("title"),), "text", many=False),
        Rule("h1", (El("h1"),), "text", many=False),
        Rule("nav_hrefs", (El("nav"), El("li"), El("a", child=True)), "href"),
        Rule("nav_texts", (El("nav"), El("li"), El("a", child=True)), "text"),
        Rule("texts", (El("article"),), "inner"),
    )
)

_NAME = r"[a-zA-Z][\w:.-]*+"
_ATTRS = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_RAW = "|".join(
    rf"(?i:{tag})(?=[\s/>]){_ATTRS}>.*?(?:</(?i:{tag})\s*>|\Z)" for tag in ("script", "style")
)
# One group, so that ``split`` gives text and tags in turn.
_PIECES = re.compile(rf"(<(?:/{_NAME}[^<>]*+>|{_RAW}|{_NAME}{_ATTRS}>|!--.*?(?:-->|\Z)|[!?][^<>]*+>))", re.S)
_RAW_TAG = re.compile(
    rf"<(?P<raw>(?i:script|style))(?=[\s/>]){_ATTRS}>(?P<code>.*?)(?:</(?i:(?P=raw))\s*>|\Z)", re.S
)
_TAG = re.compile(rf"</?({_NAME})(.*)>\Z", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
# A named reference counts only with its semicolon, a numeric one without it too.
_REFERENCE = re.compile(r"&(?:#\d+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;)")

# Fixed values of HTML: elements without content, start tags that end an open
# paragraph, and elements that a stray end tag does not reach beyond.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_ENDS_P = frozenset(
    "address article aside blockquote center dd details dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table "
    "td th tr ul".split()
)
_ENTRIES = frozenset(("dt", "dd"))
_BARRIER = frozenset("html body table tbody thead tfoot tr td th div article nav".split())
# Start tag -> (open elements that it ends, where to stop looking).
_IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
}


# The commonest references, which need no search.
_COMMON = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": "\xa0"}


def _character(reference: re.Match) -> str:
    return _COMMON.get(reference[0]) or unescape(reference[0])


def _decode(text: str) -> str:
    return _REFERENCE.sub(_character, text) if "&" in text else text


# Tags and places kept from page to page; beyond, they are found anew.
KEPT = 20_000
# Kinds of tags.
_OTHER, _START, _END, _CODE = range(4)


class _Place:
    """A chain of open elements, shared by all pages that reach it.

    ``fits`` are the elements of the profile that the last one is, ``own`` and ``inner``
    name the lists that take its direct text and the text of elements inside it: a rule
    by its number, an entry of a definition list by its depth, negated. ``starts`` and
    ``ends`` keep where the tags met here lead.
    """

    __slots__ = ("above", "depth", "tag", "fits", "marked", "own", "inner", "starts", "ends")

    def __init__(self, above: _Place | None, tag: str, fits: frozenset, marked: bool):
        self.above, self.tag, self.fits, self.marked = above, tag, fits, marked
        self.depth = above.depth + 1 if above else 0
        self.inner = self.own = above.inner if above else ()
        self.starts: dict = {}
        self.ends: dict = {}


def _reaches(place: _Place, path: tuple[El, ...], step: int) -> bool:
    """Does the open element ``place`` end the path up to ``step``?"""
    if path[step] not in place.fits:
        return False
    if step == 0:
        return True
    above = place.above
    if path[step].child:
        return _reaches(above, path, step - 1)
    while above is not None:
        if _reaches(above, path, step - 1):
            return True
        above = above.above
    return False


def _close(place: _Place, tags: tuple[str, ...], stop: tuple | frozenset) -> _Place:
    at = place
    while at.depth:
        if at.tag in tags:
            return at.above
        if at.tag in stop:
            return place
        at = at.above
    return place


class PageParser:
    """Reads pages of one profile; prepared once and used for many pages.

    Where a tag leads depends only on the elements open before it, so it is worked out
    once for each such place and looked up after that. Pages that share a make cost
    little more than being cut into tags and texts.
    """

    def __init__(self, profile: Profile):
        self.profile = profile
        self.elements: dict[str, set[El]] = {}
        for rule in profile.rules:
            for el in rule.path:
                self.elements.setdefault(el.tag, set()).add(el)
        # Only these elements are asked for their attributes; values of some are taken.
        self.named = {*self.elements, *({"dl"} if profile.meta_list is not None else ())}
        self.taken = {r.take for r in profile.rules} - {"text", "inner"}
        self.valued = {r.path[-1].tag for r in profile.rules if r.take in self.taken}
        self.tags: dict[str, tuple] = {}
        self.shapes: dict[tuple, tuple] = {}
        self._forget()

    def _forget(self) -> None:
        self.root = _Place(None, "", frozenset(), False)
        self.places = 0

    def _shape(self, tag: str, cls: str | None) -> tuple:
        """The tag, the elements of the profile that it is, and if it is the marked-up list."""
        if (found := self.shapes.get((tag, cls))) is not None:
            return found
        fits = frozenset(
            el
            for el in self.elements.get(tag, ())
            if (cls == el.attr if el.attr is not None else el.cls is None or (cls is not None and el.cls in cls.split()))
        )
        marked = tag == "dl" and cls is not None and cls == self.profile.meta_list
        if len(self.shapes) >= KEPT:
            self.shapes.clear()
        found = self.shapes[tag, cls] = tag, fits, marked
        return found

    def _tag(self, text: str) -> tuple:
        """Kind of a tag with its name, or its shape and attributes, or its shape and code."""
        if text[1] in "!?":
            return _OTHER, None, None
        if text[1] == "/":
            found = _END, _TAG.match(text)[1].lower(), None
        elif text[1] in "sSſ" and (raw := _RAW_TAG.match(text)):
            return _CODE, self._shape(raw["raw"].lower(), None), raw["code"]
        else:
            name, raw_attrs = _TAG.match(text).groups()
            tag, attrs = name.lower(), {}
            if raw_attrs and tag in self.named:
                for key, double, single, bare in _ATTR.findall(raw_attrs):
                    attrs.setdefault(key.lower(), _decode(double or single or bare))
            found = _START, self._shape(tag, attrs.get("class")), attrs
            if tag in self.valued:
                return found
        if len(text) < 200:
            if len(self.tags) >= KEPT:
                self.tags.clear()
            self.tags[text] = found
        return found

    def _open(self, above: _Place, shape: tuple) -> tuple[_Place, tuple]:
        """The place inside a new element, and the attributes to take from its tag."""
        tag, fits, marked = shape
        place = _Place(above, tag, fits, marked)
        takes = []
        for number, rule in enumerate(self.profile.rules):
            if rule.path[-1].tag != tag or not _reaches(place, rule.path, len(rule.path) - 1):
                continue
            if rule.take == "text":
                place.own += (number,)
            elif rule.take != "inner":
                takes.append((number, rule.take))
            elif number not in place.inner:
                place.inner += (number,)
        if tag in _ENTRIES and self.profile.meta_list is not None:
            place.own += (-place.depth,)
            if tag == "dt":
                place.inner += (-place.depth,)
        self.places += 1 + len(place.own)
        return place, tuple(takes)

    def _start(self, place: _Place, shape: tuple) -> tuple[_Place, int, tuple, bool]:
        """Where a start tag leads, its depth, attributes to take, if it opens an entry."""
        tag, above = shape[0], place
        if tag in _ENDS_P:
            above = _close(above, ("p",), _BARRIER)
            if tag in _IMPLIED_END:
                above = _close(above, *_IMPLIED_END[tag])
        inside, takes = self._open(above, shape)
        entry = tag in _ENTRIES and self.profile.meta_list is not None
        after = above if tag in _VOID else inside
        move = place.starts[shape] = after, inside.depth, takes, entry
        return move

    def _end(self, place: _Place, tag: str) -> _Place:
        if place.depth and place.tag == tag:
            up = place.above
        else:
            up = _close(place, (tag,), () if tag in _BARRIER else _BARRIER)
        place.ends[tag] = up
        self.places += 1
        return up

    def read(self, pages: list[str]) -> tuple[list[list[str]], list[list[int]], tuple[list, ...]]:
        """Texts and attributes by rule, and definition list entries, in page order.

        The values of all pages stand in one list for each rule, and the entries in one list
        for each of their fields; the second result tells where each page begins in these.
        """
        found: list[list[str]] = [[] for _ in self.profile.rules]
        lists = dict(enumerate(found))
        entries: tuple[list, ...] = ([], [], [], [], [])
        positions, list_ids, in_list, labels, values = entries
        begins: list[list[int]] = [[0] for _ in range(len(found) + 1)]
        counted = [*zip(begins, [*found, values], strict=True)]
        split, tags = _PIECES.split, self.tags
        for html in pages:
            if self.places > KEPT:
                self._forget()
            place, serial, serials, first = self.root, 0, {0: 0}, len(values)
            pieces = iter(split(html))
            next(pieces)  # text before the first tag is in no element
            for tag, text in zip(pieces, pieces, strict=True):
                kind, what, more = tags.get(tag) or self._tag(tag)
                if kind == _START:
                    place, depth, takes, entry = place.starts.get(what) or self._start(place, what)
                    serial += 1
                    serials[depth] = serial
                    for number, name in takes:
                        if name in more:
                            found[number].append(more[name])
                    if entry:
                        texts = lists[-depth] = []
                        positions.append(len(values) - first)
                        list_ids.append(serials[depth - 1])
                        in_list.append(place.above.marked)
                        labels.append(what[0] == "dt")
                        values.append(texts)
                elif kind == _END:
                    place = place.ends.get(what) or self._end(place, what)
                elif kind == _CODE:
                    serial += 1
                    if more:
                        for number in self._open(place, what)[0].own:
                            lists[number].append(more)
                if text and place.own:
                    if "&" in text:
                        text = _decode(text)
                    for number in place.own:
                        lists[number].append(text)
            for begin, flat in counted:
                begin.append(len(flat))
        for i, label in enumerate(labels):
            if label and len(values[i]) != 1:
                values[i] = ["".join(values[i])]
        return found, begins, entries

    def __call__(self, html: str) -> dict[str, list]:
        """Values of one page by column, in page order."""
        found, _, entries = self.read([html])
        row = {
            rule.column: values if rule.many else next(iter(values), None)
            for rule, values in zip(self.profile.rules, found, strict=True)
        }
        if self.profile.meta_list is not None:
            row["meta"] = [dict(zip(META_ENTRY.names, e, strict=True)) for e in zip(*entries, strict=True)]
        return row

    def arrays(self, pages: list[str]) -> list[pa.Array]:
        """Arrow columns of the profile, one value for each page."""
        found, begins, entries = self.read(pages)
        columns = []
        for rule, values, begin in zip(self.profile.rules, found, begins, strict=False):
            if rule.many:
                columns.append(pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(values, pa.string())))
            else:
                first = [values[a] if a < b else None for a, b in pairwise(begin)]
                columns.append(pa.array(first, pa.string()))
        if self.profile.meta_list is not None:
            kinds = (pa.int32(), pa.int32(), pa.bool_(), pa.bool_())
            fields = [pa.array(e, kind) for e, kind in zip(entries, kinds, strict=False)]
            ends = pa.array(accumulate(map(len, entries[-1]), initial=0), pa.int32())
            fields.append(pa.ListArray.from_arrays(ends, pa.array([*chain.from_iterable(entries[-1])], pa.string())))
            values = pa.StructArray.from_arrays(fields, fields=list(_ARROW_META.value_type))
            columns.append(pa.ListArray.from_arrays(pa.array(begins[-1], pa.int32()), values))
        return columns


def parse_page(html: str, profile: Profile) -> dict[str, list]:
    return PageParser(profile)(html)


# Rows and bytes of HTML that are parsed and handed back at a time.
PART_ROWS, PART_BYTES = 500, 1 << 20


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch; one holds a single row, or stays within the limits."""
    start = held = 0
    for row, size in enumerate(pc.binary_length(batch[column]).to_pylist()):
        if row > start and (row - start >= PART_ROWS or held + (size or 0) > PART_BYTES):
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def parse_pages(pages: DataFrame, profile: Profile, keep: list[str] | None = None) -> DataFrame:
    """Replace ``html`` by the columns of ``profile``; ``keep`` names the others to carry.

    Narrow: no shuffle, and HTML ends here. A batch is parsed and handed back in small
    parts, so what Python holds beside it does not grow with the batch. A missing text or attribute is null, a
    missing list is empty.
    """
    keep = [c for c in (keep or pages.columns) if c != "html"]
    source = pages.select(*keep, "html")
    schema = T.StructType([source.schema[c] for c in keep] + profile.columns)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = PageParser(profile)
        for batch in batches:
            for part in _parts(batch, "html"):
                # bytes, so that text that is not valid UTF-8 is replaced, never raises
                bodies = part["html"].cast(pa.binary()).to_pylist()
                arrays = read.arrays([(html or b"").decode("utf-8", "replace") for html in bodies])
                yield pa.RecordBatch.from_arrays([*[part[c] for c in keep], *arrays], names=schema.names)

    return source.mapInArrow(parse, schema)


def parse_kinds(pages: DataFrame, profiles: dict[str, Profile], keep: list[str]) -> DataFrame:
    """``parse_pages`` for pages of several kinds in one pass, each by the profile of its ``page_kind``.

    Gives ``page_kind``, ``keep`` and the columns of all profiles, null for pages of a kind
    that has them not; a column that several profiles have must be of one type. Pages of
    other kinds are left out.
    """
    fields: dict[str, T.StructField] = {}
    for field in chain.from_iterable(profile.columns for profile in profiles.values()):
        if fields.setdefault(field.name, field) != field:
            raise ValueError(f"column {field.name!r} has several types")
    kept = ["page_kind", *keep]
    source = pages.filter(F.col("page_kind").isin(*profiles)).select(*kept, "html")
    schema = T.StructType([source.schema[c] for c in kept] + [*fields.values()])
    texts = {T.StringType(): pa.string(), T.ArrayType(T.StringType()): pa.list_(pa.string())}
    absent = {name: texts.get(field.dataType, _ARROW_META) for name, field in fields.items()}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = {kind: PageParser(profile) for kind, profile in profiles.items()}
        for batch in batches:
            for part in _parts(batch, "html"):
                for kind in pc.unique(part["page_kind"]).to_pylist():
                    rows = part.filter(pc.equal(part["page_kind"], kind))
                    bodies = rows["html"].cast(pa.binary()).to_pylist()
                    arrays = readers[kind].arrays([(html or b"").decode("utf-8", "replace") for html in bodies])
                    found = dict(zip((c.name for c in profiles[kind].columns), arrays, strict=True))
                    columns = [found[n] if n in found else pa.nulls(len(rows), absent[n]) for n in fields]
                    yield pa.RecordBatch.from_arrays([*[rows[c] for c in kept], *columns], names=schema.names)

    return source.mapInArrow(parse, schema)
