"""Benchmark passages in documents: SimHash of item-sized windows, then exact verification.

Windows of a few sizes slide over the words of every document in steps of a fraction of
their size; a benchmark item is looked for in the windows nearest to its own size, a longer one than
the longest window by each of its consecutive segments. The fingerprint of a window has the signs of 64 sums over its word pairs. Item fingerprints are
indexed in four blocks of 16 bits: two fingerprints that differ in at most ``RADIUS`` bits
differ in at most a fourth of these in some block, and each block lists the items at all
values that near. So no fingerprint within the radius is missed. What is found is compared
with the words themselves, by weighted 5-word shingles. Items shorter than the least window
are looked up by their shingles instead.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .text import PLAIN, Words, batch_of, chained, pieces, shingles, small, utf8, values

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 15
BLOCKS, BLOCK_BITS = 4, 16
SIZE_RATIO = 1.12
STEPS = 10
LEAST_WINDOW = 8
LONGEST_WINDOW = 256
ITEMS_AT_ONCE = 5_000

FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("first_word", pa.int64()),
        ("n_words", pa.int64()),
        ("hamming", pa.int64()),
        ("similarity", pa.float64()),
    ]
)
FOUND_DDL = (
    "doc_id long, item_id long, first_word long, n_words long, hamming long, similarity double"
)


def nearby(bits: int, radius: int) -> np.ndarray:
    """All values of ``bits`` bits with at most ``radius`` of them set."""
    return np.array(
        [sum(1 << b for b in at) for n in range(radius + 1) for at in combinations(range(bits), n)],
        np.int64,
    )


def window_size(words: int) -> int:
    """The size out of a fixed geometric row that is nearest to a number of words."""
    step = max(0, round(math.log(max(words, 1) / LEAST_WINDOW) / math.log(SIZE_RATIO)))
    return min(LONGEST_WINDOW, round(LEAST_WINDOW * SIZE_RATIO**step))


def segments(words: int) -> list[tuple[int, int]]:
    """Start and size of the fewest even segments of at most ``LONGEST_WINDOW`` words."""
    parts = -(-words // LONGEST_WINDOW)
    cuts = [words * k // parts for k in range(parts + 1)] if parts else []
    return [(low, high - low) for low, high in zip(cuts, cuts[1:])]


# Each bit of a byte as a byte of its own, so that eight counts run in one 64-bit integer.
SPREAD = np.array(
    [sum(1 << (8 * k) for k in range(8) if byte >> k & 1) for byte in range(256)], np.uint64
)


def bit_sums(words: Words) -> np.ndarray:
    """Running counts of each of 64 bits over the word pairs of a run of texts.

    Eight rows of eight counts packed into an integer. Counts run over into each other, but
    the difference of two places is exact while each bit is set less than 256 times between
    them, which windows of so many pairs ensure.
    """
    h = words.h
    pairs = chained(h[:-1], h[1:]) if len(h) > 1 else np.zeros(0, np.uint64)
    sums = np.zeros((8, len(pairs) + 1), np.uint64)
    np.cumsum(SPREAD[pairs.view(np.uint8).reshape(-1, 8).T], axis=1, out=sums[:, 1:])
    return sums


def fingerprints(sums: np.ndarray, start: int, step: int, pairs: int) -> np.ndarray:
    """SimHash of the windows of ``pairs`` word pairs at ``start``, ``start + step``, ..."""
    if pairs >= LONGEST_WINDOW:
        raise ValueError("windows are too long for their counts")
    ahead = sums[:, start + pairs :: step]
    counts = ahead - sums[:, start::step][:, : ahead.shape[1]]
    signs = np.packbits((counts.view(np.uint8) > pairs // 2).ravel(), bitorder="little")
    return np.ascontiguousarray(signs.reshape(8, -1).T).view(np.uint64).ravel()


class Items:
    """Benchmark items of a bounded number, indexed by window size and block value.

    An item has a fingerprint for each of its segments; ``item`` has the item of a
    fingerprint, ``offset`` the words of the item before its segment. Weights follow
    ``total``, the number of all items, and ``seen``, which tells how many of them have each
    of the given shingles; without these the rows are all items.
    """

    def __init__(
        self,
        rows: list[tuple[int, bytes]],
        radius: int,
        total: int | None = None,
        seen: Callable[[np.ndarray], np.ndarray] | None = None,
    ):
        self.ids = [i for i, _ in rows]
        self.radius = radius
        plain = [t.translate(PLAIN) for _, t in rows]
        words = Words(plain)
        runs, doc = shingles(words, SHINGLE)
        cuts = np.searchsorted(doc, np.arange(1, len(rows)))
        self.shingles = [np.unique(s) for s in np.split(runs, cuts)] if rows else []
        own, many = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.shingles]), return_counts=True)
        if seen:
            many = seen(own)
        rarity = np.log(1 + (len(rows) if total is None else total) / np.maximum(many, 1))
        self.weights = [rarity[np.searchsorted(own, s)] for s in self.shingles]
        self.count = words.count
        sums = bit_sums(words)
        prints, self.item, self.offset = [], [], []
        by_size: dict[int, list[int]] = {}
        for k, (first, count) in enumerate(zip(words.first.tolist(), words.count.tolist())):
            for low, n in segments(count) if count >= LEAST_WINDOW else ():
                window = sums[:, first + low : first + low + n]
                for near in {window_size(n), window_size(round(n * 1.06)), window_size(round(n / 1.06))}:
                    by_size.setdefault(near, []).append(len(prints))
                prints.append(fingerprints(window, 0, 1, n - 1)[0])
                self.item.append(k)
                self.offset.append(low)
        self.prints = np.array(prints, np.uint64)
        self.short = self.runs_of_short(words)
        self.index = {size: self.blocks(np.array(own)) for size, own in sorted(by_size.items())}

    def runs_of_short(self, words: Words) -> dict[int, tuple[np.ndarray, ...]]:
        """By length: sorted hashes of the runs of items below the least window, item, offset."""
        runs: dict[int, list[tuple[int, int, int]]] = {}
        for k in np.flatnonzero((words.count > 0) & (words.count < LEAST_WINDOW)).tolist():
            first, n = int(words.first[k]), int(words.count[k])
            length = min(n, SHINGLE)
            for at in range(n - length + 1):
                part = words.h[first + at : first + at + length]
                runs.setdefault(length, []).append((int(chained(*part.reshape(-1, 1))[0]), k, at))
        return {
            length: tuple(np.array(x, t) for x, t in zip(zip(*sorted(own)), (np.uint64, np.int64, np.int64)))
            for length, own in runs.items()
        }

    def blocks(self, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each block: where the items of a value begin, and the items by value."""
        around = nearby(BLOCK_BITS, self.radius // BLOCKS)
        tables = []
        for b in range(BLOCKS):
            value = (self.prints[own] >> np.uint64(b * BLOCK_BITS)).astype(np.int64) & 0xFFFF
            reached = (value[:, None] ^ around[None, :]).ravel()
            item = np.repeat(own, len(around))
            order = np.argsort(reached, kind="stable")
            starts = np.searchsorted(reached[order], np.arange((1 << BLOCK_BITS) + 1))
            tables.append((starts.astype(np.int32), item[order].astype(np.int32)))
        return tables

    def near(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, fingerprint, distance) of all pairs within the radius, some more than once."""
        found = [(np.zeros(0, np.int64),) * 3]
        for b, (starts, items) in enumerate(self.index[size]):
            value = prints.view(np.uint16)[b::BLOCKS]
            low = starts[value]
            many = starts[1:][value] - low
            some = np.flatnonzero(many)
            if not len(some):
                continue
            low, many = low[some], many[some]
            window = np.repeat(some, many)
            item = items[np.arange(len(window)) + np.repeat(low - np.cumsum(many) + many, many)]
            distance = np.bitwise_count(prints[window] ^ self.prints[item])
            keep = distance <= self.radius
            found.append((window[keep], item[keep], distance[keep].astype(np.int64)))
        return tuple(np.concatenate(x) for x in zip(*found))

    def similarity(self, item: int, present: np.ndarray) -> float:
        """Weight of the item's shingles that are present, as a share of all."""
        weights = self.weights[item]
        if not len(weights):
            return 0.0
        return float(weights[np.isin(self.shingles[item], present)].sum() / weights.sum())


def _present(part: np.ndarray) -> np.ndarray:
    """The shingles of some words, or the one of all if they are fewer."""
    n = len(part) - SHINGLE + 1
    return chained(*(part[j : n + j] for j in range(SHINGLE))) if n > 0 else chained(*part.reshape(-1, 1))


def _short(words: Words, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, first word, end) where a run of an item below the least window stands."""
    for length, (known, item, offset) in items.short.items():
        n = len(words.h) - length + 1
        if n <= 0:
            continue
        runs = chained(*(words.h[j : n + j] for j in range(length)))
        low = np.searchsorted(known, runs)
        hit = (known[np.minimum(low, len(known) - 1)] == runs) & (words.doc[:n] == words.doc[length - 1 :])
        at = np.flatnonzero(hit)
        low = low[at]
        many = np.searchsorted(known, runs[at], side="right") - low
        place = np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)
        at, k = np.repeat(at, many), item[place]
        found = np.stack([words.doc[at], k, at - offset[place]])
        if length < SHINGLE:
            # Such a run is the whole item: the first place in a document is as good as any.
            found = found[:, np.unique(found[:2], axis=1, return_index=True)[1]]
        else:
            found = np.unique(found, axis=1)
        for doc, k, first in found.T.tolist():
            count, begin = int(items.count[k]), int(words.first[doc])
            margin = count // 4 + 2 if length == SHINGLE else 0
            end = begin + int(words.count[doc])
            yield doc, k, max(first - margin, begin), min(first + count + margin, end)


def _search(texts: list[bytes], items: Items, threshold: float) -> list[tuple]:
    """(document, item, first word, words, distance, similarity), the best of each two."""
    words = Words([t.translate(PLAIN) for t in texts])
    total = len(words.h)
    if not total:
        return []
    best: dict[tuple[int, int], tuple] = {}
    for doc, k, s, e in _short(words, items):
        same = items.similarity(k, _present(words.h[s:e]))
        if same >= threshold and same > best.get((doc, k), (0,) * 6)[5]:
            best[doc, k] = (doc, k, s - int(words.first[doc]), e - s, None, same)
    longest = max(items.index, default=0)
    sums = bit_sums(words)
    sums = np.pad(sums, ((0, 0), (longest, longest)), "edge")
    for size in items.index:
        step = max(1, size // STEPS)
        start = longest - size
        prints = fingerprints(sums, start, step, max(size - 1, 1))
        window, segment, distance = items.near(size, prints)
        tried = set()
        for w, g, d in sorted(zip(window.tolist(), segment.tolist(), distance.tolist()), key=lambda x: x[2]):
            first = start + w * step - longest
            k, before = items.item[g], items.offset[g]
            count = int(items.count[k])
            after = max(0, count - before - size)
            # Damage between segments shifts where an item seems to begin, so more of these
            # places are tried for items of several segments.
            margin = (size if count <= LONGEST_WINDOW else count) // 4 + 2
            apart = margin + 1 if count <= LONGEST_WINDOW else margin // 4 + 1
            low = min(max(first, 0), total - 1)
            high = min(max(first + size, 1), total)
            for doc in np.unique(words.doc[low:high]).tolist():
                if (doc, k, (low - before) // apart) in tried:
                    continue
                tried.add((doc, k, (low - before) // apart))
                begin = int(words.first[doc])
                s = max(low - before - margin, begin)
                e = min(high + after + margin, begin + int(words.count[doc]))
                same = items.similarity(k, _present(words.h[s:e]))
                row = (doc, k, s - begin, e - s, d, same)
                if same >= threshold and same > best.get((doc, k), (0,) * 6)[5]:
                    best[doc, k] = row
    return [best[x] for x in sorted(best)]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
    items_at_once: int = ITEMS_AT_ONCE,
) -> DataFrame:
    """One row for each document and benchmark item that it holds.

    Words are runs of letters, digits and characters beyond ASCII, in small letters. An item
    is held if a stretch somewhat longer than the window has ``threshold`` or more of the
    item's 5-word shingles, weighted by their rarity in the benchmark; an item of 1 to 4
    words has one shingle of all its words, which is found wherever they stand in this order.
    ``first_word`` and ``n_words`` give that stretch. Items of less than 8 words are looked
    up by their shingles, without fingerprints, and have no ``hamming``.

    An item longer than the longest window is looked for by each of its segments, and the
    stretch around the whole of it is compared. Items are searched for in groups of at most ``items_at_once``, whose index is the only
    thing sent to all workers; more items mean more passes over the documents, and how many
    items have a shingle is then counted once in a scratch table. Missing and
    empty texts hold nothing, repeated rows are searched each, items without words or id are
    left out, an empty table on either side gives no rows. Columns other than doc_id,
    item_id and text are not looked at.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")

    def found_of(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in small(batches):
                texts = utf8(batch, "text")
                ids = values(batch, "doc_id")
                out = []
                for piece in pieces(texts):
                    for doc, k, *rest in _search(texts[piece], items, threshold):
                        out.append((ids[piece.start + doc], items.ids[k], *rest))
                if out:
                    yield batch_of(FOUND, zip(*out))

        return rows.mapInArrow(run, FOUND_DDL)

    groups = _item_groups(benchmark, radius, items_at_once)
    return reduce(DataFrame.unionByName, (found_of(shared) for shared in groups))


def _item_groups(benchmark: DataFrame, radius: int, items_at_once: int) -> Iterator:
    """Broadcast indexes of at most ``items_at_once`` items; one of none for no items.

    The rarity of a shingle is that in all items, whatever the groups are.
    """
    context = benchmark.sparkSession.sparkContext
    known = benchmark.filter("item_id is not null and text is not null")
    known = known.select(benchmark["item_id"].cast("long").alias("item_id"), "text")
    total, seen = known.count(), None
    if total > items_at_once:
        repeated = materialize(_repeated_shingles(known), "benchmark_shingles")

        def seen(own: np.ndarray) -> np.ndarray:
            return _items_with(repeated, own)

    group: list[tuple[int, bytes]] = []
    sent = False
    for row in known.toLocalIterator():
        group.append((row["item_id"], row["text"].encode()))
        if len(group) == items_at_once:
            yield context.broadcast(Items(group, radius, total, seen))
            group, sent = [], True
    if group or not sent:
        yield context.broadcast(Items(group, radius, total, seen))


def _repeated_shingles(known: DataFrame) -> DataFrame:
    """The shingles of two items or more, with the number of their items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = utf8(batch, "text")
            for piece in pieces(texts):
                runs, item = shingles(Words([t.translate(PLAIN) for t in texts[piece]]), SHINGLE)
                order = np.lexsort((runs, item))
                runs, item = runs[order], item[order]
                new = np.ones(len(runs), bool)
                new[1:] = (runs[1:] != runs[:-1]) | (item[1:] != item[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(runs[new].view(np.int64))], ["shingle"])

    counts = known.select("text").mapInArrow(run, "shingle long").groupBy("shingle")
    return counts.agg(F.count("*").alias("items")).filter("items > 1")


def _items_with(repeated: DataFrame, own: np.ndarray) -> np.ndarray:
    """The number of items with each of the given sorted shingles, each of which some item has."""
    asked = repeated.sparkSession.createDataFrame(pa.table({"shingle": own.view(np.int64)}))
    found = repeated.join(F.broadcast(asked), "shingle").toArrow()
    many = np.ones(len(own), np.int64)
    at = found["shingle"].to_numpy().view(np.uint64)
    many[np.searchsorted(own, at)] = found["items"].to_numpy()
    return many


def without_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
    items_at_once: int = ITEMS_AT_ONCE,
) -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item; nothing is shuffled.

    Documents are marked by every group and left out at the end, so that each group sees the
    same runs of documents, and with them the same windows.
    """
    mark = "_held"
    while mark in docs.columns:
        mark += "_"

    def marked(rows: DataFrame, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in small(batches):
                texts = utf8(batch, "text")
                held = np.array(values(batch, mark), bool)
                for piece in pieces(texts):
                    for doc, *_ in _search(texts[piece], shared.value, threshold):
                        held[piece.start + doc] = True
                at = batch.schema.get_field_index(mark)
                yield batch.set_column(at, batch.schema.field(at), pa.array(held))

        return rows.mapInArrow(run, rows.schema)

    rows = docs.withColumn(mark, F.lit(False))
    rows = reduce(marked, _item_groups(benchmark, radius, items_at_once), rows)
    return rows.filter(~F.col(mark)).drop(mark)
