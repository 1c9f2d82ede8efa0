"""Repeated byte strings across documents, found with suffix arrays.

Every 100-byte string is filed under its anchor, the 50-byte run in it with the smallest
hash, so that equal strings meet under the same anchor. The strings of one anchor in one
place form a context of 100 to 150 bytes; a context equal to an earlier one is repeated
whole. Where an anchor has several different contexts, these are joined and their suffixes
sorted in two stages: only suffixes smaller than their successors are sorted directly, the
others follow from a scan over the buckets of first bytes. Neighbours with a common prefix
of 100 bytes hold the same string.

Anchors that stand once, nearly all, never leave their block of documents with more than two
hashes: these are shuffled to the part of their hash, counted there over all blocks, and one
byte for each, compressed, goes back to the block it came from. Nothing is broadcast and no
table of fixed size fills up. Blocks and parts are as many as the text needs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Prefix, batch_of, mix, pieces, small, utf8, values

LENGTH = 100
ANCHOR = 50
# Bytes of text for one block of documents and for one part of the hashes. Small tables have
# up to SHARES smaller ones, of LEAST_BYTES at least.
PART_BYTES = 16 << 20
LEAST_BYTES = 1 << 18
SHARES = 256
BLOCK_BYTES = 1 << 18
# An anchor with so many different contexts is handled string by string instead.
HOT_CONTEXTS = 50_000

_PLACE_BITS = 31
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
_SEED = np.uint64(0xA24BAED4963EE407)

# What a block knows of its anchors: nothing to send, place, place and bytes, string by string.
ONCE, REPEATED, WANTED, HOT = range(4)

# Keys of a block for a part, or what the part answers, packed and compressed.
CELLS = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("size", pa.int64()), ("packed", pa.binary())]
)
CELLS_DDL = "part int, block int, size long, packed binary"
# Anchors (kind 0), ranges (kind 1) and strings (kind 2) of a part, packed and compressed.
PACKED = pa.schema(
    [("part", pa.int32()), ("kind", pa.int32()), ("size", pa.int64()), ("packed", pa.binary())]
)
PACKED_DDL = "part int, kind int, size long, packed binary"
COLUMNS = {0: 7, 1: 4, 2: 5}
# Ranges of the documents of a block, packed and compressed.
RANGES = pa.schema([("block", pa.int32()), ("size", pa.int64()), ("packed", pa.binary())])
RANGES_DDL = "block int, size long, packed binary"
BLOCKS = pa.schema(
    [
        ("block", pa.int32()),
        ("doc_id", pa.int64()),
        ("id", pa.int64()),
        ("tie", pa.int64()),
        ("n_bytes", pa.int64()),
        ("text", pa.binary()),
    ]
)
BLOCKS_DDL = "block int, doc_id long, id long, tie long, n_bytes long, text binary"


def _zstd(level: int = 6) -> pa.Codec:
    return pa.Codec("zstd", compression_level=level)


def _opened(size: int, blob: bytes) -> bytes:
    return pa.decompress(blob, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def packed(columns: list[np.ndarray], tail: bytes = b"") -> tuple[int, bytes]:
    """Size and compressed bytes of 64-bit columns of equal length, then any bytes."""
    whole = np.int64(len(columns[0])).tobytes() + b"".join(c.tobytes() for c in columns) + tail
    return len(whole), _zstd().compress(whole, asbytes=True)


def unpacked(size: int, blob: bytes, n_columns: int) -> tuple[list[np.ndarray], bytes]:
    whole = _opened(size, blob)
    n = int(np.frombuffer(whole, np.int64, 1)[0])
    columns = np.frombuffer(whole, np.int64, n * n_columns, 8).reshape(n_columns, n)
    return list(columns), whole[8 + 8 * n * n_columns :]


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima from both sides of blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


class Contexts:
    """Anchors of some texts: hash, document, and the bytes that their strings cover."""

    def __init__(self, texts: list[bytes]):
        self.data = b"".join(texts)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.cumsum(size) - size
        n = len(self.data)
        none = np.zeros(0, np.int64)
        self.doc = self.low = self.high = none
        self.kh = self.ch = np.zeros(0, np.uint64)
        if n < LENGTH:
            return
        prefix = Prefix(np.frombuffer(self.data, np.uint8))
        at = np.arange(n - ANCHOR + 1)
        h = prefix.hashes(at, at + ANCHOR)
        picked = sliding_minimum((h & ~_PLACE) | at.astype(np.uint64), LENGTH - ANCHOR + 1)
        anchor = (picked & _PLACE).astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), size)
        start = np.flatnonzero(owner[: n - LENGTH + 1] == owner[LENGTH - 1 :])
        if not len(start):
            return
        anchor, doc = anchor[start], owner[start]
        new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
        self.doc, self.kh = doc[new], h[anchor[new]]
        self.low = start[new]
        self.high = start[np.concatenate([new[1:], [len(start)]]) - 1] + LENGTH
        offset = (anchor[new] - self.low).astype(np.uint64)
        self.ch = mix(prefix.hashes(self.low, self.high) + (offset + np.uint64(1)) * _SEED)

    def context(self, k: int) -> bytes:
        return self.data[self.low[k] : self.high[k]]


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Texts with the order of documents, and whether no id stands twice.

    The order is by id, a missing one first, then by ``tie``: a hash of the text, or 0 if no
    id stands twice.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["doc_id"].cast("long"), F.lit(-(1 << 63))).alias("id"),
        text.alias("text"),
    )
    repeated = rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    unique = repeated.isEmpty()
    return rows.withColumn("tie", F.lit(0).cast("long") if unique else F.xxhash64("text")), unique


def _shares(rows: DataFrame, part_bytes: int) -> int:
    """Number of blocks, and of parts, for about so many bytes of text each."""
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint")).alias("n")).first()["n"] or 0
    return max(1, -(-size // part_bytes), min(SHARES, -(-size // LEAST_BYTES)))


def share(h: np.ndarray, n: int) -> np.ndarray:
    """One of ``n`` equal ranges of the upper 32 bits of a hash; it rises with the hash."""
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def anchor_keys(kh: np.ndarray) -> np.ndarray:
    """48 bits that spread anchors evenly; two anchors with the same key only cost time.

    The hashes themselves are the smallest of 51 each and crowd at the lower end.
    """
    return mix(kh) >> np.uint64(16)


def key_share(key: np.ndarray, n: int) -> np.ndarray:
    return share(key << np.uint64(16), n)


def block_of(ids: np.ndarray, tie: np.ndarray, n: int) -> np.ndarray:
    return share(mix(mix(ids.view(np.uint64)) + tie.view(np.uint64)), n)


def _cuts(numbers: np.ndarray) -> list[tuple[int, int]]:
    """Runs of equal neighbours as (first, behind the last)."""
    first = np.flatnonzero(np.diff(numbers, prepend=-1))
    return list(zip(first.tolist(), [*first[1:].tolist(), len(numbers)]))


def packed_keys(key: np.ndarray, ch: np.ndarray) -> tuple[int, bytes]:
    """Rising keys as the bytes of their differences, lowest bytes first, then the contexts."""
    steps = np.diff(key, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    whole = steps[:, :6].T.tobytes() + ch.tobytes()
    return len(whole), _zstd(1).compress(whole, asbytes=True)


def unpacked_keys(size: int, blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    whole = _opened(size, blob)
    n = size // 14
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :6] = np.frombuffer(whole, np.uint8, 6 * n).reshape(6, n).T
    return np.cumsum(steps.view(np.uint64).ravel()), np.frombuffer(whole, np.uint64, n, 6 * n)


def verdicts(key: np.ndarray, ch: np.ndarray, hot: int) -> np.ndarray:
    """What a block has to send, for keys and contexts of all blocks, each once a block.

    Of equal contexts of an anchor with several, only one block sends the bytes.
    """
    order = np.lexsort((ch, key))
    key, ch = key[order], ch[order]
    starts = np.ones(len(key), bool)
    starts[1:] = key[1:] != key[:-1]
    new = starts.copy()
    new[1:] |= ch[1:] != ch[:-1]
    first = np.flatnonzero(starts)
    own = np.cumsum(starts) - 1
    total = np.diff(np.append(first, len(key)))[own]
    contexts = np.add.reduceat(new.astype(np.int64), first)[own] if len(first) else total
    told = np.where(total > 1, REPEATED, ONCE)
    told[(contexts > 1) & new] = WANTED
    told[contexts >= hot] = HOT
    out = np.zeros(len(key), np.uint8)
    out[order] = told
    return out


class Block:
    """Anchors of the documents of a block, by key, context and place."""

    def __init__(self, table: pa.Table):
        sizes, blobs = table["n_bytes"].to_pylist(), table["text"].to_pylist()
        self.texts = [_opened(n, b) for n, b in zip(sizes, blobs)]
        self.ids, self.tie = (np.array(table[c].to_pylist(), np.int64) for c in ("id", "tie"))
        held = []
        for piece in pieces(self.texts):
            c = Contexts(self.texts[piece])
            start = c.first[c.doc]
            held.append((c.kh, c.ch, piece.start + c.doc, c.low - start, c.high - start))
        kh, ch, doc, low, high = (np.concatenate([h[k] for h in held]) for k in range(5))
        by_place = np.lexsort((self.tie, self.ids))
        ids, tie = self.ids[by_place], self.tie[by_place]
        rank = np.zeros(len(ids), np.int64)
        rank[by_place[1:]] = np.cumsum((ids[1:] != ids[:-1]) | (tie[1:] != tie[:-1]))
        place = (rank[doc] << 32) + low
        key = anchor_keys(kh)
        order = np.lexsort((place, ch, key))
        self.key, self.kh, self.ch = key[order], kh[order], ch[order]
        self.doc, self.low, self.high = doc[order], low[order], high[order]
        place = place[order]
        self.head = np.ones(len(order), bool)
        self.head[1:] = (self.key[1:] != self.key[:-1]) | (self.ch[1:] != self.ch[:-1])
        # The first place of a context may stand several times in a row: repeated rows.
        first = np.maximum.accumulate(np.where(self.head, np.arange(len(order)), 0))
        self.later = place != place[first]

    def context(self, k: int) -> bytes:
        return self.texts[self.doc[k]][self.low[k] : self.high[k]]

    def places(self, which: np.ndarray) -> list[np.ndarray]:
        doc = self.doc[which]
        return [self.ids[doc], self.tie[doc], self.low[which], self.high[which]]


def _verdicts(blocks: DataFrame, n: int, hot: int) -> DataFrame:
    """What each block has to send of its anchors, in the order of keys and contexts."""

    def keys(table: pa.Table) -> pa.Table:
        own = Block(table)
        number = table["block"][0].as_py()
        key, ch = own.key[own.head], own.ch[own.head]
        part = key_share(key, n)
        out = [(int(part[a]), number, *packed_keys(key[a:b], ch[a:b])) for a, b in _cuts(part)]
        return _table(CELLS, out)

    def judged(table: pa.Table) -> pa.Table:
        cells = [unpacked_keys(*c) for c in zip(table["size"].to_pylist(), table["packed"].to_pylist())]
        told = verdicts(*(np.concatenate([c[k] for c in cells]) for k in range(2)), hot)
        out, at, codec = [], 0, _zstd(1)
        part = table["part"][0].as_py()
        for block, (key, _) in zip(table["block"].to_pylist(), cells):
            answer = told[at : at + len(key)].tobytes()
            at += len(key)
            out.append((part, block, len(answer), codec.compress(answer, asbytes=True)))
        return _table(CELLS, out)

    sent = blocks.groupBy("block").applyInArrow(keys, CELLS_DDL)
    return sent.groupBy("part").applyInArrow(judged, CELLS_DDL)


def _table(schema: pa.Schema, rows: Iterable[tuple]) -> pa.Table:
    rows = list(rows)
    return pa.Table.from_batches([batch_of(schema, zip(*rows))] if rows else [], schema=schema)


def merged(ids: np.ndarray, tie: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """Ranges in order, those that touch or overlap in one document as one."""
    order = np.lexsort((low, tie, ids))
    ids, tie, low, high = (x[order] for x in (ids, tie, low, high))
    if not len(ids):
        return [ids, tie, low, high]
    other = np.ones(len(ids), bool)
    other[1:] = (ids[1:] != ids[:-1]) | (tie[1:] != tie[:-1])
    apart = np.cumsum(other) << 32
    new = np.ones(len(ids), bool)
    new[1:] = (low + apart)[1:] > np.maximum.accumulate(high + apart)[:-1]
    cuts = np.flatnonzero(new)
    return [ids[cuts], tie[cuts], low[cuts], np.maximum.reduceat(high, cuts)]


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, first byte highest, zeros at the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.zeros(len(data), np.uint64)
    for k in range(8):
        words |= padded[k : k + len(data)].astype(np.uint64) << np.uint64(56 - 8 * k)
    return words


def direct_order(data: np.ndarray, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """``suffixes`` sorted by their first ``depth`` bytes or more, eight bytes at a time.

    After each step only suffixes that are still equal to a neighbour are sorted further.
    """
    words = np.concatenate([eight_bytes(data), np.zeros(depth + 8, np.uint64)])
    suffixes = suffixes[np.argsort(words[suffixes], kind="stable")]
    tied = np.arange(len(suffixes))
    group = np.zeros(len(suffixes), np.int64)
    for k in range(0, depth, 8):
        key = words[suffixes[tied] + k]
        if k:
            sort = np.lexsort((key, group))
            suffixes[tied] = suffixes[tied[sort]]
            key, group = key[sort], group[sort]
        new = np.ones(len(tied), bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        alone = new & np.append(new[1:], True)
        group = np.cumsum(new)[~alone]
        tied = tied[~alone]
        if not len(tied):
            break
    return suffixes


def two_stage_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``data`` in the order of at least their first ``depth`` bytes.

    ``data`` has no zeros but those that end strings. A suffix smaller than its successor is
    sorted directly; the others are placed by scanning the buckets of first bytes upwards,
    as each stands right before a suffix of a smaller bucket or of a run of its own byte.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    step = np.diff(data.astype(np.int16), append=np.int16(256))
    change = np.flatnonzero(step)
    smaller = (step[change] > 0)[np.searchsorted(change, np.arange(n))]
    direct = direct_order(data, np.flatnonzero(smaller), depth)
    by_byte = np.searchsorted(data[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    for byte in np.unique(data).tolist():
        induced = [np.concatenate(waiting[byte])] if waiting[byte] else []
        wave = induced[0] if induced else np.zeros(0, np.int64)
        while len(wave):
            before = wave[wave > 0] - 1
            wave = before[data[before] == byte]
            induced.append(wave)
        bucket = np.concatenate([*induced, direct[by_byte[byte] : by_byte[byte + 1]]])
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[data[before] > byte]
        after = data[before]
        sort = np.argsort(after, kind="stable")
        after, before = after[sort], before[sort]
        cuts = np.flatnonzero(np.diff(after.astype(np.int16), prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(after)]):
            waiting[int(after[a])].append(before[a:b])
    return np.concatenate(order)


def common_prefixes_reach(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the suffixes at ``a`` and ``b``, pair by pair, share their first ``length`` bytes."""
    words = eight_bytes(data)
    alive = np.arange(len(a))
    for k in [*range(0, length - 8, 8), length - 8]:
        alive = alive[words[a[alive] + k] == words[b[alive] + k]]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def repeated_starts(contexts: list[bytes], place: np.ndarray) -> np.ndarray:
    """Starts, in the joined contexts, of strings that also start earlier.

    ``place`` has a row of numbers for every context: document and place of its first byte.
    """
    joined = np.frombuffer(b"\xff".join(contexts) + b"\xff", np.uint8) + np.uint8(1)
    size = np.fromiter(map(len, contexts), np.int64, len(contexts))
    first = np.cumsum(size + 1) - size - 1
    owner = np.repeat(np.arange(len(contexts)), size + 1)
    order = two_stage_order(joined, LENGTH)
    own = owner[order]
    order = order[order - first[own] <= size[own] - LENGTH]
    own = owner[order]
    if not len(order):
        return order
    same = np.zeros(len(order), bool)
    same[1:] = common_prefixes_reach(joined, order[:-1], order[1:], LENGTH)
    group = np.cumsum(~same)
    tie = (place[own, 2] + order - first[own], place[own, 1], place[own, 0], group)
    sort = np.lexsort(tie)
    where = np.stack([t[sort] for t in tie])
    starts_group = np.diff(where[3], prepend=-1) != 0
    other = np.any(where[:3, 1:] != where[:3, :-1], axis=0)
    # A place that stands twice, in two contexts, is repeated only if another stands before it.
    rank = np.cumsum(starts_group | np.concatenate([[True], other]))
    head = np.maximum.accumulate(np.where(starts_group, rank, 0))
    later = rank > head
    return np.sort(order[sort[later]])


def _runs(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring starts as (first, end of the last string)."""
    cuts = np.flatnonzero(np.diff(starts, prepend=-2) != 1)
    for a, b in zip(cuts, [*cuts[1:], len(starts)]):
        yield int(starts[a]), int(starts[b - 1]) + LENGTH


def first_strings(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Strings by two hashes, id, tie and start, in this order; which have an earlier place."""
    h1, h2, ids, tie, start = columns
    order = np.lexsort((start, tie, ids, h2, h1))
    h1, h2, ids, tie, start = columns = [x[order] for x in columns]
    head = np.ones(len(order), bool)
    head[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    k = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    return columns, (ids != ids[k]) | (tie != tie[k]) | (start != start[k])


def _strings(own: Block, which: np.ndarray) -> list[np.ndarray]:
    """All strings of some contexts: two 64-bit hashes and the place."""
    data = np.frombuffer(b"".join(own.context(k) for k in which), np.uint8)
    ids, tie, low, high = own.places(which)
    size = high - low
    n = size - LENGTH + 1
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(size) - size, n) + inside
    h1 = Prefix(data).hashes(at, at + LENGTH)
    h2 = Prefix(data ^ np.uint8(0x5A)).hashes(at, at + LENGTH)
    return [h1, h2, np.repeat(ids, n), np.repeat(tie, n), np.repeat(low, n) + inside]


def _anchor_rows(blocks: DataFrame, told: DataFrame, n: int) -> DataFrame:
    """Repeated anchors of all texts; those equal to an earlier one of the block as ranges.

    Anchors with very many contexts go string by string, to the parts of the strings.
    """

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        own = Block(table)
        cells = zip(*(answers[c].to_pylist() for c in ("part", "size", "packed")))
        answer = np.frombuffer(b"".join(_opened(*c[1:]) for c in sorted(cells)), np.uint8)
        heads = np.flatnonzero(own.head)
        out = []
        keep = heads[(answer == REPEATED) | (answer == WANTED)]
        wanted = answer[(answer == REPEATED) | (answer == WANTED)] == WANTED
        part = key_share(own.key[keep], n)
        for a, b in _cuts(part):
            k, has = keep[a:b], wanted[a:b]
            columns = [own.kh[k], own.ch[k], *own.places(k), has.astype(np.int64)]
            out.append((int(part[a]), 0, *packed(columns, b"".join(own.context(i) for i in k[has]))))
        ranges = [own.places(np.flatnonzero(own.later))]
        hot = heads[answer == HOT]
        if len(hot):
            (h1, h2, ids, tie, start), later = first_strings(_strings(own, hot))
            ranges.append([ids[later], tie[later], start[later], start[later] + LENGTH])
            h1, h2, ids, tie, start = (x[~later] for x in (h1, h2, ids, tie, start))
            part = share(h1, n)
            for a, b in _cuts(part):
                columns = [x[a:b] for x in (h1, h2, ids, tie, start)]
                out.append((int(part[a]), 2, *packed(columns)))
        columns = merged(*(np.concatenate([r[k] for r in ranges]) for k in range(4)))
        if len(columns[0]):
            out.append((table["block"][0].as_py(), 1, *packed(columns)))
        return _table(PACKED, out)

    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, PACKED_DDL)


def _repeated_ranges(anchors: DataFrame, n: int) -> DataFrame:
    """Ranges of bytes that are repeated, out of anchors that meet by hash, for each block."""

    def by_suffixes(rows: np.ndarray, contexts: list[bytes], ids, tie, low) -> list[tuple]:
        place = np.stack([ids[rows], tie[rows], low[rows]], axis=1)
        out = []
        size = np.fromiter(map(len, contexts), np.int64, len(contexts))
        first = np.cumsum(size + 1) - size - 1
        for start, end in _runs(repeated_starts(contexts, place)):
            k = int(np.searchsorted(first, start, side="right")) - 1
            base = int(place[k, 2]) - int(first[k])
            out.append((int(place[k, 0]), int(place[k, 1]), start + base, end + base))
        return out

    def ranges_of(table: pa.Table) -> Iterator[list[np.ndarray]]:
        kinds, sizes, blobs = (table[c].to_pylist() for c in ("kind", "size", "packed"))
        held, context, strings = [], [], []
        for kind, size, blob in zip(kinds, sizes, blobs):
            columns, tail = unpacked(size, blob, COLUMNS[kind])
            if kind == 1:
                yield columns
                continue
            if kind == 2:
                strings.append(columns)
                continue
            at = 0
            for size, has in zip((columns[5] - columns[4]).tolist(), columns[6].tolist()):
                context.append(tail[at : at + size] if has else None)
                at += size if has else 0
            held.append(columns)
        if strings:
            found, later = first_strings([np.concatenate([s[k] for s in strings]) for k in range(5)])
            ids, tie, start = (x[later] for x in found[2:])
            yield [ids, tie, start, start + LENGTH]
        if not held:
            return
        group, ch, ids, tie, low, high, has = (
            np.concatenate([h[k] for h in held]) for k in range(7)
        )
        order = np.lexsort((low, tie, ids, ch, group))
        group, ch, ids, tie, low, high, has = (
            x[order] for x in (group, ch, ids, tie, low, high, has)
        )
        head = np.ones(len(group), bool)
        head[1:] = (group[1:] != group[:-1]) | (ch[1:] != ch[:-1])
        first = np.maximum.accumulate(np.where(head, np.arange(len(group)), 0))
        later = (ids != ids[first]) | (tie != tie[first]) | (low != low[first])
        yield [ids[later], tie[later], low[later], high[later]]
        alone = np.flatnonzero(head)
        # Any of the equal contexts has the bytes.
        bytes_at = np.maximum.reduceat(np.where(has == 1, np.arange(len(group)), -1), alone)
        _, back, many = np.unique(group[alone], return_inverse=True, return_counts=True)
        some = (many[back] > 1) & (bytes_at >= 0)
        alone = alone[some]
        own = [context[k] for k in order[bytes_at[some]]]
        out: list[tuple] = []
        begin = size = 0
        for k, c in enumerate(own):
            size += len(c) + 1
            last = k + 1 == len(own) or group[alone[k + 1]] != group[alone[k]]
            if last and (size >= BLOCK_BYTES or k + 1 == len(own)):
                out += by_suffixes(alone[begin : k + 1], own[begin : k + 1], ids, tie, low)
                begin, size = k + 1, 0
        if out:
            yield [np.array(c, np.int64) for c in zip(*out)]

    def run(table: pa.Table) -> pa.Table:
        found = list(ranges_of(table))
        columns = merged(*(np.concatenate([f[k] for f in found]) for k in range(4)))
        block = block_of(columns[0], columns[1], n)
        order = np.argsort(block, kind="stable")
        block, columns = block[order], [c[order] for c in columns]
        cuts = _cuts(block)
        return _table(
            RANGES, [(int(block[a]), *packed([c[a:b] for c in columns])) for a, b in cuts]
        )

    return anchors.groupBy("part").applyInArrow(run, RANGES_DDL)


def _blocks(rows: DataFrame, unique: bool, n: int) -> DataFrame:
    """Rows with compressed texts and their block; equal rows once, with their number of copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _zstd()
        for batch in small(batches):
            texts = utf8(batch, "text")
            same = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "id", "tie")]
            ids, tie = (np.array(c.to_pylist(), np.int64) for c in same[1:])
            blobs = [codec.compress(t, asbytes=True) if t else b"" for t in texts]
            yield batch_of(BLOCKS, [block_of(ids, tie, n), *same, [len(t) for t in texts], blobs])

    out = rows.select("doc_id", "id", "tie", "text").mapInArrow(run, BLOCKS_DDL)
    if unique:
        return out.withColumn("copies", F.lit(1).cast("long"))
    key = ["block", "doc_id", "id", "tie", "n_bytes"]
    return out.groupBy(*key).agg(F.first("text").alias("text"), F.count("*").alias("copies"))


def remove_repeats(docs: DataFrame, hot: int = HOT_CONTEXTS, part_bytes: int = PART_BYTES) -> DataFrame:
    """What is left of each document without the bytes of repeated 100-byte strings.

    A byte goes if a 100-byte string over it also starts earlier: in a document with a
    smaller doc_id, or earlier in the same one. Returns doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs) and kept_sha256 of the remaining bytes.

    A missing doc_id comes before all others; documents with the same doc_id but other
    texts go by a hash of the text; rows equal in both are one document and get the same
    row each. A missing text is empty; texts under 100 bytes lose nothing; an empty table
    gives no rows; columns other than doc_id and text are not looked at. Contexts are told
    apart by 64-bit hashes.
    """
    rows, unique = _keyed(docs)
    n = _shares(rows, part_bytes)
    # All three readers of the blocks want them by block, so that their shuffle is reused.
    blocks = _blocks(rows, unique, n)
    anchors = _anchor_rows(blocks, _verdicts(blocks, n, hot), n)
    ranges = _repeated_ranges(anchors, n)
    out = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("n_removed", pa.int64()),
            ("n_spans", pa.int64()),
            ("kept_sha256", pa.string()),
            ("copies", pa.int64()),
        ]
    )

    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        cells = [unpacked(*c, 4)[0] for c in zip(found["size"].to_pylist(), found["packed"].to_pylist())]
        own: dict[tuple[int, int], list[tuple[int, int]]] = {}
        if cells:
            columns = merged(*(np.concatenate([c[k] for c in cells]) for k in range(4)))
            for doc_id, tie, low, high in zip(*(c.tolist() for c in columns)):
                own.setdefault((doc_id, tie), []).append((low, high))
        done = []
        for doc_id, key, tie, n_bytes, blob, copies in zip(
            *(table[c].to_pylist() for c in ("doc_id", "id", "tie", "n_bytes", "text", "copies"))
        ):
            text = _opened(n_bytes, blob)
            digest, at, removed = hashlib.sha256(), 0, 0
            spans = own.get((key, tie), [])
            for low, high in spans:
                digest.update(text[at:low])
                removed += high - low
                at = high
            digest.update(text[at:])
            done.append((doc_id, len(text), removed, len(spans), digest.hexdigest(), copies))
        return _table(out, done)

    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, copies long"
    result = blocks.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(run, ddl)
    if not unique:
        result = result.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
