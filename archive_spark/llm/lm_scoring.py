"""Language-model scores with n-gram counts held in a log-frequency Bloom filter.

Single words have exact counts. Word pairs are counted once over the training documents and
kept as levels: a pair seen c times is put into the filter once for each of the levels 1 to
1 + floor(log2 c). Asking level after level until one is missing gives the order of the
count, never too low. The probability of a word mixes the pair's share with the word's own
probability, weighted by how often the word before it was seen.

The model comes in parts by hash. Parts are broadcast in groups of at most
``broadcast_bytes``; as long as the model fits, that is one group and one pass. A larger
model takes one pass for each group, in which the counts found so far are carried along, so
it is neither cut down nor sent out whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .text import Words, batch_of, chained, fold, mix, mixed_int, pieces, small, utf8, values

FOLDS = 10
PSEUDO_COUNT = 0.1
CONTEXT_WEIGHT = 200.0
BITS_PER_ENTRY = 12
PROBES = 5
PART_BYTES = 4 << 20
FLUSH_KEYS = 1_500_000
BROADCAST_BYTES = 256 << 20

WORD, PAIR = 0, 1
START, END = mixed_int(0x5354415254), mixed_int(0x454E44)

PART = pa.schema(
    [("kind", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
)
PART_DDL = "kind int, part int, keys binary, counts binary"
MODEL = pa.schema(
    [
        ("kind", pa.int32()),
        ("part", pa.int32()),
        ("keys", pa.binary()),
        ("counts", pa.binary()),
        ("entries", pa.int64()),
        ("total", pa.int64()),
    ]
)
MODEL_DDL = f"{PART_DDL}, entries long, total long"


class Tokens:
    """Words of a run of documents, each followed by an end; with the token before each."""

    def __init__(self, texts: list[bytes]):
        words = Words([t.lower() for t in texts])
        self.count = words.count + 1
        self.first = np.concatenate([[0], np.cumsum(self.count)])[:-1]
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self.h = np.full(len(self.doc), END, np.uint64)
        self.h[np.arange(len(words.h)) + words.doc] = words.h
        before = np.empty_like(self.h)
        before[1:] = self.h[:-1]
        before[self.first] = START
        self.pairs = chained(before, self.h)


def count_parts(docs: DataFrame, bits: int) -> DataFrame:
    """Counts of words and pairs as (kind, part, keys, counts), added up within each task.

    A key's part is its first ``bits`` bits. Keys are sorted 64-bit hashes.
    """

    def flushed(kind: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        part = (keys >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        rows = [
            (kind, int(part[a]), keys[a:b].tobytes(), counts[a:b].astype(np.uint64).tobytes())
            for a, b in zip(cuts, [*cuts[1:], len(keys)])
        ]
        if rows:
            yield batch_of(PART, zip(*rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {WORD: [], PAIR: []}
        waiting = 0
        for batch in small(batches):
            texts = utf8(batch, "text")
            for piece in pieces(texts):
                tokens = Tokens(texts[piece])
                held[WORD].append(tokens.h)
                held[PAIR].append(tokens.pairs)
                waiting += len(tokens.h)
                if waiting >= FLUSH_KEYS:
                    for kind in held:
                        yield from flushed(kind, held[kind])
                    held = {WORD: [], PAIR: []}
                    waiting = 0
        if waiting:
            for kind in held:
                yield from flushed(kind, held[kind])

    return docs.select("text").mapInArrow(run, PART_DDL)


def places(keys: np.ndarray, level: int, words: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """For each key at a level: its 64-bit word of a filter, and the bits to be set there."""
    h = mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
    at = ((h >> np.uint64(32)) * np.asarray(words).astype(np.uint64)) >> np.uint64(32)
    mask = np.zeros(len(keys), np.uint64)
    for k in range(PROBES):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return at.astype(np.int64), mask


def filter_of(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Filter words holding the levels of all keys, and the number of entries."""
    levels = 1 + np.floor(np.log2(counts.astype(np.float64))).astype(np.int64)
    entries = int(levels.sum())
    words = np.zeros(max(1, -(-entries * BITS_PER_ENTRY // 64)), np.uint64)
    for level in range(1, int(levels.max(initial=0)) + 1):
        at, mask = places(keys[levels >= level], level, len(words))
        np.bitwise_or.at(words, at, mask)
    return words, entries


def train(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The model as a stored table: a row for each part of the words and of the pairs.

    Words: keys and exact counts. Pairs: ``keys`` holds the words of the filter. ``total``
    adds up the counts. The number of parts follows the bytes of text.
    """
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint")).alias("n")).first()["n"] or 0
    bits = max(4, (max(1, size) // part_bytes).bit_length())

    def merged(table: pa.Table) -> pa.Table:
        kind, part = table["kind"][0].as_py(), table["part"][0].as_py()
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()])
        counts = np.concatenate([np.frombuffer(c, np.uint64) for c in table["counts"].to_pylist()])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
        counts = np.add.reduceat(counts, first)
        keys, total = keys[first], int(counts.sum())
        if kind == WORD:
            narrow = counts.astype(np.uint32) if counts.max() < 1 << 32 else counts
            row = (kind, part, keys.tobytes(), narrow.tobytes(), len(keys), total)
        else:
            words, entries = filter_of(keys, counts)
            row = (kind, part, words.tobytes(), b"", entries, total)
        return pa.Table.from_batches([batch_of(MODEL, [[x] for x in row])])

    counted = count_parts(docs, bits).groupBy("kind", "part").applyInArrow(merged, MODEL_DDL)
    return materialize(counted.withColumn("bits", F.lit(bits)), "language-model")


class Parts:
    """Some parts of a model, ready to look up.

    ``sizes`` has the bytes of ``keys`` and ``counts`` by (kind, part), ``rows`` the parts in
    any order. Each goes straight to its place, so nothing is held twice.
    """

    def __init__(self, bits: int, sizes: dict[tuple[int, int], tuple[int, int]], rows):
        self.shift = np.uint64(64 - bits)
        self.size = np.zeros(1 << bits, np.int64)
        self.offset = np.zeros(1 << bits, np.int64)
        start, held, wide = {}, {WORD: 0, PAIR: 0}, False
        for kind, part in sorted(sizes):
            n, counts = sizes[kind, part][0] // 8, sizes[kind, part][1]
            start[kind, part] = held[kind]
            held[kind] += n
            wide |= kind == WORD and counts > 4 * n
            if kind == PAIR:
                self.size[part], self.offset[part] = n, start[kind, part]
        self.keys = np.empty(held[WORD], np.uint64)
        self.counts = np.empty(held[WORD], np.uint64 if wide else np.uint32)
        self.filter = np.empty(held[PAIR], np.uint64)
        for r in rows:
            at, n = start[r["kind"], r["part"]], len(r["keys"]) // 8
            if r["kind"] == PAIR:
                self.filter[at : at + n] = np.frombuffer(r["keys"], np.uint64)
            else:
                width = np.uint32 if len(r["counts"]) == 4 * n else np.uint64
                self.keys[at : at + n] = np.frombuffer(r["keys"], np.uint64)
                self.counts[at : at + n] = np.frombuffer(r["counts"], width)

    def word_counts(self, h: np.ndarray) -> np.ndarray:
        """Exact count of each word; 0 for one that is not in these parts."""
        if not len(self.keys):
            return np.zeros(len(h), np.uint64)
        distinct, back = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
        return np.where(self.keys[at] == distinct, self.counts[at].astype(np.uint64), np.uint64(0))[back]

    def levels(self, pairs: np.ndarray) -> np.ndarray:
        """Level of each pair by repeated probes; 0 if it is not in these parts."""
        found = np.zeros(len(pairs), np.uint8)
        part = (pairs >> self.shift).astype(np.int64)
        active = np.flatnonzero(self.size[part])
        level = 1
        while len(active) and level < 64:
            own = part[active]
            at, mask = places(pairs[active], level, self.size[own])
            hit = (self.filter[self.offset[own] + at] & mask) == mask
            active = active[hit]
            found[active] = level
            level += 1
        return found


def level_counts() -> np.ndarray:
    """The count that a level stands for: the geometric middle of its range."""
    level = np.arange(64, dtype=np.float64)
    values_ = np.sqrt(2.0 ** (level - 1) * (2.0**level - 1))
    values_[0] = 0
    return values_


def log_probabilities(
    count: np.ndarray, level: np.ndarray, first: np.ndarray, n: int, v: int, docs: int, weight: float
) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the base and of the model probability of each token."""
    base = (count + PSEUDO_COUNT) / (n + PSEUDO_COUNT * (v + 1))
    context = np.empty(len(count))
    context[1:] = count[:-1]
    context[first] = docs
    pair = np.minimum(level_counts()[level], np.minimum(count, context))
    return np.log10(base), np.log10((pair + weight * base) / (context + weight))


def score_documents(
    docs: DataFrame,
    training: DataFrame | None = None,
    context_weight: float = CONTEXT_WEIGHT,
    broadcast_bytes: int = BROADCAST_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """log10 probability of every text, by single words (base_score) and by the model (score).

    ``training`` defaults to the documents whose crc32(doc_id) mod 10 is not 0. Tokens are
    words between white space in small letters (A-Z only) and an end. A missing text is
    empty and has the end alone; a missing doc_id counts as held out; repeated rows are
    scored each, and learned from as often as they stand there; without training rows every
    count is 0. An empty table gives no rows; columns other than doc_id and text are not
    looked at.
    """
    spark = docs.sparkSession
    held_out = fold("doc_id", FOLDS) == 0
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        held_out.alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    learned = rows.filter(~F.col("held_out")) if training is None else training
    table = train(learned.select(F.coalesce("text", F.lit("")).alias("text")), part_bytes)
    parts = table.select(
        "kind",
        "part",
        "bits",
        "entries",
        "total",
        F.octet_length("keys").alias("key_bytes"),
        F.octet_length("counts").alias("count_bytes"),
    ).collect()
    bits = parts[0]["bits"] if parts else 4
    n = sum(p["total"] for p in parts if p["kind"] == WORD)
    v = sum(p["entries"] for p in parts if p["kind"] == WORD)
    n_docs = learned.count()
    sizes = {(p["kind"], p["part"]): (p["key_bytes"], p["count_bytes"]) for p in parts}

    groups: list[list[tuple[int, int]]] = [[]]
    held = 0
    for place in sorted(sizes):
        if held and held + sum(sizes[place]) > broadcast_bytes:
            groups.append([])
            held = 0
        groups[-1].append(place)
        held += sum(sizes[place])

    def parts_of(group: list[tuple[int, int]]):
        low, high = (min(group), max(group)) if group else ((0, 1), (0, 0))
        place = F.struct(F.col("kind").alias("kind"), F.col("part").alias("part"))
        inside = place.between(
            F.struct(F.lit(low[0]).alias("kind"), F.lit(low[1]).alias("part")),
            F.struct(F.lit(high[0]).alias("kind"), F.lit(high[1]).alias("part")),
        )
        own = table.filter(inside).select("kind", "part", "keys", "counts").toLocalIterator()
        return spark.sparkContext.broadcast(Parts(bits, {p: sizes[p] for p in group}, own))

    carried = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("held_out", pa.bool_()),
            ("text", pa.string()),
            ("counts", pa.binary()),
            ("levels", pa.binary()),
        ]
    )
    scored = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("held_out", pa.bool_()),
            ("n_tokens", pa.int64()),
            ("n_known", pa.int64()),
            ("train_tokens", pa.int64()),
            ("base_score", pa.float64()),
            ("score", pa.float64()),
        ]
    )

    def looked_up(batch, texts, piece, model):
        """Tokens of a piece, their counts and their pairs' levels, with what was carried."""
        tokens = Tokens(texts[piece])
        counts, levels = model.word_counts(tokens.h), model.levels(tokens.pairs)
        if "counts" in batch.schema.names:
            before = b"".join(values(batch, "counts")[piece])
            counts = np.maximum(counts, np.frombuffer(before, np.uint64))
            before = b"".join(values(batch, "levels")[piece])
            levels = np.maximum(levels, np.frombuffer(before, np.uint8))
        return tokens, counts, levels

    def carry(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in small(batches):
                texts = utf8(batch, "text")
                counts: list[bytes] = []
                levels: list[bytes] = []
                for piece in pieces(texts):
                    tokens, c, q = looked_up(batch, texts, piece, shared.value)
                    for a, m in zip(tokens.first, tokens.count):
                        counts.append(c[a : a + m].tobytes())
                        levels.append(q[a : a + m].tobytes())
                same = [batch.column(k) for k in range(3)]
                yield batch_of(carried, [*same, counts, levels])

        return run

    def finish(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in small(batches):
                texts = utf8(batch, "text")
                out: list[list] = [[], [], [], []]
                for piece in pieces(texts):
                    tokens, c, q = looked_up(batch, texts, piece, shared.value)
                    base, full = log_probabilities(
                        c.astype(np.float64), q, tokens.first, n, v, n_docs, context_weight
                    )
                    out[0] += tokens.count.tolist()
                    out[1] += np.add.reduceat((c > 0).astype(np.int64), tokens.first).tolist()
                    out[2] += np.add.reduceat(base, tokens.first).tolist()
                    out[3] += np.add.reduceat(full, tokens.first).tolist()
                same = [batch.column(k) for k in range(2)]
                total = [n] * batch.num_rows
                yield batch_of(scored, [*same, out[0], out[1], total, out[2], out[3]])

        return run

    for group in groups[:-1]:
        shared = parts_of(group)
        rows = materialize(
            rows.mapInArrow(
                carry(shared), "doc_id long, held_out boolean, text string, counts binary, levels binary"
            ),
            "scores-so-far",
        )
        shared.destroy()
    return rows.mapInArrow(
        finish(parts_of(groups[-1])),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
