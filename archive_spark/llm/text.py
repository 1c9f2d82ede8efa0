"""Words and bytes of many documents at once, as numpy arrays inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 19
BATCH_ROWS = 1000

_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Every ASCII byte that is no letter or digit becomes a blank, A-Z become a-z.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a missing id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def small(batches: Iterable[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that less is unpacked at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The texts of a column as UTF-8 bytes; a missing text is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def pieces(texts: list[bytes], size: int = PIECE_BYTES) -> Iterator[slice]:
    """Runs of whole documents of about ``size`` bytes; a longer document stands alone."""
    first = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield slice(first, i)
            first, held = i, 0
        held += len(text) + 1
    if first < len(texts):
        yield slice(first, len(texts))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def mixed_int(value: int) -> int:
    return int(mix(np.array([value % (1 << 64)], np.uint64))[0])


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


class Prefix:
    """Hashes of any byte ranges of one text, out of its prefix sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


class Words:
    """Words of a run of documents: hash, document and document sizes.

    ``h`` holds 64-bit hashes of the words in order, ``doc`` the document of each word,
    ``count`` the words of each document, ``first`` the place of its first word.
    """

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts) + b"\n"
        data = np.frombuffer(joined, np.uint8)
        space = IS_SPACE[data]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[1:] = ~space
        edge = np.diff(inside)
        start = np.flatnonzero(edge == 1)
        end = np.flatnonzero(edge == -1)
        self.h = Prefix(data).hashes(start, end)
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(ends, start, side="right")
        self.count = np.bincount(self.doc, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.count)])[:-1]


def chained(*parts: np.ndarray) -> np.ndarray:
    """One hash for each row of several aligned hash arrays, order matters."""
    total = np.zeros(len(parts[0]), np.uint64)
    for k, part in enumerate(parts):
        total = total * np.uint64(0xD6E8FEB86659FD93) + part + np.uint64(k)
    return mix(total)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and the document of each run.

    A document with fewer words has one run of all of them, one without words has none.
    """
    h, doc = words.h, words.doc
    n = len(h)
    if n >= size:
        whole = doc[: n - size + 1] == doc[size - 1 :]
        runs = chained(*(h[k : n - size + 1 + k] for k in range(size)))[whole]
        at = doc[: n - size + 1][whole]
    else:
        runs, at = np.zeros(0, np.uint64), np.zeros(0, doc.dtype)
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    if len(short):
        lone = [
            chained(*h[words.first[d] : words.first[d] + words.count[d]].reshape(-1, 1))[0]
            for d in short
        ]
        runs = np.concatenate([runs, np.array(lone, np.uint64)])
        at = np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        runs, at = runs[order], at[order]
    return runs, at


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Batches sorted by an integer key, cut anew so that no group is spread over two."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        first = int(np.argmax(column == column[-1]))
        if held and (first or held_key != column[-1]):
            if first:
                held.append(batch.slice(0, first))
            yield pa.Table.from_batches(held)
            held = [batch.slice(first)]
        elif first:
            yield pa.Table.from_batches([batch.slice(0, first)])
            held = [batch.slice(first)]
        else:
            held.append(batch)
        held_key = column[-1]
    if held:
        yield pa.Table.from_batches(held)


def batch_of(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )
