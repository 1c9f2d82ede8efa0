"""Training sequences by vector bin packing with the dot-product heuristic.

Every scan task tokenises its documents and packs them itself, so nothing is shuffled. An
example has three sizes: tokens, segments (one for each piece) and loss-bearing tokens. An
open sequence takes, again and again, the piece that still fits all three limits and whose
sizes have the largest dot product with what the sequence has left. Where none fits, a
piece is cut so that the sequence is filled.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .text import batch_of, values

CAPACITY = 2048
MAX_SEGMENTS = 256
MAX_LOSS = 2048
END_ID = 1
POOL = 256
CACHED_WORDS = 1_200_000
LEARNED_AT_ONCE = 8192
SEQUENCE_BITS = 34

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("loss_tokens", pa.int64()),
    ]
)
PIECES_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, loss_tokens long"
)


class WordTokenizer:
    """Token ids of texts for a lower-casing tokenizer that never joins over white space.

    Each distinct word between blanks and line ends is encoded once and remembered, as the
    bytes of its unsigned 32-bit ids; the memory is emptied when it is full. A worker keeps
    its tokenizer, and so what it has learned, from task to task.
    """

    kept: dict[str, WordTokenizer] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        if path not in cls.kept:
            cls.kept[path] = cls(path)
        return cls.kept[path]

    def learn(self, words: list[str]) -> None:
        """Encode new words, set apart by blanks, in one call; the offsets tell them apart."""
        if len(self.known) + len(words) > CACHED_WORDS:
            self.known = {"": b""}
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        encoded = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = array("I", encoded.ids).tobytes()
        at = np.fromiter((o[0] for o in encoded.offsets), np.int64, len(encoded.ids))
        cuts = np.searchsorted(at, starts) * 4
        for word, low, high in zip(words, cuts[:-1].tolist(), cuts[1:].tolist()):
            self.known[word] = ids[low:high]

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [self.plain(t).replace("\n", " ").split(" ") for t in texts]
        new = list(set().union(*split).difference(self.known))
        for k in range(0, len(new), LEARNED_AT_ONCE):
            self.learn(new[k : k + LEARNED_AT_ONCE])
        return [self.joined(words) for words in split]

    @staticmethod
    def plain(text: str) -> str:
        """Lower case where that cannot change an id, so that fewer words are distinct."""
        return text.lower() if text.isascii() and "<|" not in text else text

    def joined(self, words: list[str]) -> bytes:
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:  # the memory was emptied meanwhile
            return b"".join(map(self.one, words))

    def one(self, word: str) -> bytes:
        if word not in self.known:
            self.learn([word])
        return self.known[word]


class Packer:
    """Packs examples that are added one by one; ``done`` holds finished (row, ...) pieces."""

    def __init__(self, capacity: int, max_segments: int, max_loss: int, sequence: int):
        self.limits = np.array([capacity, max_segments, max_loss], np.float64)
        self.capacity = capacity
        self.sequence = sequence
        self.size = np.zeros((0, 3))
        self.items: list[tuple] = []  # (doc_id, ids, start, first loss-bearing token)
        self.waiting: list[tuple] = []
        self.done: list[tuple] = []

    @staticmethod
    def loss(start: int, length: int, prompt: int) -> int:
        return max(0, start + length - max(start, prompt))

    def longest(self, item: tuple, room: float, loss: float) -> int:
        """Tokens of an item's front that ``room`` and ``loss`` allow."""
        _, ids, start, prompt = item
        free = max(0, prompt - start)
        return int(min(len(ids) // 4 - start, room, free + loss))

    def place(self, item: tuple, length: int, offset: int) -> tuple:
        doc_id, ids, start, prompt = item
        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
        loss = self.loss(start, length, prompt)
        self.done.append(
            (doc_id, start, length, crc, len(ids) // 4, self.sequence, offset, loss)
        )
        return doc_id, ids, start + length, prompt

    def add(self, doc_id, ids: bytes, prompt: int = 0) -> None:
        """``ids``: little-endian unsigned 32-bit; the first ``prompt`` bear no loss."""
        item = (doc_id, ids, 0, prompt)
        while len(ids) // 4 - item[2] >= self.capacity:
            length = self.longest(item, self.capacity, self.limits[2])
            item = self.place(item, length, 0)
            self.sequence += 1
        if len(ids) // 4 > item[2]:
            self.waiting.append(item)
        if len(self.waiting) + len(self.items) >= 2 * POOL:
            self.pack(POOL)

    def take_in(self) -> None:
        if self.waiting:
            sizes = [
                (len(i[1]) // 4 - i[2], 1, self.loss(i[2], len(i[1]) // 4 - i[2], i[3]))
                for i in self.waiting
            ]
            self.size = np.concatenate([self.size, np.array(sizes, np.float64)])
            self.items += self.waiting
            self.waiting = []

    def fill(self, capacity: int) -> None:
        """One sequence of at most ``capacity`` tokens out of the pool."""
        left = np.array([capacity, *self.limits[1:]], np.float64)
        open_ = np.ones(len(self.items), bool)
        offset = 0
        cut = None
        while left[0] > 0 and left[1] > 0:
            score = np.where(
                open_ & (self.size <= left).all(1), (self.size / self.limits) @ (left / self.limits), -1
            )
            best = int(score.argmax()) if len(score) else 0
            if len(score) and score[best] >= 0:
                length = int(self.size[best, 0])
                self.place(self.items[best], length, offset)
                left -= self.size[best]
                open_[best] = False
                offset += length
                continue
            sizes = np.where(open_, self.size[:, 0], -1)
            largest = int(sizes.argmax()) if len(sizes) else 0
            if not len(sizes) or sizes[largest] <= 0:
                break
            length = self.longest(self.items[largest], left[0], left[2])
            if length <= 0:
                break
            cut = self.place(self.items[largest], length, offset)
            open_[largest] = False
            offset += length
            left -= [length, 1, self.loss(cut[2] - length, length, cut[3])]
            if len(cut[1]) // 4 > cut[2]:
                self.waiting.append(cut)
        self.items = [i for i, keep in zip(self.items, open_) if keep]
        self.size = self.size[open_]
        self.take_in()
        self.sequence += 1

    def pack(self, keep: int) -> None:
        """Fill sequences until ``keep`` examples wait; 0: all, down to powers of two."""
        self.take_in()
        while len(self.items) > keep and self.size[:, 0].sum() >= self.capacity:
            self.fill(self.capacity)
        while not keep and self.items:
            rest = min(self.capacity, int(self.size[:, 0].sum()))
            self.fill(1 << (rest.bit_length() - 1))


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = MAX_LOSS,
    prompt: str | None = None,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``capacity`` tokens.

    ``tokenizer`` is the file of a tokenizer that drops white space; every worker reads it.
    A document's ids are those of its text and a closing 1; ``prompt`` names a column with
    the number of leading ids that bear no loss (instruction data). ``capacity`` is a power
    of two. Every id lies in one piece. What a task has left at its end goes into shorter
    sequences of a power of two, so only the limits on segments and loss leave padding.

    A missing text is empty and has the closing id alone; repeated rows are packed as often
    as they stand there; an empty table gives no rows; other columns are not looked at.
    ``sequence_id`` is the task's number and a running number within it: a task that runs
    again gives the same rows.
    """
    columns = ["doc_id", "text", *([prompt] if prompt else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordTokenizer.of(tokenizer)
        end = array("I", [END_ID]).tobytes()
        packer = Packer(
            capacity, max_segments, max_loss, TaskContext.get().partitionId() << SEQUENCE_BITS
        )

        def finished():
            out, packer.done = packer.done, []
            return batch_of(PIECES, zip(*out)) if out else batch_of(PIECES, [[]] * len(PIECES))

        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                prompts = values(part, prompt) if prompt else [0] * part.num_rows
                texts = [t or "" for t in values(part, "text")]
                for doc_id, ids, skip in zip(values(part, "doc_id"), encode(texts), prompts):
                    packer.add(doc_id, ids + end, skip or 0)
            yield finished()
        packer.pack(0)
        yield finished()

    rows = docs.select(*columns)
    return rows.withColumn("doc_id", rows["doc_id"].cast("long")).mapInArrow(run, PIECES_DDL)
