"""Quality scores: kernel ridge regression by random Fourier features, then calibration.

Statistics of every text are standardised and mapped to random cosines, whose inner products
approximate a Gaussian kernel. Each partition sums its part of the normal equations over
labelled rows; the sums are added up by row of the matrix, and the driver solves a system
whose size is a parameter. Isotonic regression over a fixed number of score bins turns the
ridge scores into probabilities.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .text import IS_SPACE, batch_of, fold, small, utf8, values

FEATURES = 384
RIDGE = 1e-2
BINS = 4096
SUM_TASKS = 256
FOLDS = 5
CALIBRATION_FOLD = 1
THRESHOLD = 0.3

_CLASS = np.zeros(256, np.int64)
_CLASS[[*range(97, 123)]] = 1
_CLASS[[*range(65, 91)]] = 2
_CLASS[[*range(48, 58)]] = 3
_CLASS[IS_SPACE] = 4
_CLASS[[*b"#*$%&|<>"]] = 5
_CLASS[[*b"!?"]] = 6
_CLASS[[*b".,;:'\"()-"]] = 7
_CLASS[128:192] = 8
_CLASS[192:] = 9


def text_statistics(text: bytes) -> list[float]:
    """Statistics of a whole text that do not depend on its language or meaning."""
    data = np.frombuffer(text, np.uint8)
    kinds = np.bincount(_CLASS[data], minlength=10)
    n = max(1, len(data))
    words = text.split()
    m = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split(b"\n") if x.strip()]
    line_count = max(1, len(lines))
    same = sum(a == b for a, b in zip(words, words[1:]))
    squeezed = sum(len(zlib.compress(text[k : k + 65536], 1)) for k in range(0, len(text), 65536))
    shares = (kinds / n).tolist()
    return [
        float(np.log1p(len(data))),
        float(np.log1p(len(words))),
        float(sizes.mean()),
        float(sizes.std()),
        *shares[:9],
        distinct / m,
        pairs / m,
        same / m,
        1 - len(set(lines)) / line_count,
        float(np.log1p(len(words) / line_count)),
        squeezed / n,
        sum(w[:1].isupper() for w in words) / m,
        sum(w.isupper() for w in words) / m,
        sum(not w.isalpha() for w in words) / m,
    ]


WIDTH = len(text_statistics(b""))


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every text, a missing one as an empty one."""
    schema = pa.schema([("doc_id", pa.int64()), ("stats", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            stats = [text_statistics(t) for t in utf8(batch, "text")]
            yield batch_of(schema, [values(batch, "doc_id"), stats])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, stats array<double>")


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def map(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features with a constant."""
        x = np.clip((stats - self.mean) / self.spread, -8, 8)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, np.ones((len(z), 1))])

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.map(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.ridge(stats), self.knots, self.levels), 0, 1)


def matrix_of(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("stats"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def isotonic(score: np.ndarray, hits: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing levels at rising scores that fit the hit rates best, as knots.

    Adjacent blocks are pooled while the left one has the higher rate. A knot stands at the
    mean score of each block; between knots the level is interpolated, so ties stay few.
    """
    blocks: list[list[float]] = []
    for s, h, t in zip(score.tolist(), hits.tolist(), total.tolist()):
        blocks.append([s * t, h, t])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    knots = np.array([b[0] / b[2] for b in blocks])
    levels = np.array([b[1] / b[2] for b in blocks])
    return knots, levels


def fit(labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = 7) -> Model:
    """A model from rows with ``stats``, ``label`` (0 or 1) and ``calibrate``.

    Rows with ``calibrate`` set the calibration, all others the ridge weights. The driver
    gets ``features`` sums of that length and at most ``BINS`` bins. Without labelled rows
    every score is one half.
    """
    rng = np.random.default_rng(seed)
    sums = labelled.filter(~F.col("calibrate")).select(
        F.count("*").alias("n"),
        *(F.sum(F.get("stats", F.lit(k))).alias(f"s{k}") for k in range(WIDTH)),
        *(F.sum(F.get("stats", F.lit(k)) ** 2).alias(f"q{k}") for k in range(WIDTH)),
    ).first()
    n = max(1, sums["n"])
    mean = np.array([sums[f"s{k}"] or 0.0 for k in range(WIDTH)]) / n
    square = np.array([sums[f"q{k}"] or 0.0 for k in range(WIDTH)]) / n
    spread = np.sqrt(np.maximum(square - mean**2, 0))
    model = Model(
        mean,
        np.where(spread > 1e-9, spread, 1.0),
        rng.normal(size=(WIDTH, features)) / np.sqrt(WIDTH),
        rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1),
        np.array([0.0]),
        np.array([0.5]),
    )
    if not sums["n"]:
        return model
    size = features + 1
    part = pa.schema([("row", pa.int32()), ("sums", pa.binary())])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = model.map(matrix_of(batch))
            y = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False)
            total += z.T @ np.hstack([z, y.reshape(-1, 1).astype(float)])
        yield batch_of(part, [range(size), [r.tobytes() for r in total]])

    def added(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x) for x in table.column("sums").to_pylist()]
        one = batch_of(part, [[table.column("row")[0].as_py()], [np.sum(rows, axis=0).tobytes()]])
        return pa.Table.from_batches([one])

    ddl = "row int, sums binary"
    parts = labelled.filter(~F.col("calibrate")).select("stats", "label").coalesce(SUM_TASKS)
    rows = parts.mapInArrow(partial, ddl).groupBy("row").applyInArrow(added, ddl).collect()
    total = np.zeros((size, size + 1))
    for r in rows:
        total[r["row"]] = np.frombuffer(r["sums"])
    penalty = ridge * n / features * np.eye(size)
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])

    binned = pa.schema([("bin", pa.int32()), ("label", pa.int32())])

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.clip((model.ridge(matrix_of(batch)) + 0.5) / 2, 0, 1) * (BINS - 1)
            label = batch.column(batch.schema.get_field_index("label")).to_pylist()
            yield batch_of(binned, [np.round(place).astype(np.int32), label])

    held = labelled.filter("calibrate").select("stats", "label")
    counts = (
        held.mapInArrow(bins, "bin int, label int")
        .groupBy("bin")
        .agg(F.sum("label").alias("hits"), F.count("*").alias("n"))
        .orderBy("bin")
        .collect()
    )
    if counts:
        place = np.array([r["bin"] for r in counts]) / (BINS - 1) * 2 - 0.5
        hits = np.array([r["hits"] for r in counts], float)
        total = np.array([r["n"] for r in counts], float)
        model.knots, model.levels = isotonic(place, hits, total)
    return model


def with_scores(stats: DataFrame, model: Model) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of(schema, [values(batch, "doc_id"), model.score(matrix_of(batch))])

    return stats.select("doc_id", "stats").mapInArrow(run, "doc_id long, score double")


def training_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics with labels, of the folds that may be learned from."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & (fold("doc_id", FOLDS) != 0))
    return stats.join(known, "doc_id").select(
        "stats",
        F.col("label").cast("int").alias("label"),
        (fold("doc_id", FOLDS) == CALIBRATION_FOLD).alias("calibrate"),
    )


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score and verdict of every document: probability that its quality label is 1.

    Labels of documents with crc32(doc_id) mod 5 = 0 are never used; of the others, one
    fold calibrates. Only statistics of the text enter a score. A missing text is scored as
    an empty one, equal texts get equal scores, repeated rows are scored each, rows without
    doc_id count as held out (crc32 of an empty text is 0), labels other than 0 and 1 and
    labels without a document are left out, an empty table gives no rows. Columns other
    than doc_id and text (labels: doc_id and quality) are not looked at.
    """
    stats = materialize(document_statistics(docs), "text-statistics")
    model = fit(materialize(training_rows(stats, labels), "labelled-statistics"))
    return with_scores(stats, model).select(
        "doc_id",
        (fold("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, whose score reaches ``threshold``."""
    stats = materialize(document_statistics(docs), "text-statistics")
    model = fit(materialize(training_rows(stats, labels), "labelled-statistics"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            if batch.num_rows:
                stats = np.array([text_statistics(t) for t in utf8(batch, "text")])
                yield batch.filter(pa.array(model.score(stats) >= threshold))

    return docs.mapInArrow(run, docs.schema)
