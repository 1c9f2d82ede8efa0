import zlib

import numpy as np
from cases import TEXTS, documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from archive_spark.llm import quality
from archive_spark.llm.queries import QUERIES


def held_out(doc_id):
    return zlib.crc32((str(doc_id) if doc_id is not None else "").encode()) % 5 == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    rows = QUERIES["op4_quality_classifier"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    got = {r.doc_id: r for r in rows.collect()}
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in got.values():
        assert r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1
        assert r.predicted == (r.score >= 0.3)
    seen = [(got[r.doc_id], r.quality) for r in labels.collect() if r.doc_id in got]
    seen = [(r, q) for r, q in seen if r.held_out]
    right = [r.predicted == q for r, q in seen]
    kept = [r.predicted for r, q in seen if q == 1]
    assert sum(right) / len(right) > 0.95
    assert sum(kept) / len(kept) > 0.98


def test_fourier_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(1)
    width, many = quality.WIDTH, 20_000
    model = quality.Model(
        np.zeros(width),
        np.ones(width),
        rng.normal(size=(width, many)) / np.sqrt(width),
        rng.uniform(0, 2 * np.pi, many),
        np.zeros(many + 1),
        np.array([0.0]),
        np.array([0.5]),
    )
    x = rng.normal(size=(20, width))
    z = model.map(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(2)
    assert np.abs(z @ z.T - np.exp(-distance / (2 * width))).max() < 0.04


def test_partition_sums_give_the_ridge_solution(spark):
    rng = np.random.default_rng(2)
    stats = rng.normal(size=(400, quality.WIDTH))
    label = (stats[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(int)
    rows = [(s.tolist(), int(y), i % 4 == 0) for i, (s, y) in enumerate(zip(stats, label))]
    df = spark.createDataFrame(rows, "stats array<double>, label int, calibrate boolean")
    model = quality.fit(df.repartition(7), features=32)
    keep = np.arange(400) % 4 != 0
    z = model.map(stats[keep])
    penalty = quality.RIDGE * keep.sum() / 32 * np.eye(33)
    penalty[-1, -1] = 1e-9
    want = np.linalg.solve(z.T @ z + penalty, z.T @ label[keep])
    assert np.allclose(model.weights, want, atol=1e-6)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 5)), min_size=1, max_size=30))
def test_isotonic_levels_rise_and_keep_the_mean(pairs):
    total = np.array([n for _, n in pairs], float)
    hits = np.array([min(h, n) for h, n in pairs], float)
    knots, levels = quality.isotonic(np.arange(len(pairs)) * 1.0, hits, total)
    assert (np.diff(levels) >= 0).all() and (np.diff(knots) > 0).all()
    assert levels.min() >= (hits / total).min() and levels.max() <= (hits / total).max()


def test_odd_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(len(TEXTS))] + [(1, 0, 0), (999, 1, 0), (None, 1, 0), (2, None, 0), (3, 7, 0)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == len(TEXTS) + 3
    assert all(r.held_out == held_out(r.doc_id) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1)}) == 1
    assert quality.quality_scores(no_documents(spark), labels).count() == 0
    none = quality.quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
