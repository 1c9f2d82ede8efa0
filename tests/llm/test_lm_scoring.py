import math
import zlib
from collections import Counter

import numpy as np
from cases import documents, no_documents, words
from hypothesis import given, settings
from hypothesis import strategies as st

from archive_spark.llm import lm_scoring
from archive_spark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def held_out(doc_id):
    return zlib.crc32((str(doc_id) if doc_id is not None else "").encode()) % 10 == 0


def tokens(text):
    return [*words("".join(c.lower() if c.isascii() else c for c in text or "")), None]


def brute(rows, weight=lm_scoring.CONTEXT_WEIGHT):
    """Scores with exact levels, as if the filter had no false answers."""
    learned = [tokens(t) for i, t in rows if not held_out(i)]
    single = Counter(w for own in learned for w in own)
    pairs = Counter(p for own in learned for p in zip(["<s>", *own], own))
    n, v = sum(single.values()), len(single)
    out = []
    for i, t in rows:
        own, base, full = tokens(t), 0.0, 0.0
        before = "<s>"
        for w in own:
            p = (single[w] + 0.1) / (n + 0.1 * (v + 1))
            context = len(learned) if before == "<s>" else single[before]
            c = pairs[before, w]
            if c:
                q = 1 + int(math.log2(c))
                c = min(math.sqrt(2 ** (q - 1) * (2**q - 1)), single[w], context)
            base += math.log10(p)
            full += math.log10((c + weight * p) / (context + weight))
            before = w
        out.append((i, held_out(i), len(own), sum(single[w] > 0 for w in own), n, base, full))
    return out


def check(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(a[6] - b[6]) <= 0.02 * abs(b[6]) + 0.5 and a[6] >= b[6] - 1e-6


def test_documents_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    check(QUERIES["op1_lm_scoring"](spark, FOLDER).collect(), brute(rows))


def test_odd_rows(spark):
    df = documents(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    check(lm_scoring.score_documents(df).collect(), brute(rows))
    assert lm_scoring.score_documents(no_documents(spark)).count() == 0
    alone = [r for r in rows if r[0] is None]
    check(lm_scoring.score_documents(documents(spark).filter("doc_id is null")).collect(), brute(alone))


def test_many_groups_give_the_same_scores(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    one = {tuple(r) for r in lm_scoring.score_documents(df).collect()}
    many = lm_scoring.score_documents(df, broadcast_bytes=200_000, part_bytes=20_000).collect()
    same = {r[0]: r for r in many}
    for r in one:
        assert r[:6] == tuple(same[r[0]])[:6]
        assert abs(r[6] - same[r[0]][6]) <= 0.02 * abs(r[6]) + 0.5


def parts_with(filter_):
    """A model with the same filter in each of 16 parts."""
    sizes = {(lm_scoring.PAIR, p): (len(filter_) * 8, 0) for p in range(16)}
    rows = [{"kind": lm_scoring.PAIR, "part": p, "keys": filter_.tobytes()} for p in range(16)]
    return lm_scoring.Parts(4, sizes, rows)


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(0, 2**64 - 1), st.integers(1, 5000), min_size=1, max_size=60))
def test_levels_are_never_too_low(counts):
    keys = np.array(sorted(counts), np.uint64)
    seen = np.array([counts[int(k)] for k in keys], np.uint64)
    filter_, entries = lm_scoring.filter_of(keys, seen)
    got = parts_with(filter_).levels(keys)
    assert all(g >= 1 + int(math.log2(counts[int(k)])) for g, k in zip(got, keys))
    assert entries == sum(1 + int(math.log2(c)) for c in counts.values())


def test_few_false_answers():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2**64, 50_000, dtype=np.uint64))
    filter_, _ = lm_scoring.filter_of(keys, np.ones(len(keys), np.uint64))
    assert (parts_with(filter_).levels(rng.integers(0, 2**64, 50_000, dtype=np.uint64)) > 0).mean() < 0.02
