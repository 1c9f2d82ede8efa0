import random
import re

import numpy as np
import pytest
from cases import TEXTS, documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from archive_spark.llm import decontaminate as dc
from archive_spark.llm.queries import QUERIES


def plain(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def grams(words):
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def contained(text, items):
    """Items with 80 % of their shingles within some stretch of about their size."""
    words = plain(text)
    out = {}
    for item, own in items:
        size = len(plain(own))
        want = grams(plain(own))
        if not want or not want & grams(words):
            continue
        reach = size + size // 2 + 8
        spans = range(0, max(1, len(words) - reach + 1))
        out[item] = max(len(want & grams(words[s : s + reach])) / len(want) for s in spans)
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_documents_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = {(d.doc_id, i) for d in docs for i, s in contained(d.text, items).items() if s >= 0.8}
    rows = QUERIES["op8_benchmark_decontamination"](spark, folder).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want)
    assert all(r.hamming <= dc.RADIUS and r.similarity >= 0.8 for r in rows)


def test_planted_at_every_offset_and_damaged(spark):
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(400)] + ["the", "of", "and", "to", "in"] * 30
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(12, 70)))) for k in range(30)]
    texts, want = [], set()
    for n in range(600):
        k, own = items[n % 30]
        words = own.split()
        if n % 4 == 1:
            words[len(words) // 2] = "changed"
        if n % 4 == 2:
            words = [w.upper() + "," for w in words]
        before = rng.choices(vocabulary, k=rng.randrange(0, 80))
        after = rng.choices(vocabulary, k=rng.randrange(0, 80))
        if n % 4 == 3:
            words = words[: len(words) // 2]
        texts.append(" ".join(before + words + after))
        if contained(texts[-1], [items[n % 30]]).get(k, 0) >= 0.8:
            want.add((n, k))
    docs = documents(spark, texts, extra=False).filter("doc_id is not null").dropDuplicates(["doc_id"])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dc.find_passages(docs, bench, items_at_once=7).collect()}
    assert len(got & want) >= 0.99 * len(want)
    assert not {x for x in got - want if x[0] % 4 == 3}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=20), st.integers(0, 2**32))
def test_no_fingerprint_within_the_radius_is_missed(prints, seed):
    rng = np.random.default_rng(seed)
    items = dc.Items([(k, b"one two three four five six seven eight") for k in range(len(prints))], dc.RADIUS)
    items.prints = np.array(prints, np.uint64)
    items.index = {8: items.blocks(np.arange(len(prints)))}
    probes = []
    for p in prints:
        flips = rng.choice(64, rng.integers(0, 22), replace=False)
        probes.append(p ^ int(sum(1 << int(b) for b in flips)))
    probes = np.array(probes, np.uint64)
    window, item, distance = items.near(8, probes)
    got = set(zip(window.tolist(), item.tolist()))
    apart = np.bitwise_count(probes[:, None] ^ items.prints[None, :])
    assert got == {(int(w), int(k)) for w, k in zip(*np.nonzero(apart <= dc.RADIUS))}


def test_odd_rows(spark):
    bench = spark.createDataFrame(
        [(1, TEXTS[0]), (2, None), (3, ""), (None, TEXTS[0]), (4, "one two three four"), (1, TEXTS[0])],
        "item_id long, text string",
    )
    rows = dc.find_passages(documents(spark), bench).collect()
    held = [r.doc_id for r in rows if r.item_id == 1]
    assert sorted(set(held), key=str) == [0, 1, 2, None]
    assert {r.doc_id for r in rows if r.item_id == 4} == {7}
    assert dc.find_passages(no_documents(spark), bench).count() == 0
    assert dc.find_passages(documents(spark), bench.limit(0)).count() == 0
    left = dc.without_passages(documents(spark), bench)
    assert left.columns == documents(spark).columns
    assert left.count() == len(TEXTS) - 4


def test_items_longer_than_any_window(spark):
    rng = random.Random(9)
    long = " ".join(f"w{rng.randrange(900)}" for _ in range(700))
    texts = ["before it " * 9 + long + " after it" * 9, long, " ".join(long.split()[:300])]
    bench = spark.createDataFrame([(5, long)], "item_id long, text string")
    got = dc.find_passages(documents(spark, texts, extra=False), bench).collect()
    assert {r.doc_id for r in got} == {0, 1, None}


def test_long_items_without_their_beginning(spark):
    rng = random.Random(13)
    items, texts, want = [], [], set()
    for k, n in enumerate([257, 300, 450, 512, 513, 700, 1000, 1000, 2500, 6000] * 2):
        words = [f"w{rng.randrange(5000)}" for _ in range(n)]
        items.append((k, " ".join(words)))
        lost, hole = int(0.19 * n), int(0.17 * n)
        for left in (words[lost:], words[:-lost], words[: n // 2] + words[n // 2 + hole :]):
            around = [[f"v{rng.randrange(5000)}" for _ in range(rng.randrange(400))] for _ in range(2)]
            want.add((len(texts), k))
            texts.append(" ".join(around[0] + left + around[1]))
        texts.append(" ".join(words[: n // 2]))
    docs = documents(spark, texts, extra=False).filter("doc_id is not null").dropDuplicates(["doc_id"])
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in dc.find_passages(docs, bench).collect()} == want


def test_groups_of_items_change_nothing(spark):
    rng = random.Random(21)
    shared = [f"s{k}" for k in range(30)]
    items = [(k, " ".join([f"i{k}x{j}" for j in range(12)] + shared)) for k in range(8)]
    items += [(8, " ".join(shared)), (9, items[0][1]), (10, "of four words only"), (11, "")]
    items.append((12, " ".join(f"w{rng.randrange(300)}" for _ in range(600))))
    texts = [text for _, text in items]
    texts += [" ".join(["before"] * n + text.split()[: 43 - n] + ["after"] * n) for _, text in items for n in range(9, 18)]
    docs = documents(spark, texts, extra=False)
    bench = spark.createDataFrame(items, "item_id long, text string")

    def found(at_once):
        return sorted(map(str, dc.find_passages(docs, bench, items_at_once=at_once).collect()))

    whole = found(1000)
    assert len(whole) > 40 and found(1) == whole and found(5) == whole
    kept = dc.without_passages(docs, bench).count()
    assert dc.without_passages(docs, bench, items_at_once=5).count() == kept


def test_short_items_in_longer_documents(spark):
    rng = random.Random(31)
    items = [(n, " ".join(f"q{n}x{j}" for j in range(n))) for n in range(1, 10)]
    texts, want = [], set()
    for n, own in items * 15:
        around = [" ".join(f"v{rng.randrange(5000)}" for _ in range(rng.randrange(1, 60))) for _ in range(2)]
        want.add((len(texts), n))
        texts += [f"{around[0]} {own.upper()}, {around[1]}", f"{around[0]} {around[1]} {own[:-1]}"]
    docs = documents(spark, texts, extra=False).filter("doc_id is not null").dropDuplicates(["doc_id"])
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = dc.find_passages(docs, bench).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert {x for x in got if x[1] < 8} == {x for x in want if x[1] < 8}
    first = {r.doc_id: r for r in rows if r.item_id == 3}
    assert all(plain(texts[d])[r.first_word : r.first_word + r.n_words] == plain(items[2][1]) for d, r in first.items())
