import random
from collections import Counter, defaultdict

import pytest
from cases import TEXTS, documents, no_documents, words

from archive_spark.llm import jaccard_join
from archive_spark.llm.queries import QUERIES


def shingle_set(text):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    """Class and links of each (doc_id, text), by comparing all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    linked = defaultdict(set)
    by_text = defaultdict(list)
    for i, (_, t) in enumerate(rows):
        by_text[t or ""].append(i)
    for group in by_text.values():
        for i in group:
            linked[i].update(j for j in group if j != i)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j > i)
        for j, n in shared.items():
            if n / (len(s) + len(sets[j]) - n) >= 0.8 - 1e-12:
                linked[i].add(j)
                linked[j].add(i)
    root = {}
    for i in range(len(rows)):
        if i in root:
            continue
        todo, seen = [i], {i}
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        for j in seen:
            root[j] = min(ids) if ids else None
    return sorted(((rows[i][0], root[i], len(linked[i])) for i in range(len(rows))), key=repr)


def got(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in df.collect()), key=repr)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_documents_table(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert got(QUERIES["op3_jaccard_join"](spark, folder)) == brute(docs)


def near_copies(n, length, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(length)] = f"new{rng.randrange(10_000)}"
        out.append(" ".join(copy))
    return out


def test_large_group_in_blocks(spark):
    texts = near_copies(120, 150, 1) + near_copies(3, 40, 2) + ["hot copy of a text in six words"] * 80
    texts += [f"a passage of its own number {i} and " + "then more words of it " * 3 for i in range(40)]
    df = documents(spark, texts, extra=False)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(jaccard_join.near_duplicates(df, block=16)) == brute(rows)


def test_odd_rows(spark):
    df = documents(spark, TEXTS + ["ONE", "one two three FOUR", "  ", "\n"])
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(jaccard_join.near_duplicates(df)) == brute(rows)
    assert jaccard_join.near_duplicates(no_documents(spark)).count() == 0


def test_prefix_is_shortened_until_the_recall_is_met():
    length = jaccard_join.prefix_length(0.8, 20, 8, 0.9995)
    assert length == 5
    assert 1 - (1 - 0.8**length) ** 20 >= 0.9995 > 1 - (1 - 0.8 ** (length + 1)) ** 20
    with pytest.raises(ValueError):
        jaccard_join.prefix_length(0.1, 2, 8, 0.99)


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in jaccard_join.components(df).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, 101: 100}
