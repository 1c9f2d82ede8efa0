from cases import TEXTS, documents, no_documents, words

from archive_spark.llm import rules
from archive_spark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, dup, len(covered)


def check(rows, texts):
    for r in rows:
        want = brute(texts(r.doc_id))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert r.base_failed == failed
        assert not (failed and r.kept)


def test_documents_table(spark):
    rows = QUERIES["op5_quality_rules"](spark, FOLDER).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    check(rows, docs.get)


def test_posterior_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op5_quality_rules"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    joined = rows.join(labels, "doc_id").collect()
    good = [r.kept for r in joined if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in joined if r.quality == 0]
    assert sum(good) / len(good) > 0.98
    assert sum(bad) / len(bad) < 0.5


def test_odd_rows(spark):
    rows = rules.quality_rules(documents(spark)).collect()
    assert len(rows) == len(TEXTS) + 3
    check(rows, lambda i: TEXTS[i] if i is not None else TEXTS[0])
    assert rules.quality_rules(no_documents(spark)).count() == 0


def test_expectation_maximisation_finds_planted_accuracies():
    import random

    random.seed(3)
    truth = [(0.99, 0.6), (0.97, 0.5), (0.98, 0.8), (0.95, 0.7), (0.99, 0.4)]
    counts = {}
    for _ in range(40_000):
        good = random.random() < 0.8
        votes = []
        for on_good, on_bad in truth:
            if random.random() < 0.2:
                votes.append(0)
            elif good:
                votes.append(1 if random.random() < on_good else -1)
            else:
                votes.append(-1 if random.random() < on_bad else 1)
        counts[tuple(votes)] = counts.get(tuple(votes), 0) + 1
    share, found = rules.accuracies(counts)
    assert abs(share - 0.8) < 0.03
    for (a, b), (c, d) in zip(truth, found):
        assert abs(a - c) < 0.02 and abs(b - d) < 0.08


def test_plan_has_no_python(spark):
    plan = rules.text_counts(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
