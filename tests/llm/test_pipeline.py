import pytest
import test_decontaminate
import test_jaccard_join
import test_packing
import test_secrets
from cases import TEXTS, documents, no_documents

import __spark_entry__ as entry
import corpus_pipeline as cp
from archive_spark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        kept = stage(spark, out[-1], FOLDER)
        out.append(spark.createDataFrame(kept.collect(), kept.schema))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality_keeps_what_the_query_predicts(spark, stages):
    want = {r.doc_id for r in QUERIES["op4_quality_classifier"](spark, FOLDER).collect() if r.predicted}
    before, after = rows(stages[0]), rows(stages[1])
    assert set(after) == want and all(after[i] == before[i] for i in after)


def test_one_of_each_group_stays(stages):
    before = rows(stages[1])
    classes = test_jaccard_join.brute([(i, r.text) for i, r in before.items()])
    after = rows(stages[2])
    assert set(after) == {c for _, c, _ in classes} and all(after[i] == before[i] for i in after)


def test_leaks_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before, after = rows(stages[2]), rows(stages[3])
    leaks = {i for i, r in before.items() if max(test_decontaminate.contained(r.text, items).values(), default=0) >= 0.8}
    assert set(after) == set(before) - leaks and all(after[i] == before[i] for i in after)


def test_secrets_are_masked_and_the_rest_stays(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    for i, r in after.items():
        assert not test_secrets.brute(r.text)[0]
        if not test_secrets.brute(before[i].text)[0] and "[SECRET]" not in r.text:
            assert r == before[i]
        assert r.n_chars == len(r.text)


def test_packing_holds_all_that_is_left(stages):
    texts = {i: r.text for i, r in rows(stages[4]).items()}
    pieces = stages[5].collect()
    assert {r.doc_id for r in pieces} == set(texts)
    assert test_packing.check(pieces, texts.get) < 0.01


def test_registered_query_and_columns(spark, stages):
    assert entry.queries()["pipeline"] is cp.run
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    got = sorted((r.doc_id, r.start, r.ids_crc32) for r in cp.run(spark, FOLDER).collect())
    want = sorted((r.doc_id, r.start, r.ids_crc32) for r in stages[5].collect())
    assert {g[0] for g in got} == {w[0] for w in want}


def test_odd_rows_in_every_stage(spark):
    for df in (documents(spark), no_documents(spark)):
        docs = df
        for _, stage in cp.STAGES[:-1]:
            kept = stage(spark, docs, FOLDER)
            assert kept.columns == df.columns
            docs = spark.createDataFrame(kept.collect(), kept.schema)
        assert cp.packed(spark, docs, FOLDER).count() >= (0 if docs.isEmpty() else 1)


def test_one_of_each_with_repeated_and_nameless_rows(spark):
    df = documents(spark)
    kept = cp.near_duplicates(spark, df, FOLDER).collect()
    assert sorted(r.doc_id for r in kept if r.text and "harbour" in r.text) == [0]
    nameless = df.filter("doc_id is null").union(df.filter("doc_id is null"))
    assert cp.near_duplicates(spark, nameless, FOLDER).count() == 1
    assert len(TEXTS) > len(kept)
