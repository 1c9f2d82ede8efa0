import zlib
from collections import defaultdict

from cases import TEXTS, documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from archive_spark.llm import sharding
from archive_spark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def check(rows, shards=40):
    assert {r.law for r in rows} == {"bytes"}
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert all(0 <= s < shards for s in by_shard)
    return [sum(r["size"] for r in by_shard[s]) for s in range(shards)]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 1000), max_size=200), st.integers(1, 12))
def test_schedule_is_longest_processing_time(sizes, shards):
    placed = sharding.schedule(list(enumerate(sizes)), shards)
    loads = [sum(s for k, s in enumerate(sizes) if placed[k] == shard) for shard in range(shards)]
    if sizes:
        assert max(loads) - min(loads) <= max(sizes)
        assert max(loads) <= (4 / 3) * max(sum(sizes) / shards, max(sizes)) + max(sizes) / 3


def test_documents_table(spark):
    rows = QUERIES["op2_sharding"](spark, FOLDER).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    loads = check(rows)
    where = defaultdict(set)
    groups = defaultdict(int)
    for r in rows:
        text = docs[r.doc_id] or ""
        assert r["size"] == len(text.encode()) + 16 and r.text_crc32 == zlib.crc32(text.encode())
        assert r.grown_shard is None
        where[text].add(r.shard)
        groups[text] += r["size"]
    assert all(len(s) == 1 for s in where.values())
    assert max(loads) - min(loads) <= max(groups.values())


def test_odd_rows(spark):
    rows = sharding.shard_documents(documents(spark)).collect()
    assert len(rows) == len(TEXTS) + 3
    check(rows)
    assert len({r.shard for r in rows if r.text_crc32 == zlib.crc32((TEXTS[0]).encode())}) == 1
    assert sharding.shard_documents(no_documents(spark)).count() == 0


def test_hot_group_and_small_entry_limit(spark):
    """A third of all rows in one group, and far fewer heap entries than groups."""
    texts = ["hot " * 50] * 300 + [f"text {i} " * (i % 17 + 1) for i in range(600)]
    docs = documents(spark, texts, extra=False)
    rows = docs.selectExpr("doc_id", "text as key", "length(text) + 16 as size")
    placed = sharding.assign_shards(rows, "key", "size", shards=4, entries_per_shard=8)
    slots = sharding.number_slots(placed, [placed["doc_id"], placed["key"]], slot_rows=50).collect()
    where = defaultdict(set)
    for r in slots:
        where[r.key].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    for shard in range(4):
        own = sorted(r.slot for r in slots if r.shard == shard)
        assert own == list(range(len(own)))
