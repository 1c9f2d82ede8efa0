import zlib
from array import array
from collections import defaultdict

import pytest
from cases import TEXTS, documents, no_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from archive_spark.llm import packing
from archive_spark.llm.queries import QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
TOKENIZER = Tokenizer.from_file(tokenizer_path())


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check(rows, texts, copies=lambda doc_id: 1, limit=packing.MAX_SEGMENTS):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc_id, own in pieces.items():
        ids = ids_of(texts(doc_id))
        times = defaultdict(int)
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert r.doc_tokens == len(ids) and r.length == len(part) > 0
            assert r.ids_crc32 == zlib.crc32(array("I", part).tobytes())
            for k in range(r.start, r.start + r.length):
                times[k] += 1
        assert set(times) == set(range(len(ids))) and set(times.values()) == {copies(doc_id)}
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY and len(own) <= limit
        padding += 0 if at & (at - 1) == 0 else packing.CAPACITY - at
    return padding / max(1, sum(r.length for r in rows))


def test_documents_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op7_packing"](spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == set(docs)
    assert check(rows, docs.get) < 0.01


def test_odd_rows(spark):
    rows = packing.pack_documents(documents(spark), tokenizer_path()).collect()
    twice = lambda i: {0: 3}.get(i, 1)
    check(rows, lambda i: TEXTS[i] if i is not None else TEXTS[0], twice)
    assert packing.pack_documents(no_documents(spark), tokenizer_path()).count() == 0


@pytest.mark.parametrize("cached", [3, 400_000])
def test_tokens_equal_the_library(cached, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", cached)
    texts = [
        "Don't stop! 12345 étude x ̈y <|endoftext|> a<|startoftext|>b",
        "tab\tand\r\nreturn   line　wide   ",
        "̈lead  two  blanks ",
        *(t or "" for t in TEXTS),
    ]
    encode = packing.WordTokenizer(tokenizer_path())
    got = encode(texts)
    for text, ids in zip(texts, got):
        assert list(array("I", ids)) == ids_of(text)[:-1]


def test_limits_on_segments_and_loss(spark):
    docs = documents(spark, [f"short text {i}" for i in range(500)], extra=False)
    docs = docs.withColumn("prompt", F.lit(2)).coalesce(1)
    rows = packing.pack_documents(
        docs, tokenizer_path(), capacity=256, max_segments=10, max_loss=40, prompt="prompt"
    ).collect()
    loss, segments = defaultdict(int), defaultdict(int)
    for r in rows:
        loss[r.sequence_id] += r.loss_tokens
        segments[r.sequence_id] += 1
        assert r.loss_tokens == max(0, r.start + r.length - max(r.start, 2))
    assert max(loss.values()) <= 40 and max(segments.values()) <= 10
