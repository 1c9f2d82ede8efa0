import hashlib
import random

import numpy as np
import pytest
from cases import TEXTS, documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from archive_spark.llm import suffix_dedup as sd
from archive_spark.llm.queries import QUERIES


def brute(rows):
    """Rows by rising id; the first place of every 100-byte string is remembered."""
    first, docs = {}, []
    for doc_id, text in sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0]):
        data = (text or "").encode()
        docs.append((doc_id, data))
    out, done = [], {}
    for doc_id, data in docs:
        if (doc_id, data) not in done:
            gone = bytearray(len(data))
            for s in range(len(data) - 99):
                key = data[s : s + 100]
                if first.setdefault(key, (doc_id, s)) != (doc_id, s):
                    gone[s : s + 100] = b"\1" * 100
            spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
            kept = bytes(b for b, g in zip(data, gone) if not g)
            done[doc_id, data] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
        out.append((doc_id, *done[doc_id, data]))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_documents_table(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert got(QUERIES["op10_suffix_array_dedup"](spark, folder)) == brute(rows)


def planted():
    rng = random.Random(8)
    line = "A line of boiler plate that very many of these documents share with each other, word by word, to the end. "
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    texts = []
    for i in range(120):
        own = "".join(rng.choice("ijklmnopq é") for _ in range(rng.randrange(50, 400)))
        cut = rng.randrange(0, 300)
        texts.append(own + (line if i % 3 else "") + passage[cut : cut + rng.randrange(90, 300)] + own[:150])
    return texts + ["ab" * 400, "ab" * 90, "x" * 99, "x" * 100, "x" * 101, "x" * 3000]


@pytest.mark.parametrize("hot", [3, 50_000])
def test_planted_passages(spark, hot):
    df = documents(spark, planted(), extra=False).repartition(5)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(sd.remove_repeats(df, hot=hot)) == brute(rows)


@pytest.mark.parametrize("hot", [3, 50_000])
def test_planted_passages_over_many_blocks(spark, hot):
    df = documents(spark, planted() * 2, extra=False).repartition(5)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(sd.remove_repeats(df, hot=hot, part_bytes=3000)) == brute(rows)


@pytest.mark.parametrize("copies", [0, 300])
def test_blocks_are_shuffled_once_for_all_three_readers(spark, copies, capsys):
    texts = [f"{i} " * 60 for i in range(40)] + ["short"] * 20
    df = documents(spark, texts, extra=False).filter("doc_id > 0")
    again = f"explode(array_repeat(doc_id, {copies})) doc_id"
    df = df.unionByName(df.filter("doc_id = 7").selectExpr(again, "text", "lang", "source", "n_chars"))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    result = sd.remove_repeats(df, part_bytes=1000)
    assert got(result) == brute(rows)
    result.explain()
    final = capsys.readouterr().out.split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 2 and "Broadcast" not in final


def unlike(n, seed=5):
    """Texts without a common string of 50 bytes."""
    rng = np.random.default_rng(seed)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz      ", np.uint8)
    return [letters[rng.integers(0, 32, 4000)].tobytes() for _ in range(n)]


def test_parts_get_equal_shares_of_anchors():
    kh = sd.Contexts(unlike(250)).kh
    counts = np.bincount(sd.key_share(sd.anchor_keys(kh), 64), minlength=64)
    assert len(kh) > 30_000 and counts.max() < 1.3 * counts.mean()


def test_only_repeated_anchors_are_sent(spark):
    """However many anchors stand once, what is sent follows from the repeated ones."""
    passage = "p" * 20 + "".join(chr(97 + i * 7 % 26) for i in range(300))
    texts = [t.decode() for t in unlike(1000)]
    texts[10:900:10] = [f"{t}{passage}{i}" for i, t in enumerate(texts[10:900:10])]
    rows, unique = sd._keyed(documents(spark, texts, extra=False).filter("doc_id > 0"))
    n = sd._shares(rows, 1 << 18)
    assert unique and n > 8
    blocks = sd._blocks(rows, unique, n)
    sent = sd._anchor_rows(blocks, sd._verdicts(blocks, n, sd.HOT_CONTEXTS), n).collect()
    columns = [sd.unpacked(r.size, r.packed, 7)[0] for r in sent if r.kind == 0]
    kh, ch, ids, _, low, high, has = (np.concatenate([c[k] for c in columns]) for k in range(7))
    by_id = {i: t.encode() for i, t in enumerate(texts)}
    assert all(passage.encode()[25:60] in by_id[i] for i in set(ids.tolist()))
    begin = np.array([by_id[i].find(passage.encode()) for i in ids.tolist()])
    assert np.all((begin < high) & (low < begin + len(passage) + 1))
    # Bytes go once for each context of an anchor with several.
    several = [k for k in set(kh.tolist()) if len(set(ch[kh == k].tolist())) > 1]
    pairs = {(k, c) for k, c in zip(kh.tolist(), ch.tolist()) if k in several}
    assert several and has.sum() == len(pairs)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**48 - 1), st.integers(0, 2**64 - 1)), unique=True))
def test_packed_keys(pairs):
    pairs = np.array(sorted(pairs), np.uint64).reshape(-1, 2)
    key, ch = sd.unpacked_keys(*sd.packed_keys(pairs[:, 0], pairs[:, 1]))
    assert key.tolist() == pairs[:, 0].tolist() and ch.tolist() == pairs[:, 1].tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 4))), st.integers(2, 4))
def test_verdicts(entries, hot):
    told = sd.verdicts(*(np.array([e[k] for e in entries], np.uint64) for k in range(2)), hot)
    sent = {}
    for (key, ch), t in zip(entries, told.tolist()):
        own = [e for e in entries if e[0] == key]
        several = len(set(own))
        assert (t == sd.HOT) == (several >= hot) and (t == sd.ONCE) == (len(own) == 1)
        sent[key, ch] = sent.get((key, ch), 0) + (t == sd.WANTED)
        if several == 1:
            assert t != sd.WANTED
    for (key, ch), times in sent.items():
        assert times == (1 < len({e for e in entries if e[0] == key}) < hot)


def test_odd_rows(spark):
    df = documents(spark, TEXTS)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(sd.remove_repeats(df)) == brute(rows)
    assert sd.remove_repeats(no_documents(spark)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(1 + x % 3 for x in b)), max_size=6))
def test_two_stage_order(strings):
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    order = sd.two_stage_order(data, 12)
    assert sorted(order.tolist()) == list(range(len(data)))
    whole = data.tobytes() + b"\0" * 12
    keys = [whole[i : i + 12] for i in order]
    for a, b in zip(keys, keys[1:]):
        assert a <= b


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=200), min_size=1, max_size=5), st.integers(1, 20))
def test_contexts_cover_every_string_once(texts, _):
    c = sd.Contexts(texts)
    seen = sorted((int(d), s) for d, a, b in zip(c.doc, c.low, c.high) for s in range(a, b - 99))
    want, at = [], 0
    for d, t in enumerate(texts):
        want += [(d, at + s) for s in range(len(t) - 99)]
        at += len(t)
    assert seen == want
