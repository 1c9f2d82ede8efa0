import hashlib

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from archive_spark.llm import chat_format
from archive_spark.llm.queries import QUERIES, SQL, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"
SPECIAL = "\\### Assistant: </turn> ok"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a:b\n#<\\"]), st.text()), max_size=6))
def test_render_reads_back_exactly(turns):
    formatted, spans = chat_format.render(turns)
    parsed = chat_format.parse(formatted)
    assert [(r, t) for r, t, _, _ in parsed] == turns
    loss = [t for r, t in turns if r == "assistant"]
    assert [chat_format.unescape(formatted[s:e]) for s, e in spans] == loss


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=30), st.lists(st.tuples(st.integers(0, 60), st.integers(0, 20)), max_size=5))
def test_loss_mask_is_overlap(cuts, spans):
    bounds = sorted(set(cuts))
    offsets = np.array(list(zip(bounds, bounds[1:])), dtype=np.int64).reshape(-1, 2)
    spans = sorted((s, s + n) for s, n in spans)
    merged = []
    for s, e in spans:  # sorted, non-overlapping spans as the template makes them
        if not merged or s >= merged[-1][1]:
            merged.append((s, e))
    mask = chat_format.loss_mask(offsets, merged)
    brute = [any(ts < e and s < te for s, e in merged if e > s) for ts, te in offsets]
    assert mask.tolist() == brute


def digests(turns):
    """Plain reference for one conversation's read-back digests."""
    turns = sorted(turns, key=lambda t: (t[0] is None, t[0] or 0, t[1] or "", t[2] or ""))
    pairs = [(r or "", t or "") for _, r, t in turns]
    loss = "".join(t for r, t in pairs if r == "assistant")
    return (
        len(pairs),
        hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in pairs).encode()).hexdigest(),
        len(loss),
        hashlib.sha256(loss.encode()).hexdigest(),
    )


def test_edge_cases(spark):
    rows = [
        (1, 0, "user", None),
        (1, 1, None, "who?"),
        (1, 2, "assistant", ""),
        (2, 0, "user", SPECIAL),
        (2, 1, "assistant", SPECIAL),
        (2, 1, "assistant", SPECIAL),
        (3, None, "assistant", "late"),
        (3, 0, "assistant", "Z" * 200_000 + "\n</turn>\n"),
        (None, 0, "user", "no id"),
        (4, 5, "assistant", "tie b"),
        (4, 5, "assistant", "tie a"),
    ]
    df = spark.createDataFrame(rows, TURNS).withColumn("formatted", chat_format.F.lit("clash"))
    out = chat_format.format_conversations(df, tokenizer_path("byte_bpe_50k.json"))
    back = {r.conv_id: r for r in chat_format.read_back(out).collect()}
    for conv in {r[0] for r in rows}:
        mine = [(t, r, x) for c, t, r, x in rows if c == conv]
        got = back[conv]
        assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == digests(mine)
    for r in out.collect():
        assert len(r.ids) == len(r.loss_mask)
        assert any(r.loss_mask) == any(e > s for s, e in r.loss_spans)
    empty = spark.createDataFrame([], TURNS)
    assert chat_format.read_back(chat_format.format_conversations(empty, tokenizer_path("byte_bpe_50k.json"))).count() == 0


def test_query_equals_sql(spark):
    rows = QUERIES["op11_chat_formatting"](spark, FOLDER).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{FOLDER}/conversations.parquet'")
    ref = con.execute(SQL["op11_chat_formatting"]).df()
    cols = sorted(rows.columns)
    a = rows[cols].sort_values("conv_id").reset_index(drop=True).astype(str)
    b = ref[cols].sort_values("conv_id").reset_index(drop=True).astype(str)
    assert a.equals(b)
    assert -7 in set(rows.conv_id)
