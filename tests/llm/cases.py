"""Documents that every operator has to survive, and plain reference computations."""

from __future__ import annotations

import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

PROSE = (
    "The harbour office kept a ledger of every vessel that came in on the evening tide, and "
    "the clerk who wrote it had a steady hand. On calm days he noted the colour of the sails, "
    "the names of the pilots and what the crews said about the weather beyond the point."
)

TEXTS = [
    PROSE,
    PROSE,
    PROSE + " Nobody has read it since.",
    "",
    None,
    "   \n\t ",
    "one",
    "one two three four",
    "AN!! UPPER!! CASE!! SHOUT!! " * 30,
    "the same five words again " * 40,
    "line one here\nline one here\n\n  \nline two\nline one here",
    "naïve café façade über straße ñandú " * 12,
    "a b c \U0001f600 d\x0be\x0cf\x1cg",
    "x" * 5000,
    " ".join(f"word{i}" for i in range(30_000)),
    "tie tie tie",
    "tie tie tie",
]


def documents(spark, texts=TEXTS, extra=True):
    """The texts as documents; repeated rows, a missing id and columns with clashing names."""
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    if texts:
        rows += [rows[0], rows[0], (None, texts[0], None, None, None)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    if extra:
        for name in ("_text", "_words", "h", "size", "shard", "start", "score", "kept", "key", "_n"):
            df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
