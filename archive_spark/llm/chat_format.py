"""Chat formatting with offset-aligned loss masks.

Each conversation is rendered whole by a template that marks turns and escapes its own
control characters inside texts, so any text reads back exactly. The rendered text is
encoded once with character offsets, and the sorted spans of assistant texts are
intersected with the sorted token spans by binary search: a token carries loss where it
overlaps an assistant text. Turns of a conversation meet in one group, since they become
one value; conversations are spread over tasks by their id.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the template: a turn is HEADER, the escaped text, FOOTER.
# Characters escaped by a backslash in texts: backslash, '#', '<'; in roles also ':' and a newline.
HEADER = "### {role}:\n"
FOOTER = "</turn>\n"
LOSS_ROLE = "assistant"

_TEXT_SPECIAL = re.compile(r"([\\#<])")
_ROLE_SPECIAL = re.compile(r"([\\#<:\n])")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:\\.|[^\\#<:\n])*):\n((?:\\.|[^\\#<])*)</turn>\n", re.S)

FORMATTED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("loss_spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("loss_mask", T.ArrayType(T.BooleanType())),
    ]
)

READ_BACK = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_loss_tokens", T.LongType()),
    ]
)


def escape_text(text: str) -> str:
    return _TEXT_SPECIAL.sub(r"\\\1", text)


def escape_role(role: str) -> str:
    return _ROLE_SPECIAL.sub(r"\\\1", role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans (code points) of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = HEADER.format(role=escape_role(role)), escape_text(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, FOOTER]
        at += len(head) + len(body) + len(FOOTER)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn of a formatted conversation; the span is the escaped text's."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"not a formatted conversation at {at}")
        turns.append((unescape(found.group(1)), unescape(found.group(2)), found.start(2), found.end(2)))
        at = found.end()
    return turns


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tokens (sorted (start, end) offsets) that overlap any of the sorted ``spans``."""
    mask = np.zeros(len(offsets), dtype=bool)
    if len(offsets) == 0:
        return mask
    starts, ends = offsets[:, 0], offsets[:, 1]
    for start, end in spans:
        if end > start:
            mask[np.searchsorted(ends, start, "right") : np.searchsorted(starts, end, "left")] = True
    return mask


class _Encoder:
    kept: dict[str, object] = {}

    @classmethod
    def of(cls, path: str):
        if path not in cls.kept:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            cls.kept[path] = tokenizer
        return cls.kept[path]


def format_conversations(turns: DataFrame, tokenizer: str) -> DataFrame:
    """One formatted text per conversation with its token ids and loss mask.

    ``turns`` has a row per turn: ``conv_id``, ``turn``, ``role``, ``text``; other columns,
    whatever their names, are ignored. Turns are ordered by ``turn`` (nulls last), ties by
    role and text; repeated rows stay separate turns. A null text is empty, a null role the
    empty role; only the role ``assistant`` carries loss. Rows with a null ``conv_id`` form
    one conversation of their own. Texts of any length are formatted whole. An empty
    table gives no rows.

    Returns ``conv_id``, ``formatted``, ``loss_spans`` (start and end of each assistant text
    in ``formatted``, code points, end exclusive), ``ids`` (``tokenizer``, a file of the
    tokenizers library, with its special strings read as text) and ``loss_mask`` (per id).
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["turn", "role", "text"], na_position="last", kind="stable")
        formatted, spans = render(list(zip(group["role"], group["text"])))
        encoded = _Encoder.of(tokenizer).encode(formatted, add_special_tokens=False)
        offsets = np.array(encoded.offsets, dtype=np.int64).reshape(-1, 2)
        mask = loss_mask(offsets, spans)
        return pd.DataFrame(
            {
                "conv_id": [group["conv_id"].iloc[0]],
                "formatted": [formatted],
                "loss_spans": [[list(s) for s in spans]],
                "ids": [list(encoded.ids)],
                "loss_mask": [mask.tolist()],
            }
        )

    return rows.groupBy("conv_id").applyInPandas(one, FORMATTED)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests read back from the output of ``format_conversations``.

    Turns are parsed from the formatted text and unescaped; the loss text is what the
    loss spans cover, unescaped, in order. ``turns_sha256`` is the digest of role, newline,
    text, newline per turn; ``loss_chars`` and ``formatted_chars`` count code points.
    """

    def run(batches):
        for batch in batches:
            out = []
            for conv_id, text, spans, mask in zip(
                batch["conv_id"], batch["formatted"], batch["loss_spans"], batch["loss_mask"]
            ):
                turns = parse(text)
                loss = "".join(unescape(text[int(s) : int(e)]) for s, e in spans)
                out.append(
                    (
                        conv_id,
                        len(turns),
                        _sha("".join(f"{role}\n{body}\n" for role, body, _, _ in turns)),
                        len(loss),
                        _sha(loss),
                        len(text),
                        len(mask),
                        int(np.count_nonzero(np.asarray(mask, dtype=bool))),
                    )
                )
            yield pd.DataFrame(out, columns=READ_BACK.fieldNames())

    return formatted.mapInPandas(run, READ_BACK)
