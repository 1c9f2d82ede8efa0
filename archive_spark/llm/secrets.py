"""Secrets in texts: fixed patterns, and strings more like random ones than identifiers.

Two first-order Markov models over characters are trained on labelled samples, one of random
strings and one of ordinary identifiers. A long token is reported when its log-likelihood
ratio between the two outweighs the prior odds against a secret. All work on rows is built
of DataFrame functions; places come from the lengths of what lies between matches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import bound

# Patterns of the base kinds, in their order, and the least length of what
# they find (of group 2 for the first).
PATTERNS = {
    "assign": (
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)",
        12,
    ),
    "access": (r"AKIA[A-Z0-9]+", 18),
    "hex": (r"[0-9a-f]+", 16),
}
# The same, without stopping at matches that are too short; these kinds find whole runs, so
# leaving short ones out inside the pattern changes nothing.
SEARCHED = {
    "assign": PATTERNS["assign"][0],
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"(?<![0-9a-f])[0-9a-f]{16,}",
}
KINDS = [*PATTERNS, "markov"]
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"

UPPER, DIGITS, MARKS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/_.=-"
ALPHABET = "abcdefghijklmnopqrstuvwxyzA0-"
SAMPLE_DOCUMENTS = 2000
SAMPLE_STRINGS = 3000
PRIOR_ODDS = 1e6
LEAST_DISTINCT = 8
BLOCK = 512
MASK = "[SECRET]"


def running_sums(lengths: Column) -> Column:
    """Sum of all entries before each entry, in blocks so that long arrays stay cheap."""

    def before(values: Column) -> Column:
        def add(acc: Column, v: Column) -> Column:
            return acc + v

        return F.transform(
            values,
            lambda _, k: F.aggregate(F.slice(values, F.lit(1), k), F.lit(0).cast("bigint"), add),
        )

    def of_blocks(blocks: Column) -> Column:
        totals = F.transform(
            blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda acc, v: acc + v)
        )
        return F.flatten(
            F.zip_with(
                blocks,
                bound(totals, before),
                lambda b, start: F.transform(bound(b, before), lambda v: v + start),
            )
        )

    def cut(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / BLOCK).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda k: F.slice(values, k * BLOCK + 1, F.lit(BLOCK))
        )

    return bound(lengths, lambda v: bound(cut(v), of_blocks))


def placed(text: Column, pattern: str, kind: str, keep) -> Column:
    """Matches of a pattern as (start, rank, kind, end), places counted in code points.

    ``keep(match, k)`` decides on the k-th match. The text is only taken apart if there is
    a match at all.
    """
    nothing = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")

    def spans(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("bigint"))
        width = F.transform(found, lambda m: F.length(m).cast("bigint"))
        steps = F.zip_with(F.slice(gaps, F.lit(2), F.size(found)), width, lambda g, w: g + w)
        rows = F.zip_with(
            found,
            running_sums(steps),
            lambda m, before: F.struct((before + F.get(gaps, F.lit(0))).alias("start"), m.alias("m")),
        )
        rows = F.transform(
            F.filter(rows, lambda r, k: keep(r["m"], k)),
            lambda r: F.struct(
                r["start"].alias("start"),
                F.lit(KINDS.index(kind)).alias("rank"),
                F.lit(kind).alias("kind"),
                (r["start"] + F.length(r["m"])).alias("end"),
            ),
        )
        return F.when(F.size(found) > 0, rows).otherwise(nothing)

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def long_enough(kind: str):
    """Whether the k-th match of a base kind counts."""
    if kind != "assign":
        return lambda m, k: F.lit(True)
    pattern, least = PATTERNS[kind]
    value = rf"{pattern}$"
    return lambda m, k: F.length(F.regexp_extract(m, value, 2)) >= least


def classes(value: Column) -> Column:
    """Characters by class: small letters as they are, capitals, digits and marks as one each."""
    return F.translate(
        value, UPPER + DIGITS + MARKS, "A" * len(UPPER) + "0" * len(DIGITS) + "-" * len(MARKS)
    )


def labelled_strings(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """Strings labelled ``random`` or not, out of about ``sample`` documents and digests.

    Random: values that the base patterns find, and digests as hexadecimal, base 64 and
    capitals. Ordinary: what is left of the sampled texts in runs of 6 or more characters,
    alone and joined as identifiers are.
    """
    spark = docs.sparkSession
    n = max(1, docs.count())
    share = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text")), F.lit(1 << 32)) / float(1 << 32)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("t"), share.alias("s"))
    texts = texts.filter(F.col("s") < min(1.0, sample / n)).select("t")
    values = F.concat(
        *(
            F.regexp_extract_all("t", F.lit(SEARCHED[kind]), F.lit(2 if kind == "assign" else 0))
            for kind in PATTERNS
        )
    )
    caught = texts.select(F.explode(values).alias("value")).filter(F.length("value") >= 12)
    digest = F.sha2(F.col("id").cast("string"), 256)
    made = spark.range(SAMPLE_STRINGS).select(
        F.explode(
            F.array(
                F.substring(digest, 1, 40),
                F.base64(F.unhex(digest)),
                F.substring(F.upper(F.base64(F.unhex(digest))), 1, 20),
            )
        ).alias("value")
    )
    rest = F.col("t")
    for pattern in SEARCHED.values():
        rest = F.regexp_replace(rest, pattern, " ")
    runs = F.filter(F.split(rest, "[^A-Za-z0-9+/_=-]+"), lambda w: F.length(w) >= 6)
    plain = texts.select(runs.alias("w")).select(
        F.explode(
            F.concat(
                "w",
                F.zip_with("w", F.reverse("w"), lambda a, b: F.concat(a, F.lit("_"), b)),
                F.zip_with("w", F.reverse("w"), lambda a, b: F.concat(a, F.initcap(b))),
            )
        ).alias("value")
    )
    random = caught.unionByName(made).select("value", F.lit(True).alias("random"))
    return random.unionByName(plain.select("value", F.lit(False).alias("random")))


def train(strings: DataFrame) -> list[float]:
    """Log-likelihood ratio (random to ordinary) of each step between character classes.

    ``strings`` has ``value`` and ``random``. The driver gets one count for each label and
    pair of classes, a fixed number. The entry of a pair stands at its places in
    ``ALPHABET``: first times its length plus second. Unseen steps count as seen once.
    """
    value = classes(F.col("value"))
    pairs = F.transform(
        F.sequence(F.lit(1), F.length(value) - 1), lambda i: F.substr(value, i, F.lit(2))
    )
    counts = (
        strings.filter(F.length("value") >= 2)
        .select("random", F.explode(pairs).alias("pair"))
        .groupBy("random", "pair")
        .agg(F.count("*").alias("n"))
    )
    size = len(ALPHABET)
    seen = {True: [1.0] * (size * size), False: [1.0] * (size * size)}
    for row in counts.collect():
        a, b = ALPHABET.find(row["pair"][0]), ALPHABET.find(row["pair"][1])
        if a >= 0 and b >= 0:
            seen[row["random"]][a * size + b] += row["n"]

    def chance(label: bool, a: int, b: int) -> float:
        row = seen[label][a * size : (a + 1) * size]
        return math.log(row[b] / sum(row))

    return [chance(True, a, b) - chance(False, a, b) for a in range(size) for b in range(size)]


def log_ratio(value: Column, ratios: list[float]) -> Column:
    """Log-likelihood ratio of a whole string."""
    table = F.lit(ratios)

    def total(v: Column) -> Column:
        steps = F.sequence(F.lit(1), F.length(v) - 1)
        return F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + F.get(table, step_of(v, i)))

    def step_of(v: Column, i: Column) -> Column:
        first = F.instr(F.lit(ALPHABET), F.substr(v, i, F.lit(1))) - 1
        second = F.instr(F.lit(ALPHABET), F.substr(v, i + 1, F.lit(1))) - 1
        return (first * len(ALPHABET) + second).cast("int")

    return bound(classes(value), total)


def looks_random(value: Column, ratios: list[float], prior_odds: float = PRIOR_ODDS) -> Column:
    """Whether the likelihoods outweigh the odds against; a few characters over and over do not."""
    varied = F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT
    return varied & (log_ratio(value, ratios) > math.log(prior_odds))


def find_secrets(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """Spans of secrets in every document.

    Returns doc_id, the number of spans of each kind, base_sha256 over the base spans and
    all spans as ``kind:start:end`` joined by commas, in order of start and kind. Spans of
    the model (``markov``) do not overlap base ones. ``ratios`` come from ``train``; without
    them the model is trained on the documents themselves. A missing text is empty and has
    no spans; repeated rows are searched each; an empty table gives no rows; columns other
    than doc_id and text are not looked at.
    """
    ratios = train(labelled_strings(docs)) if ratios is None else ratios
    text = F.col("_text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    base = F.concat(
        *(placed(text, SEARCHED[kind], kind, long_enough(kind)) for kind in PATTERNS)
    )
    model = placed(text, TOKEN, "markov", lambda m, k: looks_random(m, ratios))
    rows = rows.select("doc_id", F.sort_array(base).alias("_base"), model.alias("_model"))

    def apart(span: Column, base: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))

    def both(base: Column) -> Column:
        return F.sort_array(
            F.concat(base, F.filter(F.col("_model"), lambda span: apart(span, base)))
        )

    def printed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(F.col("_all"), lambda s: s["kind"] == kind)).cast("bigint")

    rows = rows.select("doc_id", "_base", bound(F.col("_base"), both).alias("_all"))
    return rows.select(
        "doc_id",
        *(of_kind(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(printed(F.col("_base")), 256).alias("base_sha256"),
        printed(F.col("_all")).alias("spans"),
    )


def redact(text: Column, ratios: list[float]) -> Column:
    """The text with every secret replaced by a mask, kind after kind."""

    def masked(value: Column, pattern: str, keep) -> Column:
        def parts(found: Column) -> Column:
            shown = F.transform(found, lambda m, k: F.when(keep(m, k), F.lit(MASK)).otherwise(m))
            joined = F.flatten(
                F.zip_with(
                    F.split(value, pattern, -1), shown, lambda g, m: F.array(g, F.coalesce(m, F.lit("")))
                )
            )
            return F.when(F.size(found) > 0, F.array_join(joined, "")).otherwise(value)

        return bound(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)), parts)

    def step(value: Column, pattern: str, keep) -> Column:
        return bound(value, lambda v: masked(v, pattern, keep))

    for kind in PATTERNS:
        text = step(text, SEARCHED[kind], long_enough(kind))
    return step(text, TOKEN, lambda m, k: looks_random(m, ratios))


def mask_secrets(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """The documents with secrets in their texts masked; ``n_chars``, if there, follows the text."""
    ratios = train(labelled_strings(docs)) if ratios is None else ratios
    masked = docs.withColumn("text", redact(F.col("text"), ratios))
    if "n_chars" in docs.columns:
        # Nothing but a mask changes a text, and a mask can be told by its own characters.
        length = F.when(F.contains("text", F.lit(MASK)), F.length("text").cast("bigint"))
        masked = masked.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))
    return masked
