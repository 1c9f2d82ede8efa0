"""Quality rules that vote or abstain, weighed by the accuracies that their votes suggest.

Weak supervision in place of "all rules must pass": each rule votes for good (1), for bad
(-1) or abstains (0). Expectation-maximisation over the counts of vote patterns estimates
how often each rule is right, and a document is kept if its posterior probability of being
good is at least one half. All work on rows is built of DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

WINDOW = 5
ROUNDS = 200
# What a rule gets right at first, on good and on bad documents, and the bounds of both. A
# vote for bad always speaks for bad, as the lower bounds add up to more than one.
START_ON_GOOD, LEAST_ON_GOOD = 0.98, 0.9
START_ON_BAD, LEAST_ON_BAD = 0.4, 0.15
MOST = 0.9999
START_GOOD, LEAST_GOOD, MOST_GOOD = 0.8, 0.5, 0.98

SPACES = " \t\n\x0b\x0c\r"
SPACE_PATTERN = "[ \t\n\x0b\x0c\r]+"
SYMBOLS = "#*$%&|<>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to ``value``, which is computed once though lambdas in it repeat it."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_PATTERN), "")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(words: Column) -> Column:
    """Words within 5-word windows that stand twice or more in the array.

    Windows are compared by hash. Texts without a repeated window, nearly all of them, are
    told by the number of distinct hashes; in others the hashes are sorted with their
    places, so the work grows as n log n with the text.
    """

    def covered(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def places(sorted_: Column) -> Column:
            again = F.filter(
                sorted_,
                lambda x, k: F.coalesce(x["h"] == F.get(sorted_, k - 1)["h"], F.lit(False))
                | F.coalesce(x["h"] == F.get(sorted_, k + 1)["h"], F.lit(False)),
            )
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        first = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            bound(F.sort_array(placed), places),
            first,
            lambda acc, i: F.struct(
                (acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n"),
                (i + WINDOW).alias("end"),
            ),
            lambda acc: acc["n"],
        )

    def count(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))),
        )
        return F.when(
            F.size(w) > WINDOW,
            bound(
                windows,
                lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0),
            ),
        ).otherwise(0)

    return bound(words, count)


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules look at, one row per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(without(line, SPACES)) > 0)
    counted = docs.select(
        "doc_id",
        text.alias("_text"),
        words_of(text).alias("_words"),
        lines.alias("_lines"),
    )
    t = F.col("_text")

    def long(value: Column) -> Column:
        return value.cast("bigint")

    return counted.select(
        "doc_id",
        long(F.size("_words")).alias("n_words"),
        long(F.length(without(t, SPACES))).alias("word_chars"),
        long(F.length(t) - F.length(without(t, SYMBOLS))).alias("n_symbols"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        long(repeated_words(F.col("_words"))).alias("n_repeat_words"),
        long(F.size("_lines")).alias("n_lines"),
        long(F.size(F.array_distinct("_words"))).alias("n_distinct_words"),
        long(F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}", ""))).alias("n_upper"),
        long(F.length(t) - F.length(without(t, "0123456789"))).alias("n_digits"),
        long(F.length(t) - F.length(without(t, "!?"))).alias("n_shouts"),
    )


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rule_votes() -> dict[str, Column]:
    """Each rule's vote on a row of ``text_counts``."""
    words = F.col("n_words")
    share = {
        name: F.col(name) / F.greatest(words, F.lit(1))
        for name in ("n_symbols", "n_repeat_words", "n_shouts", "n_distinct_words")
    }
    letters = F.greatest(F.col("word_chars"), F.lit(1))
    mean = F.col("word_chars") / F.greatest(words, F.lit(1))
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "length": vote(words.between(20, 100_000), words < 10),
        "word_length": vote(mean.between(2.5, 12), (mean < 2) | (mean > 16)),
        "symbols": vote(share["n_symbols"] <= 0.02, share["n_symbols"] > 0.2),
        "repeats": vote(share["n_repeat_words"] <= 0.05, share["n_repeat_words"] > 0.2),
        "lines": vote(lines <= 0.1, lines > 0.3),
        "capitals": vote(F.col("n_upper") / letters <= 0.2, F.col("n_upper") / letters > 0.5),
        "digits": vote(F.col("n_digits") / letters <= 0.1, F.col("n_digits") / letters > 0.3),
        "shouts": vote(share["n_shouts"] <= 0.05, share["n_shouts"] > 0.3),
        "variety": F.when(words < 50, 0).otherwise(
            vote(share["n_distinct_words"] >= 0.2, share["n_distinct_words"] < 0.08)
        ),
    }


def vote_weights(on_good: float, on_bad: float) -> dict[int, float]:
    """Log odds for good that a rule's votes carry."""
    return {1: math.log(on_good / (1 - on_bad)), -1: math.log((1 - on_good) / on_bad), 0: 0.0}


def accuracies(
    patterns: dict[tuple[int, ...], int], rounds: int = ROUNDS
) -> tuple[float, list[tuple[float, float]]]:
    """Share of good documents and each rule's accuracies, by expectation-maximisation.

    ``patterns`` counts documents by their votes. The model: given that it votes, a rule is
    right on good and on bad documents with its own two probabilities, independent of the
    other rules, and whether it abstains says nothing. The bounds keep good from turning
    into bad.
    """

    def within(value: float, least: float) -> float:
        return min(MOST, max(least, value))

    rules = len(next(iter(patterns), ()))
    good, right = START_GOOD, [(START_ON_GOOD, START_ON_BAD)] * rules
    total = sum(patterns.values())
    for _ in range(rounds if total else 0):
        weights = [vote_weights(*r) for r in right]
        all_good = 0.0
        passed, cast = [[0.0, 0.0] for _ in right], [[0.0, 0.0] for _ in right]
        for votes, n in patterns.items():
            odds = math.log(good / (1 - good)) + sum(w[v] for w, v in zip(weights, votes))
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
            all_good += n * p
            for k, v in enumerate(votes):
                for side, share in ((0, n * p), (1, n * (1 - p))):
                    if v:
                        cast[k][side] += share
                        passed[k][side] += share * (v > 0)
        was = [good, *(x for r in right for x in r)]
        good = min(MOST_GOOD, max(LEAST_GOOD, all_good / total))
        right = [
            (
                within((ok[0] + 2 * START_ON_GOOD) / (c[0] + 2), LEAST_ON_GOOD),
                within((c[1] - ok[1] + 2 * START_ON_BAD) / (c[1] + 2), LEAST_ON_BAD),
            )
            for ok, c in zip(passed, cast)
        ]
        now = [good, *(x for r in right for x in r)]
        if max(abs(x - y) for x, y in zip(was, now)) < 1e-9:
            break
    return good, right


def quality_posterior(counts: DataFrame) -> DataFrame:
    """``counts`` with each rule's ``vote_*`` and the posterior ``p_good``.

    Only the counts of vote patterns reach the driver, at most 3 to the number of rules.
    ``counts`` is read twice and should be a stored table.
    """
    votes = rule_votes()
    names = [f"vote_{name}" for name in votes]
    voted = counts.withColumns(dict(zip(names, votes.values())))
    patterns = {
        tuple(row[n] for n in names): row["_n"]
        for row in voted.groupBy(*names).agg(F.count("*").alias("_n")).collect()
    }
    good, right = accuracies(patterns)
    odds = F.lit(math.log(good / (1 - good)))
    for name, accuracy in zip(names, right):
        weight = vote_weights(*accuracy)
        odds = odds + F.when(F.col(name) > 0, weight[1]).when(F.col(name) < 0, weight[-1]).otherwise(0.0)
    return voted.withColumn("p_good", 1 / (1 + F.exp(-odds)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts, verdict and posterior of every document.

    ``base_failed``: fewer than 10 words, or more than a fifth of them in repeated windows;
    such a document is never kept. Others are kept if ``p_good`` is one half or more.
    A missing text has no words; repeated rows are judged each; an empty table gives no
    rows; columns other than doc_id and text are not looked at.
    """
    counts = materialize(text_counts(docs), "rule-counts")
    judged = quality_posterior(counts)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("p_good") >= 0.5)).alias("kept"),
        "p_good",
    )
