"""A Merkle manifest of a table: a tree per language, a tree over their roots, and proofs.

Every row is a leaf: the SHA-256 (hex) of its fields, each written as ``-`` when null or
as its UTF-8 byte count, ``:`` and its value. Per language, leaves ascend by ``doc_id``;
every 8 consecutive nodes (the last run: fewer, even one) become the hash of their hex
digests, while more than one node remains. The roots of the languages, ordered by
language (null first, then bytewise), form the top tree in the same way.

The work is split in superblocks of 8 ** ``levels`` consecutive nodes. Going up, each
superblock is reduced locally in one group of ``applyInPandas`` into one node of the level
``levels`` higher, until every tree has one node. Going down, the nodes of a superblock and
the proof of its root above it (the "outer" nodes it needs) are cogrouped by superblock:
the group finishes the local reduction, joins local and outer proofs and folds a leaf
back to a root, all at once. No group ever holds more than one superblock, however many
rows one language has; positions come from a range-partitioned sort, not one window.
"""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

FANOUT = 8
LEVELS = 4
ROWS_PER_PART = 1_000_000
# Fixed values of the manifest: the fields of a leaf, in order, and the null mark.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
NULL_FIELD = "-"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NODES = "t long, idx long, h string"
OUTER = "t long, idx long, outer string, subroot string, root string"
RESULT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def H(parts) -> str:
    return hashlib.sha256("".join(parts).encode("utf-8")).hexdigest()


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull(), F.lit(NULL_FIELD)).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_of(text: Column) -> Column:
    values = [F.col(f) if f != "text" else text for f in FIELDS]
    return F.sha2(F.concat(*[_field(c) for c in values]), 256)


def ordinal(df: DataFrame, tree: str, order: list[Column], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``df`` with ``idx``: the position (from 0) of each row within its ``tree`` by ``order``.

    A range-partitioned sort spreads even one large tree over many tasks; counts per part
    give each part its first position.
    """
    parts = max(1, math.ceil(df.count() / rows_per_part))
    ranged = df.repartitionByRange(parts, F.col(tree).asc_nulls_first(), *order)
    ranged = materialize(ranged.withColumn("_part", F.spark_partition_id()), "merkle-ranged")
    counts = ranged.groupBy(tree, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col(tree).alias("_t"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    joined = ranged.join(counts, ranged[tree].eqNullSafe(counts["_t"]) & (ranged["_part"] == counts["_p"]))
    within = Window.partitionBy(tree, "_part").orderBy(*order)
    return joined.withColumn("idx", F.col("_before") + F.row_number().over(within) - 1).drop("_t", "_p", "_before", "_part")


def _steps(n: int, levels: int) -> int | None:
    """Levels a group reduces: all the way when the tree fits one superblock (None), else ``levels``."""
    return None if n <= FANOUT**levels else levels


def reduce_local(hashes: list[str], n: int, levels: int) -> tuple[str, list[list[str]]]:
    """Top of a superblock and its nodes level by level (the first level is ``hashes``)."""
    steps, tiers = _steps(n, levels), [hashes]
    while (len(tiers[-1]) > 1 or (steps is not None and n > 1)) and (steps is None or len(tiers) <= steps):
        cur = tiers[-1]
        tiers.append([H(cur[i : i + FANOUT]) for i in range(0, len(cur), FANOUT)])
    if n == 1:
        tiers = [hashes]
    return tiers[-1][0], tiers


def local_proof(tiers: list[list[str]], p: int) -> list[str]:
    """Proof entries of position ``p``: its place in the run and the run's others, per level."""
    entries = []
    for cur in tiers[:-1]:
        start = (p // FANOUT) * FANOUT
        run = cur[start : start + FANOUT]
        entries.append(str(p - start) + "".join(run[: p - start] + run[p - start + 1 :]))
        p //= FANOUT
    return entries


def fold(h: str, entries: list[str]) -> str:
    for entry in entries:
        pos, sibs = int(entry[0]), entry[1:]
        run = [sibs[i : i + 64] for i in range(0, len(sibs), 64)]
        h = H(run[:pos] + [h] + run[pos:])
    return h


def _join(local: list[str], outer: str) -> list[str]:
    return local + ([e for e in outer.split(";")] if outer else [])


def _up(nodes: DataFrame, levels: int) -> DataFrame:
    """One reduction: each superblock of each tree to one node ``levels`` higher."""

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("idx")
        top, _ = reduce_local(list(group["h"]), int(group["n"].iloc[0]), levels)
        return pd.DataFrame({"t": [group["t"].iloc[0]], "idx": [group["g"].iloc[0]], "h": [top]})

    return nodes.groupBy("t", "g").applyInPandas(one, NODES)


def _with_counts(nodes: DataFrame, levels: int) -> DataFrame:
    counts = nodes.groupBy("t").agg(F.count("*").alias("n"))
    size = FANOUT**levels
    return nodes.join(counts, "t").withColumn("g", F.floor(F.col("idx") / size).cast("long"))


def build(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Stored node tables from the given level up to one node per tree, with ``n`` and ``g``."""
    tiers = []
    while True:
        nodes = materialize(_with_counts(nodes, levels), "merkle-nodes")
        tiers.append(nodes)
        if nodes.filter(F.col("n") > 1).limit(1).count() == 0:
            return tiers
        nodes = _up(nodes, levels)


def _down(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """Outer proofs of a level's nodes: local proof in its superblock, then its superblock's."""

    def one(mine: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values("idx")
        _, tiers = reduce_local(list(mine["h"]), int(mine["n"].iloc[0]), levels)
        up = above.iloc[0]
        first = int(mine["idx"].iloc[0]) - int(mine["idx"].iloc[0]) % FANOUT**levels
        rows = []
        for idx in mine["idx"]:
            proof = _join(local_proof(tiers, int(idx) - first), up["outer"])
            rows.append((up["t"], int(idx), ";".join(proof), up["subroot"], up["root"]))
        return pd.DataFrame(rows, columns=["t", "idx", "outer", "subroot", "root"])

    above = outer.withColumnRenamed("idx", "g")
    return nodes.groupBy("t", "g").cogroup(above.groupBy("t", "g")).applyInPandas(one, OUTER)


def _down_all(tiers: list[DataFrame], top: DataFrame, levels: int) -> DataFrame:
    """Outer proofs of the first tier's superblocks, from ``top`` (the outer of the last tier)."""
    outer = top
    for nodes in reversed(tiers[1:]):
        outer = materialize(_down(nodes, outer, levels), "merkle-outer")
    return outer


def manifest(docs: DataFrame, levels: int = LEVELS, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Leaf, subroot, root and proof of every row of ``docs``, and a check of a changed copy.

    ``docs`` has ``doc_id``, ``source``, ``lang``, ``n_chars``, ``text``; other columns,
    whatever their names, are ignored. Nulls in any field are written ``-``; texts of any
    length are hashed whole. Rows with a null ``doc_id`` come first in their language, and
    repeated rows (same ``doc_id``) are ordered by their leaf, so equal rows are
    interchangeable. A language with one row has that leaf as subroot; one language makes
    its subroot the root. ``proof_sha256`` is the hash of all siblings, level by level from
    the leaf to the root, left to right (of nothing, for a single row).

    Where 3 divides the unsigned CRC-32 of the decimal ``doc_id``, the copy lower-cases
    A-Z of the text; ``folded_root`` folds the copy's leaf with the original siblings and
    ``verified`` tells whether it gives ``root``. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.col("text").cast("string").alias("text"),
    )
    changed = (F.crc32(F.col("doc_id").cast("string")) % 3) == 0
    tampered = F.when(changed, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    rows = rows.select("doc_id", "lang", leaf_of(F.col("text")).alias("h"), leaf_of(tampered).alias("tampered"))

    langs = rows.select("lang").distinct().withColumn("_one", F.lit(0))
    langs = ordinal(langs, "_one", [F.col("lang").asc_nulls_first()], rows_per_part)
    langs = materialize(langs.select("lang", F.col("idx").alias("t")), "merkle-langs")
    if langs.limit(1).count() == 0:
        return spark.createDataFrame([], RESULT)
    leaves = rows.join(langs, rows["lang"].eqNullSafe(langs["lang"])).drop(langs["lang"])
    leaves = ordinal(leaves, "t", [F.col("doc_id").asc_nulls_first(), F.col("h")], rows_per_part)
    leaves = materialize(leaves, "merkle-leaves")

    lang_tiers = build(leaves.select("t", "idx", "h"), levels)
    subroots = lang_tiers[-1].select(F.lit(0).cast("long").alias("t"), F.col("t").alias("idx"), "h")
    top_tiers = build(subroots, levels)
    root = top_tiers[-1].first()["h"]

    top = spark.createDataFrame([(0, 0, "", None, root)], OUTER)
    per_lang = _down_all(top_tiers, top, levels)
    per_lang = _down(top_tiers[0], per_lang, levels)
    # Each language's root keeps its proof in the top tree as its outer nodes.
    lang_top = per_lang.select(
        F.col("idx").alias("t"), F.lit(0).cast("long").alias("idx"), "outer", "root"
    ).join(lang_tiers[-1].select("t", F.col("h").alias("subroot")), "t")
    outer = _down_all(lang_tiers, lang_top.select("t", "idx", "outer", "subroot", "root"), levels)

    def finish(mine: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values("idx")
        _, tiers = reduce_local(list(mine["h"]), int(mine["n"].iloc[0]), levels)
        up = above.iloc[0]
        first = int(mine["idx"].iloc[0]) - int(mine["idx"].iloc[0]) % FANOUT**levels
        out = []
        for idx, doc_id, leaf, copy in zip(mine["idx"], mine["doc_id"], mine["h"], mine["tampered"]):
            proof = _join(local_proof(tiers, int(idx) - first), up["outer"])
            sibs = "".join(e[1:] for e in proof)
            folded = fold(copy, proof)
            out.append((doc_id, leaf, up["subroot"], up["root"], H([sibs]), folded, folded == up["root"]))
        return pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    base = _with_counts(leaves, levels).select("t", "g", "idx", "n", "h", "tampered", "doc_id")
    above = outer.withColumnRenamed("idx", "g")
    return base.groupBy("t", "g").cogroup(above.groupBy("t", "g")).applyInPandas(finish, RESULT)
