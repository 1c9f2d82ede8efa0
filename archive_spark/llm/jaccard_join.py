"""Near duplicates by word shingles: MinHash LSH banding, then exact verification.

Each tree is a band of MinHash values; documents meet where they share its whole prefix.
The length of the prefix is one for all, the longest up to ``DEPTH`` with which pairs at the
threshold meet in some tree with the target recall. Equal texts are one entry. Entries that
meet are compared in the first tree in which they do, large trie nodes in blocks, and every
pair whose signatures do not rule it out is verified on all its shingles. The
candidates of a block are stored as packed keys in between, 16 bytes a pair; only sums and a
spanning forest leave the verification.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .components import components
from .text import Words, batch_of, mix, pieces, shingles, small, utf8, values, whole_groups

SHINGLE = 5
THRESHOLD = 0.8
TREES = 20
DEPTH = 8
RECALL = 0.9995
BLOCK = 256
# A signature of 100 values estimates a similarity of 0.8 with a standard deviation of 0.04;
# pairs five deviations below the threshold need no verification.
MARGIN = 0.2

SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.binary()), ("nodes", pa.list_(pa.int64())), ("sketch", pa.binary())]
)


def prefix_length(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix with which pairs at the threshold meet often enough."""
    for length in range(depth, 0, -1):
        if 1 - (1 - threshold**length) ** trees >= recall:
            return length
    raise ValueError("more trees are needed for this threshold and recall")


def multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def signatures(runs: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that have shingles, and ``n`` MinHash values of each."""
    start = np.flatnonzero(np.diff(doc, prepend=-1))
    out = np.empty((len(start), n), np.uint32)
    if len(start):
        for k, factor in enumerate(multipliers(n)):
            spread = ((runs * factor) >> np.uint64(32)).astype(np.uint32)
            out[:, k] = np.minimum.reduceat(spread, start)
    return doc[start], out


def trie_nodes(values_: np.ndarray, trees: int, length: int) -> np.ndarray:
    """Hash of the prefix of each tree's label."""
    labels = values_.reshape(len(values_), trees, length).astype(np.uint64)
    node = np.broadcast_to(mix(np.arange(trees, dtype=np.uint64) + np.uint64(1)), labels.shape[:2])
    for k in range(length):
        node = mix(node * np.uint64(0xD6E8FEB86659FD93) + labels[:, :, k])
    return node


def signed_documents(docs: DataFrame, trees: int, length: int) -> DataFrame:
    """Digest, trie nodes and sketch of each document; no nodes without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = utf8(batch, "text")
            nodes: list = [None] * len(texts)
            sketch: list = [None] * len(texts)
            for piece in pieces(texts):
                runs, doc = shingles(Words([t.lower() for t in texts[piece]]), SHINGLE)
                at, minima = signatures(runs, doc, trees * length)
                label = trie_nodes(minima, trees, length).view(np.int64)
                short = minima.astype(np.uint8)
                for d, n, s in zip(at.tolist(), label, short):
                    nodes[piece.start + d] = n
                    sketch[piece.start + d] = s.tobytes()
            yield batch_of(SIGNED, [values(batch, "doc_id"), values(batch, "key"), nodes, sketch])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("key")
    )
    return rows.mapInArrow(run, "doc_id long, key binary, nodes array<long>, sketch binary")


def _cells(entries: DataFrame, block: int) -> DataFrame:
    """Rows (cell, side, own, tree, key): entries that have to be compared with each other.

    A trie node with up to ``block`` entries is one cell; a larger one is cut into blocks by
    hash, and every two blocks meet in a cell.
    """
    members = entries.select("key", F.posexplode("nodes").alias("tree", "node"))
    counts = members.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    members = members.join(materialize(counts, "trie-nodes"), "node")
    members = members.withColumns(
        {"blocks": blocks, "side": F.pmod(F.xxhash64("key", "node"), blocks).cast("int")}
    )
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.least("side", "other"), F.greatest("side", "other")
    return members.select(
        F.xxhash64("node", *pair).alias("cell"),
        "side",
        (F.col("side") == F.col("other")).alias("own"),
        "tree",
        "key",
    )


def _pairs(cell, side, own, tree, nodes, sketch, least) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of entries to verify, in rows sorted by cell."""
    n = len(cell)
    for step in range(1, n):
        same = cell[:-step] == cell[step:]
        if not same.any():
            return
        same &= (own[:-step] & own[step:]) | (side[:-step] != side[step:])
        i = np.flatnonzero(same)
        for low in range(0, len(i), 20_000):
            a = i[low : low + 20_000]
            b = a + step
            shared = nodes[a] == nodes[b]
            at = tree[a]
            first = shared[np.arange(len(a)), at] & (shared.argmax(1) == at)
            a, b = a[first], b[first]
            near = (sketch[a] == sketch[b]).mean(1) >= least
            if near.any():
                yield a[near], b[near]


def _candidates(cells: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """(cell, key, partners): for each entry of a cell, the keys to verify it with."""
    out = pa.schema([("cell", pa.int64()), ("key", pa.binary()), ("partners", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "cell"):
            cell = t["cell"].to_numpy()
            key = t["key"].to_pylist()
            nodes = np.array(t["nodes"].combine_chunks().flatten()).reshape(len(cell), -1)
            sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(len(cell), -1)
            partners: dict[int, list[int]] = {}
            others = (t[c].to_numpy() for c in ("side", "own", "tree"))
            for a, b in _pairs(cell, *others, nodes, sketch, threshold - MARGIN):
                for i, j in zip(a.tolist(), b.tolist()):
                    partners.setdefault(i, []).append(j)
                    partners.setdefault(j, [])
            rows = [(cell[i], key[i], b"".join(key[j] for j in js)) for i, js in partners.items()]
            if rows:
                yield batch_of(out, zip(*rows))

    rows = cells.join(entries.select("key", "nodes", "sketch"), "key")
    rows = rows.select("cell", "side", "own", "tree", "key", "nodes", "sketch")
    rows = rows.repartition("cell").sortWithinPartitions("cell")
    return rows.mapInArrow(run, "cell long, key binary, partners binary")


def _find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _verified(candidates: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(key, links, parent): documents linked to an entry within a cell, and a spanning edge."""
    out = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("parent", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "cell"):
            cell = t["cell"].to_numpy()
            key = t["key"].to_pylist()
            partners = t["partners"].to_pylist()
            copies = t["copies"].to_pylist()
            sets: list[np.ndarray] = []
            texts_ = [x.encode() for x in t["text"].to_pylist()]
            for piece in pieces(texts_):
                part = [x.lower() for x in texts_[piece]]
                runs, doc = shingles(Words(part), SHINGLE)
                cuts = np.searchsorted(doc, np.arange(1, len(part)))
                sets += [np.unique(s) for s in np.split(runs, cuts)]
            place = {(c, k): i for i, (c, k) in enumerate(zip(cell.tolist(), key))}
            parent = list(range(len(key)))
            links = [0] * len(key)
            for i, blob in enumerate(partners):
                for at in range(0, len(blob), 16):
                    j = place[(int(cell[i]), blob[at : at + 16])]
                    a, b = sets[i], sets[j]
                    if min(len(a), len(b)) < threshold * max(len(a), len(b)):
                        continue
                    both = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
                    if both >= threshold * (len(a) + len(b) - both) - 1e-9:
                        links[i] += copies[j]
                        links[j] += copies[i]
                        x, y = _find(parent, i), _find(parent, j)
                        if key[x] < key[y]:
                            parent[y] = x
                        else:
                            parent[x] = y
            rows = [(key[i], n, key[_find(parent, i)]) for i, n in enumerate(links) if n]
            if rows:
                yield batch_of(out, zip(*rows))

    rows = candidates.join(texts, "key").select("cell", "key", "partners", "copies", "text")
    rows = rows.repartition("cell").sortWithinPartitions("cell")
    return rows.mapInArrow(run, "key binary, links long, parent binary")


def _classified(
    docs: DataFrame, threshold: float, trees: int, depth: int, recall: float, block: int
) -> tuple[DataFrame, DataFrame]:
    """Stored tables: (doc_id, key, ...) of every row, and every text's root, ids and links."""
    length = prefix_length(threshold, trees, depth, recall)
    signed = materialize(signed_documents(docs, trees, length), "signatures")
    entries = signed.groupBy("key").agg(
        F.count("*").alias("copies"),
        F.min("doc_id").alias("least_id"),
        F.first("nodes").alias("nodes"),
        F.first("sketch").alias("sketch"),
    )
    entries = materialize(entries, "entries")
    compared = entries.filter("nodes is not null")
    cells = _cells(compared, block)
    candidates = materialize(_candidates(cells, compared, threshold), "candidates")

    wanted = candidates.select("key").distinct().join(entries, "key").select("key", "copies", "least_id")
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(docs["doc_id"].cast("long").alias("least_id"), text.alias("text"))
    keyed = keyed.withColumn("key", F.unhex(F.md5("text")))
    texts = wanted.join(keyed, ["least_id", "key"]).select("key", "copies", "text").dropDuplicates(["key"])
    nameless = wanted.filter("least_id is null").select("key", "copies")
    if not nameless.isEmpty():
        by_key = nameless.join(keyed.select("key", "text"), "key").dropDuplicates(["key"])
        texts = texts.unionByName(by_key)

    verified = materialize(_verified(candidates, texts, threshold), "verified-links")
    roots = components(verified.select(F.col("key").alias("a"), F.col("parent").alias("b")))
    links = verified.groupBy("key").agg(F.sum("links").alias("links"))
    joined = (
        entries.select("key", "copies", "least_id")
        .join(links, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
        .withColumn("n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
    )
    return signed, materialize(joined, "linked-entries")


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, class_id, n_links) of every document.

    Two documents are linked if the Jaccard similarity of their sets of 5-word shingles
    (small letters, words between white space) is ``threshold`` or more, or if their texts
    are equal. ``class_id`` is the smallest doc_id of all documents that links connect,
    ``n_links`` the number of other documents linked to this one. A text of 1 to 4 words has
    one shingle of all of them; texts without a word, missing ones included (a missing text
    counts as an empty one), are linked to equal texts only. Repeated rows are documents of
    their own. A class of rows without doc_id has no class_id. An empty table gives no rows;
    columns other than doc_id and text are not looked at.
    """
    signed, entries = _classified(docs, threshold, trees, depth, recall, block)
    classes = entries.groupBy("root").agg(F.min("least_id").alias("class_id"))
    by_entry = entries.join(classes, "root").select("key", "class_id", "n_links")
    by_entry = materialize(by_entry, "classes")
    return signed.select("doc_id", "key").join(by_entry, "key").select("doc_id", "class_id", "n_links")


def one_of_each(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """The documents without near duplicates: of each class the one with the smallest doc_id.

    Classes are those of ``near_duplicates``. Rows without doc_id stay only in classes in
    which no row has one; of rows equal in doc_id and text one stays.
    """
    signed, entries = _classified(docs, threshold, trees, depth, recall, block)
    first = F.struct(F.col("least_id").isNull().alias("none"), F.col("least_id"), F.col("key"))
    kept = entries.groupBy("root").agg(F.min(first).alias("kept"))
    kept = materialize(kept.select(F.col("kept.least_id").alias("_id"), F.col("kept.key").alias("_key")), "kept")
    key = F.unhex(F.md5(F.coalesce(docs["text"], F.lit(""))))
    held = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]) & (key == kept["_key"]), "left_semi")
    repeated = signed.groupBy("doc_id", "key").agg(F.count("*").alias("n")).filter("n > 1")
    if repeated.isEmpty():
        return held
    number = F.row_number().over(
        Window.partitionBy("doc_id", F.md5(F.coalesce("text", F.lit("")))).orderBy(F.lit(0))
    )
    return held.withColumn("_row_of_document", number).filter("_row_of_document = 1").drop("_row_of_document")
