import hashlib
import zlib

from cases import DOCUMENTS

from archive_spark.llm import merkle
from archive_spark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    return H([field(row[0]), field(row[3]), field(row[2]), field(row[4]), field(text)])


def tree(hashes):
    """All levels of a tree, bottom first."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        cur = levels[-1]
        levels.append([H(cur[i : i + 8]) for i in range(0, len(cur), 8)])
    return levels


def path(levels, p):
    out = []
    for cur in levels[:-1]:
        s = p // 8 * 8
        out.append((p - s, cur[s : s + 8][: p - s] + cur[s : s + 8][p - s + 1 :]))
        p //= 8
    return out


def brute(rows):
    """Plain reference: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    lang_trees = {}
    for lang in langs:
        own = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        lang_trees[lang] = (own, tree([leaf(r, r[1]) for r in own]))
    top = tree([lang_trees[lang][1][-1][0] for lang in langs])
    out = []
    for li, lang in enumerate(langs):
        own, levels = lang_trees[lang]
        for p, r in enumerate(own):
            proof = path(levels, p) + path(top, li)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            text = r[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) if changed and r[1] is not None else r[1]
            h = leaf(r, text)
            for pos, sibs in proof:
                h = H(sibs[:pos] + [h] + sibs[pos:])
            sibs = "".join("".join(s) for _, s in proof)
            out.append((r[0], leaf(r, r[1]), levels[-1][0], top[-1][0], H([sibs]), h, h == top[-1][0]))
    return sorted(out, key=str)


def rows_of(n, langs):
    rows = []
    for i in range(n):
        lang = langs[i % len(langs)]
        rows.append((i * 3, f"Text Number {i} ABC" if i % 5 else None, lang, None if i % 7 == 0 else f"src{i % 3}", i))
    return rows


def test_equals_brute_force(spark):
    rows = rows_of(700, ["en", None, "de", "ü"]) + [(5, "One alone", "solo", "s", 9)]
    rows += [rows[3], (None, "no id", "en", None, None), (None, None, None, None, None)]
    rows += [(10**12, "Ünïcode BIG " * 10_000, "en", "x", 5)]
    df = spark.createDataFrame(rows, DOCUMENTS).withColumn("leaf", merkle.F.lit("clash"))
    want = brute(rows)
    for levels in (1, 2, 4):
        got = sorted((tuple(r) for r in merkle.manifest(df, levels=levels, rows_per_part=97).collect()), key=str)
        assert got == want
    assert not all(r[6] for r in want) and any(r[6] for r in want)


def test_small_trees(spark):
    for rows in ([(1, "A", "en", "s", 1)], rows_of(9, ["x"]), rows_of(64, ["x", "y"]), rows_of(65, ["x"])):
        df = spark.createDataFrame(rows, DOCUMENTS)
        got = sorted((tuple(r) for r in merkle.manifest(df, levels=1).collect()), key=str)
        assert got == brute(rows)


def test_empty(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = sorted((tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, FOLDER).collect()), key=str)
    assert got == brute(rows)
