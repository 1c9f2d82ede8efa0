import re

from cases import TEXTS, documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from archive_spark.llm import licenses
from archive_spark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    at = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    at.sort()
    labels = ",".join(sorted({x[1] for x in at}))
    return len(words), len(at), at[0][0] if at else None, at[-1][0] if at else None, labels


def check(rows, text_of):
    for r in rows:
        got = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
        assert got == brute(text_of(r.doc_id))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


words = st.lists(st.integers(0, 3), max_size=25)


@settings(max_examples=150, deadline=None)
@given(st.lists(words, max_size=4), words)
def test_matching_statistics_are_exact(sequences, text):
    automaton = licenses.SuffixAutomaton(sequences)
    runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for end, length, state in automaton.statistics(text):
        longest = max((n for n in range(end + 1) if n == 0 or tuple(text[end - n : end]) in runs))
        assert length == longest
        if length:
            run = text[end - length : end]
            where = {
                (k, i + length)
                for k, s in enumerate(sequences)
                for i in range(len(s) - length + 1)
                if s[i : i + length] == run
            }
            assert where == set(automaton.ends[state])


def test_documents_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op9_license_scans"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    check(rows, docs.get)


def test_odd_rows(spark):
    texts = TEXTS + [
        "x Under the MIT-license, under THE mit license. cc by nc cc by nc é",
        "under the mit",
        "license",
    ]
    rows = licenses.scan_licenses(documents(spark, texts)).collect()
    assert len(rows) == len(texts) + 3
    check(rows, lambda i: texts[i] if i is not None else texts[0])
    assert licenses.scan_licenses(no_documents(spark)).count() == 0


def test_damaged_and_partial_templates(spark):
    mit = licenses.TEMPLATES["text:mit"].split()
    damaged = [w if i % 23 else "changed" for i, w in enumerate(mit)]
    texts = [
        "prose before " * 50 + " ".join(mit) + " prose after" * 20,
        " ".join(damaged),
        " ".join(mit[: len(mit) // 4]),
        " ".join(" ".join(mit[k : k + 3]) + " and so" for k in range(0, len(mit), 3)),
        " ".join(licenses.TEMPLATES["notice:gpl"].upper().split()),
        "nothing of the kind is said in this text at all",
    ]
    rows = {r.doc_id: r for r in licenses.scan_licenses(documents(spark, texts, False)).collect()}
    assert "text:mit" in rows[0].labels and rows[0].score == 1
    assert f"text:mit:100:{100 + len(licenses.plain_words(' '.join(mit).encode()))}" in rows[0].spans
    assert "text:mit" in rows[1].labels and 0.6 < rows[1].score < 1
    assert "text:mit" not in rows[2].labels and 0.2 < rows[2].score < 0.4
    assert rows[3].labels == "" and "notice:gpl" in rows[4].labels
    assert rows[5].labels == "" and rows[5].spans == ""


def test_every_copy_of_a_template_has_its_span(spark):
    from archive_spark.llm import licenses

    name = list(licenses.TEMPLATES)[0]
    text = licenses.TEMPLATES[name]
    n = len(licenses.plain_words(text.encode()))
    texts = [f"{text} aside from it {text}\n{text}", text]
    rows = {r.doc_id: r for r in licenses.scan_licenses(documents(spark, texts, extra=False).filter("doc_id < 2")).collect()}
    starts = [0, n + 3, 2 * n + 3]
    assert [x for x in rows[0].spans.split(",") if x.startswith(name + ":")] == [f"{name}:{s}:{s + n}" for s in starts]
    assert [x for x in rows[1].spans.split(",") if x.startswith(name + ":")] == [f"{name}:0:{n}"]
