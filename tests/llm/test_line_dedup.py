"""Line dedup against plain Python."""

import hashlib

from gridloom.llm import line_dedup
from tests.llm.helpers import UPPER

WHITE = " \t\n\x0b\x0c\r"
LONG = "a line that is long enough to count"


def expected(rows, min_chars=20, min_docs=3):
    key = lambda line: line.strip(WHITE).translate(UPPER)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and i is not None:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [len(holders.get(key(x), ())) >= min_docs and i != max(holders[key(x)]) for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((i, len(lines), sum(gone), kept))
    return out


def rows_of():
    rows = [(i, f"{LONG}\nown line number {i} of this one\n  {LONG.upper()}\t\nshort") for i in range(6)]
    rows += [
        (20000, f"é{LONG}\n{LONG}\n\n"),
        (9000, f"\n{LONG}\n{LONG}"),
        (30, None),
        (31, ""),
        (32, "\n"),
        (33, "ÀÉ upper stays as it is here"),
        (34, "àé upper stays as it is here"),
        (2, f"{LONG}\nsecond text of the same id"),
        (2, f"{LONG}\nsecond text of the same id"),
        (None, f"{LONG}\nhas no id"),
        (40, "\n".join(f"line {k} of a very long text indeed" for k in range(300))),
        (41, "\n".join(f"line {k} of a very long text indeed" for k in range(0, 300, 7))),
        (42, "\n".join(f"line {k} of a very long text indeed" for k in range(0, 300, 5))),
    ]
    return rows


def test_report(spark):
    rows = rows_of()
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, pos string, h1 int")
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.line_report(docs).collect())
    want = sorted((str(i), n, d, hashlib.sha256(k.encode()).hexdigest()) for i, n, d, k in expected(rows))
    assert got == want


def test_texts_are_rewritten_and_columns_stay(spark):
    rows = rows_of()
    docs = spark.createDataFrame([(i, t, 1, "own", "th") for i, t in rows], "doc_id long, text string, n_chars int, dropped string, th string")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    got = sorted((str(r.doc_id), r.text or "", r.n_chars or 0) for r in out.collect())
    assert got == sorted((str(i), k, len(k)) for i, _, _, k in expected(rows))
    assert {r.dropped for r in out.collect()} == {"own"}


def test_runs_of_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "RUN_DOCS", 2)
    rows = rows_of()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_dropped) for r in line_dedup.line_report(docs).collect())
    assert got == sorted((str(i), d) for i, _, d, _ in expected(rows))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.line_report(docs).collect() == []
