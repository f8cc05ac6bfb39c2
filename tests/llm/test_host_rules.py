"""Quality rules against plain Python."""

import random

from gridloom.llm import host_rules
from tests.llm.helpers import words

WHITE = " \t\n\x0b\x0c\r"


def counts(text):
    text = text or ""
    w = words(text)
    seen, copies = set(), 0
    for line in text.split("\n"):
        if words(line):
            copies += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    hit = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), copies, len(hit)


def texts():
    rng = random.Random(2)
    out = [None, "", " \n ", "a a a a", "# * é", "same\nsame\n same\nsame", "x\u00a0y z\x85 q", "one\x1ctwo"]
    for n in (49, 50, 51, 120, 400):
        out.append(" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)))
        out.append("\n".join(" ".join(f"w{rng.randrange(4000)}" for _ in range(7)) for _ in range(n // 7 + 1)))
        out.append("the same words again " * n)
    return out


def test_counts_of_texts():
    for text in texts():
        n_words, chars, symbols, _, copies, repeats = host_rules.text_counts(text)
        assert (n_words, chars, symbols, copies, repeats) == counts(text)


def test_base_rules_and_columns(spark):
    docs = spark.createDataFrame(
        [(i, t, "h", "x", True) for i, t in enumerate(texts())], "doc_id int, text string, source string, n_docs string, host_failed boolean"
    )
    rows = {r.doc_id: r for r in host_rules.judge(docs).collect()}
    for i, text in enumerate(texts()):
        n, _, _, _, repeats = counts(text)
        assert rows[i].base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert rows[i].kept == (not rows[i].base_failed)
    kept = host_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in rows if rows[i].kept)
    assert host_rules.judge(docs.limit(0)).collect() == [] and host_rules.keep_good(docs.limit(0)).collect() == []


def test_host_of_failures_goes(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [("bad", "x" if i else good) for i in range(400)] + [("good", good)] * 400 + [("small", "x")] * 2 + [("mixed", good if i % 2 else "x") for i in range(60)]
    rows += [(None, good), (None, "x"), ("few", good)]
    docs = spark.createDataFrame([(i, t, s) for i, (s, t) in enumerate(rows)], "doc_id long, text string, source string")
    verdicts = {r.source: r for r in host_rules.host_verdicts(host_rules.measured(docs)).collect()}
    assert set(verdicts) == {"bad", "good", "small", "mixed", "few"}
    assert verdicts["bad"].host_failed and not any(verdicts[s].host_failed for s in ("good", "small", "mixed", "few"))
    assert 0 < verdicts["few"].short_rate < verdicts["small"].short_rate < verdicts["bad"].short_rate
    judged = host_rules.judge(docs).collect()
    assert not any(r.kept for r in judged if r.source == "bad")
    assert sum(r.kept for r in judged if r.source is None) == 1
    assert all(r.kept != r.base_failed for r in judged if r.source != "bad")
    assert {r.doc_id for r in host_rules.keep_good(docs).collect()} == {r.doc_id for r in judged if r.kept}
