"""The corpus pipeline, stage by stage, on planted documents."""

import random
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from gridloom.llm import host_rules, minhash_join
from gridloom.llm.oracles import ORACLES
from gridloom.llm.queries import QUERIES
from tests.llm.helpers import grouped, shingles
from tests.llm.test_credentials import masked
from tests.llm.test_line_dedup import expected as line_expected
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


def planted():
    rng = random.Random(11)
    fresh = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    shared = "This very passage of well over twenty characters is everywhere"
    base = fresh(120).split()
    near = list(base)
    near[50] = "changed"
    rows = {
        0: fresh(100),
        1: fresh(10),
        2: "spam and more of it " * 60,
        3: f"{shared}\n{fresh(90)}",
        4: f"{shared}\n{fresh(90)}",
        5: f"{fresh(90)}\n{shared}",
        6: " ".join(base),
        7: " ".join(near),
        8: " ".join(base),
        9: f"{fresh(80)} password=hunter22 {fresh(20)}",
        10: None,
        11: "",
    }
    return [(i, t, "en", f"src{i % 2}", len(t or ""), "more") for i, t in rows.items()], shared


def test_stages_take_effect(spark):
    rows, shared = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra string")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, None)
        assert docs.columns == columns, name
        kept.append({r.doc_id: r for r in docs.collect()})
    assert set(kept[0]) == {0, 3, 4, 5, 6, 7, 8, 9}
    assert set(kept[1]) == set(kept[0]) and [i for i, r in kept[1].items() if shared in r.text] == [5]
    assert set(kept[2]) == {0, 3, 4, 5, 6, 9}
    assert set(kept[3]) == set(kept[2]) and "hunter22" not in kept[3][9].text
    assert all(r.n_chars == len(r.text) for r in kept[3].values())
    assert kept[3][0].text == dict((r[0], r[1]) for r in rows)[0]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, None).collect()
    assert {r.doc_id for r in pieces} == set(kept[3])
    assert corpus_pipeline.run.__name__ == contract.queries()["pipeline"].__name__


def test_near_copies_between_the_thresholds_go(spark):
    """A pair at 105 of 127 shingles, 0.827, is one document in the pipeline and two in op1."""
    words = [f"w{i}" for i in range(120)]
    near = ["first", *words[1:]]
    near[40], near[80] = "changed", "too"
    a, b = " ".join(words), " ".join(near)
    both = shingles(a), shingles(b)
    assert 0.82 < len(both[0] & both[1]) / len(both[0] | both[1]) < 0.83
    docs = spark.createDataFrame([(1, a), (2, b), (3, a.upper() + " and more of it")], "doc_id long, text string")
    assert {r.doc_id for r in dict(corpus_pipeline.STAGES)["minhash_near_dedup"](spark, docs, None).collect()} == {1}
    assert {r.doc_id for r in minhash_join.one_of_each(docs).collect()} == {1, 2}


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF) is None


def host_rates(rows):
    """Shrunk failure rates of each host and rule, as the prior of all hosts has them."""
    fails = {
        "short": lambda c: c[0] < 50,
        "repetitive": lambda c: 100 * c[5] > 50 * c[0],
        "symbols": lambda c: 10 * c[2] > 10 * c[0],
        "copied": lambda c: 100 * c[4] > 50 * c[3],
    }
    hosts = {}
    for r in rows:
        if r["source"] is not None:
            hosts.setdefault(r["source"], []).append(host_rules.text_counts(r["text"]))
    total, squares = sum(map(len, hosts.values())), sum(len(h) ** 2 for h in hosts.values())
    out = {h: [] for h in hosts}
    for rule in fails.values():
        failed = {h: sum(map(rule, c)) for h, c in hosts.items()}
        p = sum(failed.values()) / total
        chance = p * (1 - p)
        strength = None
        if len(hosts) > 1 and total > squares / total and chance > 0:
            spread = sum(f * f / len(hosts[h]) for h, f in failed.items()) - total * p * p - (len(hosts) - 1) * chance
            between = spread / (total - squares / total)
            if between > 0:
                strength = max(chance / between - 1, 2.0)
        for h, f in failed.items():
            out[h].append(p if strength is None else (f + p * strength) / (len(hosts[h]) + strength))
    return out


def by_hand(rows):
    """The five stages in plain Python, on rows as dictionaries; rows of pieces without sequence ids."""
    bad = {h for h, rates in host_rates(rows).items() if max(rates) > host_rules.MAX_RATE}
    good = []
    for r in rows:
        n, *_, repeats = host_rules.text_counts(r["text"])
        if n >= 50 and not 100 * repeats > 50 * n and r["source"] not in bad:
            good.append((r["doc_id"], r["text"]))
    lined = {i: text for i, _, _, text in line_expected(good)}
    sets = {i: shingles(t) for i, t in lined.items()}
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = grouped(list(sets), links)
    kept = {i: masked(lined[i]) for i in lined if root[i] == i}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for i, text in kept.items():
        tokens = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        start = 0
        while start < len(tokens):
            length = min(2048, 1 << (len(tokens) - start).bit_length() - 1)
            out.append((i, start, length, len(tokens), tokens[start : start + length]))
            start += length
    return sorted(out)


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
def test_whole_pipeline_against_plain_python(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.start, r.length, r.doc_tokens, r.ids) for r in got) == by_hand(rows)
    assert len({r.sequence_id for r in got}) == len(got) and all(1 << r.bucket == r.length for r in got)


def test_repeated_rows_and_empty_tables(spark, tmp_path):
    rows, _ = planted()
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string"
    for name, given in (("twice", [*rows, *rows]), ("none", []), ("all_rejected", rows[10:])):
        folder = tmp_path / name
        folder.mkdir()
        spark.createDataFrame(given, schema).write.parquet(str(folder / "documents.parquet"))
        got = corpus_pipeline.run(spark, str(folder)).collect()
        if name == "twice":
            once = {(r.doc_id, r.start): r.ids for r in got}
            assert len(got) == len(once) and {r.doc_id for r in got} == {0, 3, 4, 5, 6, 9}
        else:
            assert got == []


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in contract.queries() if n.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 14)}
