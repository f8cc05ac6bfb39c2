"""Url verdicts and the spread of trust, against plain Python."""

import random
import time

import pytest

from gridloom.llm import host_trust

RULES = host_trust.RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.index(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


def rule_of(host, path):
    best = (None, None)
    for verdict, rule in RULES:
        name, begin = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + begin):
            if best[0] is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return best


URLS = [
    None, "", "no url", "http://A.Example.NET/en/x?y=1", "https://example.net", "https://example.net/", "http://notexample.net/en/",
    "ftp://sub.example.com/de/1#f", "http://example.com/den", "http://example.com/DE/", "x://É.ORG/fr/", "http://org/fr/a?b#c",
    "http://a.org/fr", "a://b://c/d", "http://h?x/://y", "http://\nnet/a\nb?c", "://net/", "http://user@net:80/x",
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, None, "x", 1) for i, u in enumerate(URLS)], "page_id long, url string, html string, host string, verdict int")
    rows = {r.page_id: r for r in host_trust.judged(pages).collect()}
    assert len(rows) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule)
        if rule:
            assert rows[i].verdict == verdict
        if not host:
            assert rows[i].verdict == "allow"
    assert host_trust.judged(pages.limit(0)).collect() == []


def test_distrust_goes_back_along_links(spark):
    link = lambda *hosts: "".join(f'<p><A class=x HREF="https://{h}/p">t</a><a href=/own>o</a>' for h in hosts)
    pages = [
        (1, "http://spam.net/a", link("farm.io")),
        (2, "http://farm.io/a", link("spam.net", "spam.net")),
        (3, "http://fair.io/a", link("good.org")),
        (4, "http://good.org/fr/a", link("fair.io", "best.io")),
        (5, "http://best.io/a", None),
        (6, "http://good.org/de", '<a href="//best.io/x">'),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    edges = {(r.source, r.target): r.links for r in host_trust.host_edges(df).collect()}
    assert edges == {
        ("spam.net", "farm.io"): 1, ("farm.io", "spam.net"): 2, ("fair.io", "good.org"): 1, ("good.org", "fair.io"): 1, ("good.org", "best.io"): 2,
    }
    verdicts = {r.page_id: r.verdict for r in host_trust.judged(df).collect()}
    assert verdicts == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow"}


def scores_of(edges, seeds):
    """Both kinds of score after very many rounds."""
    total = {}
    for a, _, n in edges:
        total[a] = total.get(a, 0) + n
    hosts = {x for a, b, _ in edges for x in (a, b)} | {s[0] for s in seeds}
    out = []
    for kind in (0, 1):
        base = {h: 0.0 for h in hosts} | {s[0]: 0.15 * s[1 + kind] for s in seeds}
        score = dict(base)
        for _ in range(300):
            new = dict(base)
            for a, b, n in edges:
                giver, taker = (a, b) if kind == 0 else (b, a)
                new[taker] += 0.85 * score[giver] * n / total[a]
            score = new
        out.append(score)
    return out


def test_scores_are_those_of_the_iteration(spark):
    edges = [("a", "b", 1), ("a", "c", 3), ("b", "c", 2), ("c", "a", 1), ("d", "a", 5), ("e", "d", 1)]
    seeds = [("a", 1.0, 0.0), ("b", 0.0, 0.5), ("c", 0.0, 0.0), ("d", 0.25, 1.0)]
    got = host_trust.spread(
        spark.createDataFrame(edges, "source string, target string, links long"),
        spark.createDataFrame(seeds, "host string, trusted double, blocked double"),
    )
    got = {r.host: (r.trust, r.distrust) for r in got.collect()}
    for kind, score in enumerate(scores_of(edges, seeds)):
        for host, value in score.items():
            assert got.get(host, (0, 0))[kind] == pytest.approx(value, abs=1e-5)


HTML = "page_id long, url string, html string"


@pytest.mark.parametrize("linkers", [1, 2, 50])
def test_a_verdict_does_not_hang_on_how_many_link(spark, linkers):
    pages = [(0, "http://spam.net/", None)]
    pages += [(1 + k, f"http://h{k}.io/", '<a href="http://spam.net/x">') for k in range(linkers)]
    pages += [(500, "http://mixed.io/", '<a href="http://spam.net/x"><a href="http://a.io"><a href="http://b.io">'), (501, "http://far.io/", '<a href="http://h0.io">')]
    verdicts = {r.page_id: r.verdict for r in host_trust.judged(spark.createDataFrame(pages, HTML)).collect()}
    assert all(verdicts[1 + k] == "block" for k in range(linkers))
    assert verdicts[500] == "allow" and verdicts[501] == "block"


def test_links_are_those_of_tags(spark):
    html = [
        '<a href="/out?u=http://spam.net/x">', '<a data-href="http://spam.net/x" href="/own">', '<a xhref="http://spam.net/x">',
        '<abbr href="http://spam.net/x">', '<p>a href="http://spam.net/x"</p>', '<a href="mailto:x://y">', '<area href="http://spam.net/">',
        '<a\nclass="b"HREF = http://one.io/x>', "<A title='x' href='//two.io'>", '<a/href=http://three.io><a href="HTTPS://Four.IO:80/">', None, "<a", "<a >",
    ]
    df = spark.createDataFrame([(i, "http://here.io/", h) for i, h in enumerate(html)] + [(99, None, html[0])], HTML)
    edges = {(r.source, r.target): r.links for r in host_trust.host_edges(df).collect()}
    assert edges == {("here.io", h): 1 for h in ("one.io", "two.io", "three.io", "four.io:80")}


def test_a_megabyte_of_open_tags_takes_no_long(spark):
    pieces = ["<a ", "<a href ", "<a href=", "< ", "a href='", '<a "', "http://x.io "]
    pages = [(k, f"http://h{k}.io/", p * (1_000_000 // len(p))) for k, p in enumerate(pieces)]
    begin = time.monotonic()
    assert host_trust.host_edges(spark.createDataFrame(pages, HTML)).count() <= len(pages)
    assert time.monotonic() - begin < 60


def test_repeated_pages_and_equal_scores(spark):
    link = '<a href="http://spam.net/x"><a href="http://good.org/y">'
    pages = [(1, "http://both.io/", link)] * 3 + [(2, "http://spam.net/", None), (3, "http://good.org/fr/", '<a href="http://both.io/">')]
    rows = host_trust.judged(spark.createDataFrame(pages, HTML)).collect()
    assert len(rows) == 5 and len({r.verdict for r in rows if r.page_id == 1}) == 1
    edges = {(r.source, r.target): r.links for r in host_trust.host_edges(spark.createDataFrame(pages, HTML)).collect()}
    assert edges == {("both.io", "spam.net"): 3, ("both.io", "good.org"): 3, ("good.org", "both.io"): 1}
    # Half its pages blocked and half allowed by rule: as much trust as distrust.
    even = spark.createDataFrame([(1, "http://example.net/en/", None), (2, "http://example.net/x", None), (3, "http://example.net/", None), (4, "http://example.net/en/", None)], HTML)
    assert {r.page_id: r.verdict for r in host_trust.judged(even).collect()} == {1: "allow", 2: "block", 3: "block", 4: "allow"}


def test_query_against_sql_with_links(spark, tmp_path):
    """The given pages have no absolute links, so the SQL is held to some that do."""
    import __spark_entry__ as contract
    from tests.oracle import compare, connect

    rng = random.Random(3)
    hosts = ["spam.net", "bad.net", "good.org", *(f"h{k}.io" for k in range(20))]
    pages = [
        (i, f"http://{rng.choice(hosts)}/fr/{i}", "".join(f'<p><a class="x" href="http://{rng.choice(hosts)}/p">t</a>' for _ in range(rng.randrange(4))))
        for i in range(120)
    ]
    spark.createDataFrame(pages, HTML).toPandas().to_parquet(tmp_path / "pages.parquet")
    name = "op4_host_trust"
    assert compare(spark, connect(str(tmp_path)), name, contract.queries()[name], contract.oracle_sql()[name], str(tmp_path)) is None
    assert {r.verdict for r in contract.queries()[name](spark, str(tmp_path)).where("rule IS NULL").collect()} == {"allow", "block"}
