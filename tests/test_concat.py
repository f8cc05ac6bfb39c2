import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators.concat import VariantCells, concat_order, concat_tagged, concat_variants
from gridloom.sources.commits import CommitLog
from gridloom.sources.series import KeptSeries
from tests.conftest import collected, plan_of

SCHEMA = "latitude double, time double, v string"


def by_hand(variants):
    """Variants as (priority, rows of (latitude, time, v)) in input order."""
    ranked = sorted(variants, key=lambda p: float("inf") if p[0] is None else p[0])
    out, last = list(ranked[0][1]), max((r[1] for r in ranked[0][1]), default=None)
    for _, rows in ranked[1:]:
        fresh = [r for r in rows if last is None or r[1] > last]
        out += fresh
        last = max([r[1] for r in fresh] + ([] if last is None else [last]), default=None)
    return sorted(out)


def load(spark, variants):
    return [
        VariantCells(f"v{i}", spark.createDataFrame(rows, SCHEMA), priority)
        for i, (priority, rows) in enumerate(variants)
    ]


def rows_of(name, first, last):
    return [(float(k % 3), float(t), f"{name}{t}") for k, t in enumerate(range(first, last + 1))]


CASES = {
    "overlap": [(2, rows_of("n", 5, 12)), (1, rows_of("f", 0, 8))],
    "three": [(3, rows_of("c", 0, 20)), (1, rows_of("a", 0, 8)), (2, rows_of("b", 6, 12))],
    "nothing new": [(1, rows_of("a", 0, 8)), (2, rows_of("b", 2, 8)), (3, rows_of("c", 7, 10))],
    "no priority last": [(None, rows_of("x", 0, 9)), (7, rows_of("y", 0, 5))],
    "ties keep order": [(0, rows_of("p", 0, 5)), (0, rows_of("q", 3, 9)), (0, rows_of("r", 0, 12))],
    "unsorted axis": [(1, rows_of("a", 0, 8)[::-1]), (2, rows_of("b", 4, 12)[::-1])],
    "gap": [(1, rows_of("a", 0, 3)), (2, rows_of("b", 10, 12))],
}


@pytest.mark.parametrize("name", CASES)
def test_concatenation(spark, name):
    variants = CASES[name]
    loaded = load(spark, variants)
    assert collected(concat_variants(loaded)) == by_hand(variants)
    tagged = None
    for i, v in enumerate(loaded):
        part = v.cells.withColumns(
            {"variant": F.lit(v.variant), "concat_priority": F.lit(v.concat_priority).cast("double"), "n": F.lit(i)}
        )
        tagged = part if tagged is None else tagged.unionByName(part)
    got = concat_tagged(tagged, order="n")
    assert collected(got, "latitude", "time", "v") == by_hand(variants)


def test_single_and_empty_lists(spark):
    (only,) = load(spark, [(1, rows_of("a", 0, 3))])
    assert concat_variants([only]) is only.cells
    with pytest.raises(ValueError):
        concat_variants([])


def test_empty_variant(spark):
    variants = [(1, []), (2, rows_of("b", 0, 3))]
    assert collected(concat_variants(load(spark, variants))) == by_hand(variants)
    with pytest.raises(ValueError):
        concat_variants(load(spark, variants), strict=True)


def test_missing_axis_and_other_columns(spark):
    a, b = load(spark, [(1, rows_of("a", 0, 3)), (2, rows_of("b", 0, 9))])
    with pytest.raises(ValueError):
        concat_variants([VariantCells("v", a.cells.drop("time"), 1), b])
    with pytest.raises(Exception):
        concat_variants([a, VariantCells("w", b.cells.withColumn("extra", F.lit(1)), 2)]).count()


def test_other_dimension_and_types(spark):
    frames = [
        spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-03")], "v int, day string"),
        spark.createDataFrame([(3, "2024-01-03"), (4, "2024-01-05")], "v int, day string"),
    ]
    for cast in ("date", "timestamp", "timestamp_ntz", "string"):
        parts = [
            VariantCells(str(i), f.withColumn("day", F.col("day").cast(cast)), i, "day")
            for i, f in enumerate(frames)
        ]
        assert collected(concat_variants(parts), "v") == [(1,), (2,), (4,)]


def test_text_axis_must_hold_dates(spark):
    parts = [
        VariantCells(str(i), spark.createDataFrame([(i, t)], "v int, time string"), i)
        for i, t in enumerate(("spring", "summer"))
    ]
    with pytest.raises(Exception):
        concat_variants(parts).collect()


def test_order(spark):
    cells = spark.range(1).toDF("time")
    names = [VariantCells("a", cells), VariantCells("b", cells, 2), VariantCells("c", cells, 1), VariantCells("d", cells, 2)]
    assert [v.variant for v in concat_order(names)] == ["c", "b", "d", "a"]


def test_many_datasets_at_once(spark):
    rng, rows = random.Random(1), []
    expected = []
    for d in range(12):
        variants = []
        for k in range(rng.randint(1, 4)):
            start = rng.randint(0, 10)
            variants.append((rng.choice([0, 1, 2, None]), rows_of(f"{d}.{k}.", start, start + rng.randint(0, 12))))
        expected += [(d, *r) for r in by_hand(variants)]
        rows += [(d, k, None if p is None else float(p), *r) for k, (p, rs) in enumerate(variants) for r in rs]
    df = spark.createDataFrame(rows, "d int, k int, p double, latitude double, time double, v string")
    got = concat_tagged(df, variant="k", priority="p", group=("d",), order="k")
    assert collected(got, "d", "latitude", "time", "v") == sorted(expected)


def test_cutoff_reaches_the_scan(spark, tmp_path):
    for name, first, last in (("a", 0, 50), ("b", 30, 90)):
        spark.createDataFrame(rows_of(name, first, last), SCHEMA).write.parquet(str(tmp_path / name))
    parts = [VariantCells(n, spark.read.parquet(str(tmp_path / n)), i) for i, n in enumerate("ab")]
    joined = concat_variants(parts)
    plan = plan_of(joined)
    assert "Join" not in plan and "GreaterThan(time,ScalarSubquery" in plan
    assert joined.count() == 51 + 40


# --- kept series ---------------------------------------------------------------

TAGGED = "g string, variant string, concat_priority double, ord long, time double, v string"


def joined_by_hand(source):
    """The series of each group, as ``by_hand`` makes it of all variants in it."""
    out = []
    for g in {k[0] for k in source}:
        mine = sorted((k[1], x) for k, x in source.items() if k[0] == g)
        ranked = sorted(mine, key=lambda m: (float("inf") if m[1]["p"] is None else m[1]["p"], m[1]["ord"], m[0]))
        last = None
        for name, x in ranked:
            out += [(g, name, t, v) for t, v in x["rows"] if last is None or t > last]
            last = max([t for t, _ in x["rows"]] + ([] if last is None else [last]), default=None)
    return sorted(out)


def tagged_rows(spark, source, names):
    rows = [(g, n, source[g, n]["p"], source[g, n]["ord"], t, v) for g, n in names for t, v in source[g, n]["rows"]]
    return spark.createDataFrame(rows, TAGGED)


@pytest.mark.parametrize("seed", [1, 2])
def test_kept_series_equal_a_full_join_after_any_writes(spark, tmp_path, seed):
    rng = random.Random(seed)
    series = KeptSeries(spark, str(tmp_path / "series"), group=("g",))
    priorities = {n: rng.choice([None, 1.0, 2.0, 2.0, 5.0]) for n in "abcd"}
    source = {}
    for step in range(7):
        mode = rng.choice(["append", "append", "overwrite"])
        names = {(rng.choice("xy"), rng.choice("abcd")) for _ in range(rng.choice([1, 1, 2]))}
        delta = {}
        for k in names:
            first = rng.randrange(0, 30)
            rows = [(float(t), f"{k}{step}:{t}") for t in rng.sample(range(first, first + 12), rng.randrange(1, 6))]
            delta[k] = {"p": priorities[k[1]], "ord": "dbca".index(k[1]), "rows": rows}
            old = source.get(k, {"rows": []})["rows"] if mode == "append" else []
            source[k] = {**delta[k], "rows": old + rows}
        number = series.apply(tagged_rows(spark, delta, sorted(delta)), mode, tagged_rows(spark, source, sorted(source)))
        assert number == step + 1
        assert collected(series.read()) == joined_by_hand(source), step
    series.compact()
    assert collected(series.read()) == joined_by_hand(source)
    for k in source:
        source[k]["rows"] = source[k]["rows"][:1]
    series.apply(tagged_rows(spark, source, sorted(source)), "overwrite")
    assert collected(series.read()) == joined_by_hand(source)


def test_an_update_writes_what_it_adds(spark, tmp_path):
    series = KeptSeries(spark, str(tmp_path / "series"), group=("g",))
    source = {
        ("x", "fin"): {"p": 1.0, "ord": 0, "rows": [(float(t), f"f{t}") for t in range(50)]},
        ("x", "non"): {"p": 2.0, "ord": 1, "rows": [(float(t), f"n{t}") for t in range(40, 80)]},
    }

    def batch(number):
        token = {r.number: r.token for r in CommitLog(spark, series.root).entries().collect()}[number]
        return spark.read.parquet(f"{series.root}/cells/token={token}")

    series.apply(tagged_rows(spark, source, sorted(source)))
    assert batch(1).count() == 80
    # The preferred variant reaches further: its cells are added, the other's are only hidden.
    more = {("x", "fin"): {"p": 1.0, "ord": 0, "rows": [(float(t), f"f{t}") for t in range(50, 70)]}}
    series.apply(tagged_rows(spark, more, sorted(more)))
    assert batch(2).count() == 20 and series.read().where("variant = 'non'").count() == 10
    # Replaced by a shorter one: of the other variant only what is not held is fetched.
    short = {**source, ("x", "fin"): {"p": 1.0, "ord": 0, "rows": [(float(t), f"s{t}") for t in range(45)]}}
    with pytest.raises(ValueError):
        series.apply(tagged_rows(spark, short, [("x", "fin")]), "overwrite")
    series.apply(tagged_rows(spark, short, [("x", "fin")]), "overwrite", tagged_rows(spark, short, sorted(short)))
    assert batch(3).count() == 45 + 5
    assert collected(series.read()) == joined_by_hand(short)
    with pytest.raises(ValueError):
        series.apply(spark.createDataFrame([("x", "fin", 1.0, 0, "2020", "v")], TAGGED.replace("time double", "time string")))
    odd = spark.createDataFrame([("x", "odd", None, 9, None, "a"), ("x", "odd", None, 9, float("nan"), "b"), ("x", "odd", None, 9, 99.0, "c")], TAGGED)
    series.apply(odd)
    assert collected(series.read().where("variant = 'odd'"), "time") == [(99.0,)]
