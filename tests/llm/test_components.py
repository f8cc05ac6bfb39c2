"""Components against plain Python, and what a round moves."""

import random

import pytest

from gridloom.llm import common
from tests.conftest import plan_of
from tests.llm.helpers import grouped


@pytest.mark.parametrize("few, moves", [(100_000, 6), (0, 99)])
def test_components_of_paths_and_hubs(spark, monkeypatch, few, moves):
    monkeypatch.setattr(common, "FEW_EDGES", few)
    plans = []
    settled = common.settled
    monkeypatch.setattr(common, "settled", lambda df: plans.append(plan_of(df)) or settled(df))
    rng = random.Random(2)
    path = [(k, k + 1) for k in range(40)]
    hub = [(1000, 1000 + rng.randrange(60)) for _ in range(50)] + [(1003, 1003)]
    some = [(2000 + rng.randrange(80), 2000 + rng.randrange(80)) for _ in range(60)]
    edges = path + hub + some
    found = {r.id: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ends = {x for a, b in edges if a != b for x in (a, b)}
    assert found == grouped(ends, [(a, b) for a, b in edges if a != b])
    # As planned; the exchanges that are the same run once.
    assert max(p.count("Exchange hashpartitioning") for p in plans[1:]) <= moves


def test_no_edges(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []
