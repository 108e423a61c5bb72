import random

import pytest

from sitefold.operators.components import components
from sitefold.plans.shared import materialise


def union_find(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("seed,small", [(1, 0), (2, 0), (3, 10**6), (4, 10)])
def test_random_graphs(spark, seed, small):
    r = random.Random(seed)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(60)] + [(k, k + 1) for k in range(200, 230)] + [(300, k) for k in range(301, 330)]
    got = components(spark.createDataFrame(edges, "src long, dst long"), small=small)
    assert {r.node: r.component for r in got.collect()} == union_find(edges)


def test_empty_and_null_ends(spark):
    for small in (0, 10):
        assert components(spark.createDataFrame([], "src string, dst string"), small=small).count() == 0
        got = components(spark.createDataFrame([("b", "a"), (None, "a"), ("c", "c")], "src string, dst string"), small=small)
        assert {tuple(x) for x in got.collect()} == {("a", "a"), ("b", "a"), ("c", "c")}


def test_stars_are_not_written_again_each_round(spark):
    """120 stars in chains, their hubs in no order: rounds over all links wrote them six times and more."""
    r = random.Random(5)
    hubs = r.sample(range(10**6), 120)
    edges = [(h, 10**6 * (k + 1) + h) for h in hubs for k in range(15)] + [(a, b) for k, (a, b) in enumerate(zip(hubs, hubs[1:])) if k % 40 < 39]
    written = []

    def keep(df, name):
        out = materialise(df, name)
        written.append(out.count())
        return out

    got = components(spark.createDataFrame(edges, "src long, dst long"), keep=keep, small=150)
    assert {x.node: x.component for x in got.collect()} == union_find(edges)
    assert sum(written) < 4 * len(edges)
