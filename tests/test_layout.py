"""Layouts for maps, numbers in order, and the facility array, against plain computations."""

import gzip
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from sitefold.operators.ranking import ranked
from sitefold.plans import publish, tiles


def read_rows(df):
    """Rows that the scan of an executed plan gave out."""
    df._jdf.queryExecution().toRdd().count()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def mercator(lat, lon):
    s = math.sin(math.radians(lat))
    return (lon + 180) / 360, 0.5 - math.log((1 + s) / (1 - s)) / (4 * math.pi)


@pytest.fixture(scope="module")
def places():
    rng = random.Random(5)
    some = [(f"u{k:05}", rng.uniform(-84, 84), rng.uniform(-180, 179.9)) for k in range(30_000)]
    some += [(f"v{k:05}", 47.0 + rng.random() / 50, 8.0 + rng.random() / 50) for k in range(10_000)]  # a town
    return some + [("pole", 90.0, 0.0), ("north", 88.0, 10.0), ("none", None, None), ("half", 10.0, None)]


@pytest.fixture(scope="module")
def layout(spark, places, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "l")
    tiles.lay_out(spark.createDataFrame(places, "uid string, lat double, lon double"), path, group_rows=500)
    return tiles.Tiles(spark, path)


def test_small_viewport_reads_few_rows(layout, places):
    at = {u: mercator(a, o) for u, a, o in places if a is not None and o is not None and u != "pole"}
    assert layout.rows.count() == len(at) and layout.counts.agg(F.sum("n")).first()[0] == len(at) - 1
    for x0, y0, x1, y1 in ((0.2, 0.3, 0.23, 0.33), (0.5, 0.3, 0.53, 0.4), (0.9, -0.2, 1.2, 0.05), (0.4, 0.4, 0.4, 0.4)):
        seen = layout.viewport(x0, y0, x1, y1)
        assert sorted(r.uid for r in seen.select("uid").collect()) == sorted(u for u, (x, y) in at.items() if x0 <= x <= x1 and y0 <= y <= y1)
    assert read_rows(layout.viewport(0.2, 0.3, 0.23, 0.33)) < 0.05 * len(at)


def test_nearest_by_tiles_equals_all_distances(layout, places):
    at = {u: mercator(a, o) for u, a, o in places if a is not None and o is not None and u != "pole"}
    rng = random.Random(6)
    points = [(rng.random(), rng.random(), r, n) for r, n in ((0.3, 40), (0.01, 40), (2, 1), (1e-6, 5))] + [(*mercator(47.01, 8.01), 0.5, 40), (0, 0, 3, 7), (0.53, -0.06, 0.5, 3), (0.5, 0.5, 2, 50_000)]
    for x, y, reach, n in points:
        d = sorted(((px - x) * (px - x) + (py - y) * (py - y), u) for u, (px, py) in at.items())
        want = [u for d2, u in d if d2 <= reach * reach][:n]
        assert [r.uid for r in layout.nearest(x, y, reach, n).collect()] == want, (x, y, reach, n)
    x, y = mercator(47.01, 8.01)
    r = layout.radius(x, y, 0.5, 40)
    assert r < 0.004 and read_rows(layout.viewport(x - r, y - r, x + r, y + r)) < 0.4 * len(at)  # the town is a quarter of all


def test_layout_in_versions_and_empty(spark, tmp_path):
    path = str(tmp_path / "l")
    with pytest.raises(ValueError):
        tiles.Tiles(spark, path)
    none = spark.createDataFrame([], "uid string, lat double, lon double")
    assert tiles.lay_out(none, path) == 1
    old = tiles.Tiles(spark, path)
    assert old.nearest(0.5, 0.5, 1).count() == 0
    assert tiles.lay_out(spark.createDataFrame([("a", 0.0, 0.0), ("b", 0.0, 0.0)], none.schema), path) == 2
    assert [r.uid for r in tiles.Tiles(spark, path).nearest(0.5, 0.5, 1).collect()] == ["a", "b"] and old.rows.count() == 0


def test_ranked_numbers_all_rows_in_order(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(40) if rng.random() < 0.9 else None, k) for k in rng.sample(range(5000), 3000)] + [(7, 10_000 + k) for k in range(3000)]
    out = ranked(spark.createDataFrame(rows, "a int, b int").repartition(9), "a", "b")
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r.a, r.b) for r in sorted(out.collect(), key=lambda r: r.id)] == want
    assert sorted(r.id for r in out.collect()) == list(range(6000))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert ranked(spark.createDataFrame([], "a int"), "a").count() == 0


def test_facility_array_is_one_json_array(spark, tmp_path):
    rows = [(f"f{k:03}", f'n "{k}"\nŐ' if k % 3 else None, [str(k)] if k % 2 else []) for k in range(100)]
    path = str(tmp_path / "f.json.gz")
    for some in (rows, rows[:1], []):
        publish.write_json_array(spark.createDataFrame(some, "uid string, name string, species array<string>").repartition(7), path)
        with gzip.open(path, "rt", encoding="utf-8") as f:
            assert json.load(f) == [{"uid": u, "name": n, "species": s} for u, n, s in some]
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["f.json.gz"]
