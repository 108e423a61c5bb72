"""Resolution kept up against resolution from the start, and chains against a search over a graph in memory."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from sitefold.operators import resolve, upkeep
from sitefold.plans.shared import materialise
from sitefold.schema import FIELDS, TYPES


def frame(spark, rows):
    df = spark.createDataFrame(rows, "source_id string, source_row_id string, name string, country_iso3 string, national_id string, id_scheme string, address string, postcode string, src_lat double, src_lon double, seq bigint")
    return df.select(*[(F.col(f) if f in df.columns else F.lit(None).cast(TYPES[f])).cast(TYPES[f]).alias(f) for f in FIELDS], "seq")


def made(rng, source, n, start):
    rows = []
    for k in range(n):
        name = " ".join(rng.sample(["mill", "river", "green", "old", "duck", "farm", "north"], rng.randrange(1, 4)))
        number = str(rng.randrange(3 * n)) if rng.random() < 0.3 else None
        where = rng.randrange(4)
        post = (f"{rng.randrange(n // 3)} Lane", f"P{rng.randrange(4)}") if where == 0 else (None, None)
        # A row of cells; some pairs meet only over a cell between them.
        at = (60 + rng.randrange(60) * 0.004, 5 + rng.randrange(3) * 0.009) if where == 1 else (None, None)
        rows.append((source, f"r{k}", name, rng.choice(["AAA", "BBB"]), number, "S", *post, *at, start + k))
    return rows


def decided(spark, rng, keys):
    pairs = [(*rng.sample(keys, 2), rng.choice(["split", "split", "merge"])) for _ in range(12)]
    return spark.createDataFrame([*pairs, ("b:r1", "gone:1", "merge"), ("gone:1", "c:r2", "merge"), ("a:r3", "gone:2", "merge"), ("gone:2", "c:r4", "merge")], "a_key string, b_key string, decision string")


def facts(keyed, tiers, queue):
    groups = {r.key: r.component for r in keyed.select("key", "component").collect()}
    return groups, sorted(tuple(r) for r in tiers.select("component", "tier").collect() if r.component in set(groups.values())), sorted(map(tuple, queue.collect()), key=repr)


@pytest.mark.parametrize("seed,split", [(1, False), (2, True)])
def test_replaced_source_gives_what_a_full_run_gives(spark, seed, split):
    rng = random.Random(seed)
    a, b, c = (made(rng, s, 50, 100 * k) for k, s in enumerate("abc"))
    after = [list(x) for x in b[5:]]
    for x in after[::9]:
        x[2], x[4] = "duck river", str(rng.randrange(40))
    after = [tuple(x) for x in after] + made(rng, "b", 60, 100)[52:]
    decisions = decided(spark, rng, [f"{s}:r{k}" for s in "abc" for k in range(50)]) if split else None
    keyed, tiers, queue = (materialise(x, "was") for x in resolve.resolve(frame(spark, a + b + c), decisions=decisions))
    got = upkeep.replace_source(keyed, tiers, queue, frame(spark, after), "b", decisions=decisions)
    want = resolve.resolve(frame(spark, a + after + c), decisions=decisions)
    for x, y in zip(facts(*got[:3]), facts(*want)):
        assert x == y
    states = {r.state: r.n for r in got.touched.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert states["removed"] == 5 + len(range(0, 45, 9)) and states["added"] == 8 + len(range(0, 45, 9))
    assert 0 < states["opened"] < 140
    if seed == 1:  # the same rows again touch nothing; no rows take the source away
        still = upkeep.replace_source(*(materialise(x, "was") for x in got[:3]), frame(spark, after), "b")
        assert still.touched.count() == 0 and facts(*still[:3]) == facts(*want)
        none = upkeep.replace_source(*got[:3], frame(spark, after).where("false"), "b")
        assert all(x == y for x, y in zip(facts(*none[:3]), facts(*resolve.resolve(frame(spark, a + c)))))


def test_chains_are_the_shortest(spark):
    rng = random.Random(4)
    edges = [(f"n{rng.randrange(60):02}", f"n{rng.randrange(60):02}", rng.choice(["id", "addr", "geo"])) for _ in range(75)] + [("n70", "n71", "geo"), ("n70", "n71", "addr")]
    pairs = [(f"n{rng.randrange(60):02}", f"n{rng.randrange(60):02}") for _ in range(25)] + [("n70", "n71"), ("n70", "n01"), ("n02", "n02")]
    near = {}
    for s, d, t in edges:
        for x, y in ((s, d), (d, s)):
            if x != y:
                near.setdefault(x, {})
                near[x][y] = min(t, near[x].get(y, t))
    want = []
    for a, b in set(pairs):
        depth, queue = {a: 0}, deque([a])
        while queue:
            x = queue.popleft()
            for y in near.get(x, {}):
                if y not in depth:
                    depth[y] = depth[x] + 1
                    queue.append(y)
        at = b
        while depth.get(at, 0) > 0:
            by = min(x for x in near[at] if depth.get(x) == depth[at] - 1)
            want.append((a, b, depth[at], by, at, near[by][at]))
            at = by
    got = resolve.chains(spark.createDataFrame(edges, "src string, dst string, tier string"), spark.createDataFrame(pairs, "a_key string, b_key string"))
    assert sorted(map(tuple, got.collect())) == sorted(want) and max(w[2] for w in want) > 3
    none = resolve.chains(spark.createDataFrame(edges, "src string, dst string, tier string"), spark.createDataFrame([], "a_key string, b_key string"))
    assert none.count() == 0 and none.columns == got.columns


def alike_rows(source, n, start, place=0, step=0.004, numbered=12):
    """Four names at two places of two countries each: most rows are like many others. Equal names merge at one place, and over
    250 m apart they are reviewed, as unequal ones are."""
    names = [f"mill river {x}" for x in ("building", "furniture", "household", "machinery")]
    return [(source, f"r{k}", names[k % 4], "AB"[k // 8 % 2] * 3, str(k // 14) if k % 7 == 0 and k < numbered else None, "S", *((f"{k // 4 % 2} Lane", "P1") if k % 5 == 0 else (None, None)), 60 + (place + k // 4 % 2) * step, 5.0, start + k) for k in range(n)]


def test_first_records_are_kept_up_as_all_pairs_are(spark):
    """Pairs of first records only go in and out. In one country rows are removed only, some first ones among them, so that pairs
    with one end outside of what is resolved again stay; in the other, classes gain rows."""
    a, b = alike_rows("a", 48, 0), alike_rows("b", 64, 100, place=1)
    after = [x for k, x in enumerate(b) if k >= 6 and k % 16 != 3] + [x for x in alike_rows("b", 80, 100, place=1)[64:] if x[3] == "BBB"]
    was = resolve.resolved(frame(spark, a + b))
    keyed, tiers, pairs, classes = (materialise(x, "was") for x in (was.keyed, was.tiers, was.pairs, was.classes))
    got = upkeep.replace_source(keyed, tiers, pairs, frame(spark, after), "b", classes=classes)
    want = resolve.resolve(frame(spark, a + after))
    rows = resolve.prepared(got.keyed)
    queue = materialise(resolve.described(resolve.dealt(got.queue, got.classes), rows, None), "queue")
    for x, y in zip(facts(got.keyed, got.tiers, queue), facts(*want)):
        assert x == y
    assert 3 * got.queue.count() < queue.count()


def test_chains_over_classes_are_those_over_all_pairs(spark, monkeypatch):
    rows = alike_rows("a", 90, 0, step=0.0016, numbered=90)
    keys = [f"a:r{k}" for k in range(90)]
    rng = random.Random(7)
    decisions = spark.createDataFrame([(*rng.sample(keys, 2), rng.choice(["split", "merge"])) for _ in range(16)], "a_key string, b_key string, decision string")
    pairs = spark.createDataFrame([tuple(rng.sample(keys, 2)) for _ in range(60)], "a_key string, b_key string")
    found = resolve.resolved(frame(spark, rows), decisions=decisions)
    got = sorted(map(tuple, resolve.chains(found.edges, pairs, found.groups, found.ties).collect()))
    monkeypatch.setattr(resolve, "MANY_EQUAL", 1 << 30)
    plain = resolve.resolved(frame(spark, rows), decisions=decisions)
    assert got == sorted(map(tuple, resolve.chains(plain.edges, pairs).collect())) and len({x[2] for x in got}) > 2
    assert found.edges.count() < plain.edges.count()
