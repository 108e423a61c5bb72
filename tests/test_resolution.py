import gzip
import json
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from sitefold.operators import assemble, geocode, resolve
from sitefold.plans import cli, publish
from sitefold.sources import registers
from sitefold.sources.files import load_table


@pytest.fixture(scope="module")
def selftest(spark):
    keyed, facilities, queue = cli.dedup(spark, cli.selftest_records(spark), decisions=cli.selftest_decisions(spark))
    return keyed, facilities.cache(), queue.cache()


def groups(facilities):
    return sorted(" ".join(sorted(m["key"].partition(":")[2] for m in r.members)) for r in facilities.collect())


def test_selftest_has_the_known_facilities(spark, selftest):
    cli.selftest(spark)
    _, facilities, queue = selftest
    got = {m["key"].partition(":")[2]: r for r in facilities.collect() for m in r.members}
    assert got["381"].match_tiers == ["id"] and got["b1"].match_tiers == ["addr"] and got["c1"].match_tiers == ["geo"]
    assert got["381"].name == "Lac Vert Abattoir Inc" and got["c1"].review and got["c3"].review and not got["b3"].review
    assert {(r.country, r.name_score, round(r.metres_apart, -1)) for r in queue.collect()} == {("URY", 1.0, 260), ("URY", 1.0, 500)}


def test_report_and_build(selftest, tmp_path):
    keyed, facilities, queue = selftest
    text = publish.write_report(assemble.report(keyed, facilities, queue), str(tmp_path / "r.md"))
    assert "| rows | 12 |" in text and "| facilities | 7 |" in text and "| mappable | 2 |" in text
    made = publish.build(facilities, str(tmp_path / "page.html"))
    assert made["facilities"] == 7
    data = json.loads(gzip.decompress((tmp_path / "page.data.json.gz").read_bytes()))
    assert data == json.loads((tmp_path / "page.data.json").read_text()) and made["bytes"] == (tmp_path / "page.data.json").stat().st_size
    found = {r.uid: r for r in facilities.collect()}
    assert [r["uid"] for r in data["rows"]] == sorted(found)
    for r in data["rows"]:
        f = found[r["uid"]]
        assert data["dictionaries"]["country"][r["country_id"]] == f.country_iso3 and r["name"] == f.name and r["y"] == (None if f.lat is None else round(f.lat * 1e5))
    inside = publish.build(facilities.withColumn("name", F.lit("</script>")), str(tmp_path / "one.html"), title="A & B", inline=True)
    text = (tmp_path / "one.html").read_text()
    assert not inside["large"] and text.count("</script>") == 1 and "A &amp; B" in text and "show({" in text


def test_order_of_rows_does_not_matter_and_no_row_is_lost(spark, selftest):
    records = cli.selftest_records(spark)
    twice = records.unionByName(records.where("source_row_id = 'c3'").withColumn("seq", F.lit(99).cast("long")))
    _, facilities, _ = cli.dedup(spark, twice.orderBy(F.desc("name")).repartition(3), decisions=cli.selftest_decisions(spark))
    assert groups(facilities) == ["381 a q1 q2", "b1 b2", "b3", "c1 c2", "c3 c3#2", "d1", "d2"]
    assert {r.uid for r in selftest[1].where("size(members) <> 1").collect()} <= {r.uid for r in facilities.collect()}


def test_decisions_merge_and_split(spark):
    decided = spark.createDataFrame([("osm_overpass:c3", "own_notes:c1", "merge"), ("own_notes:b1", "osm_overpass:b2", "split")], "a_key string, b_key string, decision string")
    keyed, facilities, queue = cli.dedup(spark, cli.selftest_records(spark), decisions=decided)
    assert groups(facilities) == ["381 a q1 q2", "b1", "b2", "b3", "c1 c2 c3", "d1 d2"]
    assert queue.count() == 0 and resolve.conflicts(keyed, decided).count() == 0


def words(name):
    return frozenset(name.split())


def plain_resolution(rows, split=frozenset()):
    """All pairs of each stage over plain lists: groups of keys, and the pairs to review."""
    up = {r["key"]: r["key"] for r in rows}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    review = []
    for stage in ("addr", "geo"):
        alike = []
        for a, b in combinations(sorted(rows, key=lambda r: r["key"]), 2):
            x, y = words(a["name"]), words(b["name"])
            score = len(x & y) / len(x | y)
            m = 0.0
            if stage == "addr":
                near = a["house"] == b["house"]
            else:
                m = 111194.93 * abs(a["lat"] - b["lat"])
                near = m <= 1500
            if near and score >= 0.4:
                alike.append((a["key"], b["key"], score >= 0.6 and m <= 250))
        apart = [p for p in alike if top(p[0]) != top(p[1])]
        for a, b, merges in apart:
            if merges and frozenset((a, b)) not in split:
                up[max(top(a), top(b))] = min(top(a), top(b))
        review += [(a, b) for a, b, merges in apart if top(a) != top(b) and (not merges or split) and frozenset((a, b)) not in split]
    sets = {}
    for r in rows:
        sets.setdefault(top(r["key"]), set()).add(r["key"])
    return sorted(sorted(s) for s in sets.values()), sorted(review)


def resolved(spark, rows, decisions=None):
    base = cli.selftest_records(spark).limit(0)
    full = spark.createDataFrame([("s", r["key"][2:], r["name"], "USA", f"{r['house']} Road", "A1", r["lat"], 5.0, k) for k, r in enumerate(rows)], "source_id string, source_row_id string, name string, country_iso3 string, address string, postcode string, src_lat double, src_lon double, seq long")
    keyed, facilities, queue = cli.dedup(spark, base.unionByName(full, allowMissingColumns=True), decisions=decisions)
    return sorted(sorted(m["key"] for m in r.members) for r in facilities.collect()), sorted(tuple(sorted((r.a_key, r.b_key))) for r in queue.collect())


@pytest.mark.parametrize("seed", range(2))
def test_stages_equal_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(resolve, "CROWD", (2, 256)[seed])
    monkeypatch.setattr(resolve, "MANY_EQUAL", (2, 32)[seed])
    rng = random.Random(seed)
    some = ["alder", "birch", "cedar", "dogwood", "elder", "fir", "grove", "holly"]
    rows = [{"key": f"s:{k:03}", "name": " ".join(rng.sample(some, rng.randrange(1, 5))), "house": rng.randrange(1, 9), "lat": rng.choice([10.0, 10.001, 10.004, 10.3]) + rng.choice([0, 0, 0.0005])} for k in range(110)]
    rows += [{**rng.choice(rows), "key": f"s:{k:03}"} for k in range(110, 160)]  # equal ones at one place
    assert resolved(spark, rows) == plain_resolution(rows)
    pairs = rng.sample([(a["key"], b["key"]) for a, b in combinations(rows, 2) if a["name"] == b["name"]], 25)
    decisions = spark.createDataFrame([(*p, "split") for p in pairs], "a_key string, b_key string, decision string")
    assert resolved(spark, rows, decisions) == plain_resolution(rows, {frozenset(p) for p in pairs})


def test_a_crowded_block_makes_few_pairs(spark):
    """20,000 records at one address and place: 2 * 10**8 pairs by block alone."""
    n = 20_000
    k = F.col("id")
    rows = spark.range(n).select(
        k.cast("string").alias("key"), k.alias("seq"), F.lit("s").alias("source_id"), F.lit("USA").alias("country"), F.lit("A#1").alias("ak"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"),
        F.when(k % 2 == 0, F.array(F.lit("mill"), F.lit("road"), F.concat(F.lit("w"), (k / 4).cast("long")), F.concat(F.lit("v"), k))).otherwise(F.array(F.lit("same"), F.lit("name"))).alias("words"),
    ).withColumn("text", F.array_join("words", " "))
    first, members = resolve.class_of(resolve.at_address(resolve.with_prefix(rows)), ["block"], None)
    assert (first.count(), members.count()) == (n // 2 + 1, n // 2)
    assert resolve._met(first, resolve.BY_SEQ).count() == n // 4  # those that share three of four words
    assert resolve.addr_pairs(first).count() == n // 4
    assert resolve.geo_pairs(first).count() == n // 4


def test_pairs_of_a_place_do_not_grow_with_the_square_of_its_copies(spark):
    """20 copies each of five names at one place, two of whose three words they share: 4,950 pairs if each copy meets each."""
    names = [f"mill {x} 103" for x in ("building", "furniture", "household", "machinery", "automobile")]
    rows = [("s", str(k), names[k % 5], "USA", 10.0, 5.0, k) for k in range(100)]
    full = spark.createDataFrame(rows, "source_id string, source_row_id string, name string, country_iso3 string, src_lat double, src_lon double, seq long")
    found = resolve.resolved(cli.selftest_records(spark).limit(0).unionByName(full, allowMissingColumns=True))
    assert (found.pairs.count(), found.classes.count(), found.edges.count()) == (10, 100, 95)
    assert found.queue.count() == 10 * 20 * 20
    facilities = assemble.assemble(found.keyed, found.tiers, found.pairs).collect()
    assert [(len(r.members), r.review, r.match_tiers) for r in facilities] == [(20, True, ["geo"])] * 5


def test_address_tier_reviews_and_merges(spark):
    rows = [("s", str(k), n, "USA", a, p, k) for k, (n, a, p) in enumerate([("Green Valley Farms", "12 Main", "A-1"), ("Green Valley Farms Ltd", "12 Main St", "a1"), ("Green Hill Farms", "12 Main", "A1"), ("Other", "12 Main", "A1"), ("Green Valley Farms", None, "A1")])]
    full = spark.createDataFrame(rows, "source_id string, source_row_id string, name string, country_iso3 string, address string, postcode string, seq long")
    base = cli.selftest_records(spark).limit(0)
    keyed, facilities, queue = cli.dedup(spark, base.unionByName(full, allowMissingColumns=True))
    assert sorted(facilities.select(F.size("members")).toPandas().iloc[:, 0]) == [1, 1, 1, 2]
    assert {(r.a_key, r.b_key) for r in queue.collect()} == {("s:0", "s:2"), ("s:1", "s:2")}


def test_geocode_cache_round(spark):
    records = resolve.with_keys(cli.selftest_records(spark))
    index = geocode.query_index(records)
    todo = geocode.outstanding(index, geocode.empty_cache(spark))
    answers = geocode.lookup(todo, lambda p: {"lat": 1.0, "lon": 2.0, "precision": "street", "provider": "dict"} if "43" in p["qkey"] else None)
    cache = geocode.updated(geocode.empty_cache(spark), answers).cache()
    assert [r.lat for r in geocode.hits(index, cache).collect()] == [1.0]
    assert geocode.outstanding(index, cache).count() == todo.count() - 1
    for _ in range(2):
        cache = geocode.updated(cache, geocode.lookup(geocode.outstanding(index, cache), lambda p: None)).cache()
    assert geocode.pending(index, cache).first().n == 0
    failing = geocode.lookup(todo, lambda p: 1 / 0)
    assert geocode.updated(geocode.empty_cache(spark), failing).count() == 0


def test_listings_keep_every_row(spark, tmp_path):
    """Two countries' approval lists: every row becomes a record and a member, whatever it leaves out."""
    rows = [f"{'' if k % 9 == 0 else k},Plant {k},Road {k},Town,,{('RM', 'FFP', 'SECTION II')[k % 3]},{('SH CP', '', 'PP')[k % 3]},{('EU-EFTA', 'third-country')[k % 2]}" for k in range(1, 400)]
    for name, part in (("chile", rows[:250]), ("new_zealand", rows[250:])):
        (tmp_path / f"{name}.csv").write_text("approval_number,name,address,city,region,section,activity,group\n" + "\n".join(part) + "\n", encoding="utf-8")
    found = registers.eu_list(spark, sorted(map(str, tmp_path.glob("*.csv"))), snapshot="x").cache()
    assert {r.source_id: r["count"] for r in found.groupBy("source_id").count().collect()} == {"eu_traces_third_country": 200, "eu_traces_member_state": 199}
    assert {r.country_iso3: r["count"] for r in found.groupBy("country_iso3").count().collect()} == {"CHL": 250, "NZL": 149}
    assert {r.slaughter: r["count"] for r in found.groupBy("slaughter").count().collect()} == {True: 133, None: 133, False: 133}
    keyed, facilities, _ = cli.dedup(spark, found)
    assert keyed.count() == facilities.agg(F.sum(F.size("members"))).first()[0] == 399


GEOCODER = """
def geocoder(parts):
    if parts["street"]:
        return {"lat": 9.0, "lon": 9.0, "precision": "rooftop", "provider": "p", "country": "QQ"}  # in another country
    return {"lat": 1.0, "lon": 2.0, "precision": "locality", "provider": "p"} if parts["city"] else None
"""


@pytest.fixture(scope="module")
def geocoder(spark, tmp_path_factory):
    """A provider in a module of its own, as a user would have one."""
    path = tmp_path_factory.mktemp("own") / "own_geocoder.py"
    path.write_text(GEOCODER)
    spark.sparkContext.addPyFile(str(path))
    import own_geocoder

    return own_geocoder.geocoder


def test_ladder_country_and_time(spark, geocoder):
    parts = {"qkey": "v2|us|a 1|b|c", "iso2": "US", "street": "a 1", "city": "b", "postcode": "c"}
    assert [(x["street"], x["city"], x["postcode"]) for x in geocode.ladder(parts)] == [("a 1", "b", "c"), (None, "b", "c"), (None, "b", None)]
    assert geocode.ladder({**parts, "street": "", "city": None, "postcode": ""}) == []
    assert not geocode.acceptable(parts, {"lat": 1, "lon": 1, "country": "ca"}) and geocode.acceptable(parts, {"lat": 1, "lon": 1, "country": "us"})
    todo = spark.createDataFrame([(parts["qkey"], 0, "US", "a 1", "b", "c")], "qkey string, seq long, iso2 string, street string, city string, postcode string")
    (r,) = geocode.lookup(todo, geocoder).collect()
    assert (r.lat, r.precision, r.error) == (1.0, "locality", None)
    assert geocode.lookup(todo, geocoder, seconds=0).count() == 0


def test_geocode_verb_saves_the_cache(spark, tmp_path, geocoder):
    work = str(tmp_path)
    cli.selftest_records(spark).write.partitionBy("source_id").parquet(f"{work}/records")
    for _ in range(2):
        cli.main(["--work", work, "geocode", "--provider", "own_geocoder:geocoder", "--pause", "0"], spark)
    cache = load_table(spark, f"{work}/geocache")
    assert cache.count() > 0 and cache.where("tries > 3").count() == 0 and cache.select("qkey").distinct().count() == cache.count()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["geocache", "records"]


def test_a_failed_parse_leaves_the_store(spark, tmp_path):
    store = str(tmp_path / "store")
    (tmp_path / "a.csv").write_text("number,name\n1,A\n")
    (tmp_path / "b.csv").write_text("x,y\n1,A\n")
    how = {"source_id": "s1", "id_scheme": "S", "country": "AUS"}
    registers.load(spark, "generic", str(tmp_path / "a.csv"), store, **how)
    with pytest.raises(ValueError):
        registers.load(spark, "generic", str(tmp_path / "b.csv"), store, **how)
    assert load_table(spark, store).count() == 1
