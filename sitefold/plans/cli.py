"""Commands: parse, dedup, geocode, build, selftest, status. Stores are Parquet folders under --work."""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitefold.operators import assemble, geocode, resolve
from sitefold.plans import publish
from sitefold.plans.shared import clean
from sitefold.plans.store import Table
from sitefold.schema import SOURCE_RECORD
from sitefold.sources import registers
from sitefold.sources.files import load_table


def _need(spark: SparkSession, path: str) -> DataFrame:
    found = load_table(spark, path)
    if found is None:
        raise SystemExit(f"nothing at {path} yet")
    return found


def dedup(spark: SparkSession, records: DataFrame, cache: DataFrame | None = None, decisions: DataFrame | None = None):
    """(keyed, facilities, queue), positions from the cache included."""
    hits = geocode.hits(geocode.query_index(resolve.with_keys(records)), cache) if cache is not None else None
    found = resolve.resolved(records, hits, decisions)
    return found.keyed, assemble.assemble(found.keyed, found.tiers, found.pairs), found.queue


#: Invented rows, one case of a rule in each group, as fields that are stated.
SELFTEST = {
    # One number, handed on over three schemes: four records, one facility.
    "identifier": [
        {"source_id": "ca_cfia", "source_row_id": "381", "name": "Lac Vert Abattoir Inc", "country_iso3": "CAN", "national_id": "381", "id_scheme": "CA-SFC"},
        {"source_id": "eu_traces_third_country", "source_row_id": "q1", "name": "Lac Vert", "country_iso3": "CAN", "national_id": "7-12", "id_scheme": "EU-THIRDCOUNTRY", "foreign_id": "Est. 381", "foreign_id_scheme": "CA-SFC"},
        {"source_id": "cifer_china", "source_row_id": "q2", "name": "Green Lake", "country_iso3": "CAN", "national_id": "C55", "id_scheme": "CN-CIFER", "foreign_id": "712", "foreign_id_scheme": "EU-THIRDCOUNTRY"},
        {"source_id": "own_notes", "source_row_id": "a", "name": "?", "country_iso3": "CAN", "foreign_id": "c55", "foreign_id_scheme": "CN-CIFER"},
    ],
    # One postcode and number, alike names: merged. The next house is another facility.
    "address": [
        {"source_id": "own_notes", "source_row_id": "b1", "name": "Toma Duck Farm", "country_iso3": "HUN", "address": "Fő utca 41", "postcode": "5600", "slaughter": False},
        {"source_id": "osm_overpass", "source_row_id": "b2", "name": "Toma Duck Farm Kft", "country_iso3": "HUN", "address": "41 Fo u.", "postcode": "5600"},
        {"source_id": "own_notes", "source_row_id": "b3", "name": "Toma Duck Farm", "country_iso3": "HUN", "address": "Fő utca 43", "postcode": "5600"},
    ],
    # On one meridian: 240 m from the first, a merge; 260 m from it on the other side, a pair to review with either.
    "distance": [
        {"source_id": "own_notes", "source_row_id": "c1", "name": "Curtiembre Yi", "country_iso3": "URY", "src_lat": -33.40, "src_lon": -56.50, "slaughter": True},
        {"source_id": "osm_overpass", "source_row_id": "c2", "name": "Curtiembre Yi SA", "country_iso3": "URY", "src_lat": -33.40 + 240 / 111195, "src_lon": -56.50},
        {"source_id": "osm_overpass", "source_row_id": "c3", "name": "Curtiembre del Yi", "country_iso3": "URY", "src_lat": -33.40 - 260 / 111195, "src_lon": -56.50},
    ],
    # One number by mistake: held apart by the decision below.
    "decision": [
        {"source_id": "jp_list", "source_row_id": "d1", "name": "Kita Ham", "country_iso3": "JPN", "national_id": "9", "id_scheme": "JP"},
        {"source_id": "jp_list", "source_row_id": "d2", "name": "Minami Egg", "country_iso3": "JPN", "national_id": "No. 9", "id_scheme": "JP"},
    ],
}
SELFTEST_SPLIT = ("jp_list:d1", "jp_list:d2", "split")
#: What must come of them, as row ids.
SELFTEST_FACILITIES = ["381 a q1 q2", "b1 b2", "b3", "c1 c2", "c3", "d1", "d2"]
SELFTEST_REVIEW = ["c1 c3", "c2 c3"]


def selftest_records(spark: SparkSession) -> DataFrame:
    rows = [row for case in SELFTEST.values() for row in case]
    bare = spark.createDataFrame([(json.dumps({"source_snapshot": "selftest", "species": [], "activities": [], **row}), seq) for seq, row in enumerate(rows)], "line string, seq bigint")
    return bare.select(F.inline(F.array(F.from_json("line", SOURCE_RECORD))), "seq")


def selftest_decisions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([SELFTEST_SPLIT], "a_key string, b_key string, decision string")


def selftest(spark: SparkSession) -> DataFrame:
    """Resolves the invented rows; raises if the result isn't the known one."""
    _, facilities, queue = dedup(spark, selftest_records(spark), decisions=selftest_decisions(spark))
    short = lambda keys: " ".join(sorted(k.partition(":")[2] for k in keys))
    got = sorted(short(m["key"] for m in r.members) for r in facilities.collect())
    pairs = sorted(short((r.a_key, r.b_key)) for r in queue.collect())
    assert got == SELFTEST_FACILITIES, got
    assert pairs == SELFTEST_REVIEW, pairs
    return facilities


def status(spark: SparkSession, work: str) -> dict:
    """Row counts of the stores that exist."""
    out = {}
    for name in ("records", "facilities", "review", "geocache"):
        found = load_table(spark, f"{work}/{name}")
        out[name] = None if found is None else found.count()
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="sitefold")
    p.add_argument("--work", default="work")
    verbs = p.add_subparsers(dest="verb", required=True)
    a = verbs.add_parser("parse")
    a.add_argument("--source", required=True)
    a.add_argument("--input", required=True)
    a.add_argument("--option", action="append", default=[], help="name=value, for the source's reader")
    verbs.add_parser("parse-all").add_argument("--inputs", required=True, help="JSON: source to path")
    a = verbs.add_parser("dedup")
    a.add_argument("--decisions", help="reviewed CSV")
    a = verbs.add_parser("build")
    a.add_argument("--out", required=True)
    a.add_argument("--inline", action="store_true")
    a.add_argument("--keep-excluded", action="store_true")
    a = verbs.add_parser("geocode")
    a.add_argument("--limit", type=int)
    a.add_argument("--provider", help="module:function that answers for the parts of an address; none is built in")
    a.add_argument("--lanes", type=int, default=1)
    a.add_argument("--pause", type=float, default=1.1)
    a.add_argument("--minutes", type=float)
    verbs.add_parser("status")
    verbs.add_parser("selftest")
    o = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName("sitefold").getOrCreate()
    store = f"{o.work}/records"
    if o.verb == "parse":
        registers.load(spark, o.source, o.input, store, **dict(x.split("=", 1) for x in o.option))
    elif o.verb == "parse-all":
        print(registers.load_all(spark, json.loads(o.inputs), store))
    elif o.verb == "dedup":
        decisions = spark.read.option("header", True).csv(o.decisions) if o.decisions else None
        keyed, facilities, queue = dedup(spark, _need(spark, store), load_table(spark, f"{o.work}/geocache"), decisions)
        facilities.write.mode("overwrite").parquet(f"{o.work}/facilities")
        queue.write.mode("overwrite").parquet(f"{o.work}/review")
        publish.write_review(queue, f"{o.work}/review_csv")
        print(publish.write_report(assemble.report(keyed, spark.read.parquet(f"{o.work}/facilities"), queue), f"{o.work}/report.md"))
    elif o.verb == "build":
        print(publish.build(_need(spark, f"{o.work}/facilities"), o.out, keep_excluded=o.keep_excluded, inline=o.inline))
    elif o.verb == "geocode":
        index = geocode.query_index(resolve.with_keys(_need(spark, store)))
        table = Table(spark, f"{o.work}/geocache")
        if o.provider:
            module, _, name = o.provider.partition(":")
            cache = geocode.ask(table, index, getattr(importlib.import_module(module), name), o.lanes, o.pause, seconds=o.minutes and 60 * o.minutes, limit=o.limit)
            geocode.breakdown(index, cache).show(20, False)
        else:
            geocode.outstanding(index, geocode.settle(table), o.limit).show(20, False)
    elif o.verb == "status":
        print(status(spark, o.work))
    else:
        selftest(spark).show()
    clean(spark)  # all results are in the stores


if __name__ == "__main__":
    main()
