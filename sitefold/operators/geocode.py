"""Positions from addresses: a cache in versions, joins for what is known and what is outstanding, and paced lookups that are saved as they go."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sitefold.functions.address import query_key
from sitefold.functions.countries import with_iso2
from sitefold.plans.shared import materialise
from sitefold.plans.store import Table
from sitefold.schema import GEO_CACHE
from sitefold.vocabulary import MAPPABLE

MOST_TRIES = 3
VERSION = "v2"


def query_index(records: DataFrame) -> DataFrame:
    """(qkey, key, and the parts to ask for) of records without a position of their own and with some address."""
    rows = records.where("src_lat IS NULL OR src_lon IS NULL")
    if "iso2" not in rows.columns:
        rows = with_iso2(rows)
    k = query_key(F.col("iso2"), F.col("country_iso3"), F.col("address"), F.col("locality"), F.col("admin1"), F.col("postcode"))
    return rows.withColumn("qkey", k).where("qkey <> ''").select("qkey", "key", "seq", "iso2", F.col("address").alias("street"), F.col("locality").alias("city"), "postcode")


def hits(index: DataFrame, cache: DataFrame) -> DataFrame:
    """(key, lat, lon, precision, provider): the cache's answers for every record of an address."""
    return index.select("qkey", "key").join(cache.where("lat IS NOT NULL"), "qkey").select("key", "lat", "lon", "precision", "provider")


def outstanding(index: DataFrame, cache: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct addresses without an answer: never asked, or empty with fewer than three tries. First by input order."""
    asked = index.groupBy("qkey").agg(F.min(F.struct("seq", "iso2", "street", "city", "postcode")).alias("x")).select("qkey", "x.*")
    answered = cache.where((F.col("lat").isNotNull()) | (F.col("tries") >= MOST_TRIES)).select("qkey")
    todo = asked.join(answered, "qkey", "left_anti")
    return todo.orderBy("seq", "qkey").limit(limit) if limit else todo


def breakdown(index: DataFrame, cache: DataFrame) -> DataFrame:
    """(outcome, n) over distinct addresses."""
    known = index.select("qkey").distinct().join(cache, "qkey", "left")
    outcome = F.when(F.col("tries").isNull(), "never asked").when(F.col("lat").isNotNull(), F.col("precision")).when(F.col("tries") >= MOST_TRIES, "given up").otherwise("to retry")
    return known.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def pending(index: DataFrame, cache: DataFrame) -> DataFrame:
    return outstanding(index, cache).agg(F.count(F.lit(1)).alias("n"))


def drop_stale(cache: DataFrame) -> DataFrame:
    return cache.where(F.col("qkey").startswith(VERSION + "|"))


def purge_misses(cache: DataFrame) -> DataFrame:
    """Without empty answers, so that they are asked again."""
    return cache.where("lat IS NOT NULL")


def probe(index: DataFrame, n: int = 10) -> DataFrame:
    """A sample of addresses that reruns agree on."""
    return index.select("qkey").distinct().orderBy(F.xxhash64("qkey"), "qkey").limit(n)


def ladder(parts: dict) -> list[dict]:
    """What is asked for one address, from the most to the least precise, each kind once: all parts, then without the
    street, then the city alone (or the postcode where there is no city)."""
    street, city, postcode = (parts.get(k) or None for k in ("street", "city", "postcode"))
    tries = [(street, city, postcode), (None, city, postcode), (None, city, None if city else postcode)]
    out = []
    for s, c, p in tries:
        step = {**parts, "street": s, "city": c, "postcode": p}
        if (s or c or p) and step not in out:
            out.append(step)
    return out


def acceptable(parts: dict, answer: dict | None) -> bool:
    """An answer with a position that isn't in another country than the one asked for."""
    if not answer or answer.get("lat") is None or answer.get("lon") is None:
        return False
    asked, got = (parts.get("iso2") or "").upper(), (answer.get("country") or "").upper()
    return not asked or not got or asked == got


def lookup(todo: DataFrame, provider: Callable[[dict], dict | None], lanes: int = 1, pause: float = 0.0, fallback: Callable[[dict], dict | None] | None = None, seconds: float | None = None) -> DataFrame:
    """(qkey, lat, lon, precision, provider, error): provider(parts) gives lat, lon, precision, provider and, if it
    knows it, the two-letter country; None for no answer, or raises. Each address goes down the ladder until an
    answer is acceptable. Empty and coarse answers are asked of the fallback. Each lane is one paced task; with
    `seconds`, a lane leaves what is left after that time unasked, and gives no row for it."""
    columns = ["qkey", "lat", "lon", "precision", "provider", "error"]

    def answer(parts: dict) -> list:
        best, error = None, None
        for who in (provider, fallback):
            if who is None or best and best.get("precision") in MAPPABLE:
                continue
            try:
                got = next((x for x in map(who, ladder(parts)) if acceptable(parts, x)), None)
            except Exception as e:  # transport errors aren't answers and aren't cached
                error = str(e)
                continue
            if got and (best is None or got.get("precision") in MAPPABLE):
                best = got
            error = None
        best = best or {}
        return [parts["qkey"], best.get("lat"), best.get("lon"), best.get("precision", "none"), best.get("provider"), error]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ends = None if seconds is None else time.monotonic() + seconds
        for b in batches:
            out = []
            for parts in b.to_dict("records"):
                if ends is not None and time.monotonic() >= ends:
                    break
                out.append(answer(parts))
                time.sleep(pause)
            yield pd.DataFrame(out, columns=columns)

    dealt = todo.coalesce(1) if lanes == 1 else todo.repartition(lanes)
    return dealt.mapInPandas(run, "qkey string, lat double, lon double, precision string, provider string, error string")


def updated(cache: DataFrame, answers: DataFrame) -> DataFrame:
    """The cache with new answers in place of old; failures leave it as it was."""
    new = answers.where("error IS NULL").join(cache.select("qkey", F.col("tries").alias("_t")), "qkey", "left")
    new = new.select("qkey", "lat", "lon", "precision", "provider", (F.coalesce("_t", F.lit(0)) + 1).cast("int").alias("tries"))
    return cache.join(new, "qkey", "left_anti").select(new.columns).unionByName(new)


def empty_cache(spark) -> DataFrame:
    return spark.createDataFrame([], GEO_CACHE)


#: Answers that a lane may lose when it stops.
EACH = 250


def settle(table: Table) -> DataFrame:
    """The cache, with what has been answered since its version in a version of its own."""
    version, _ = table.manifest()
    cache = table.read()
    cache = empty_cache(table.spark) if cache is None else cache
    answers = table.read_log(version)
    if answers is None:
        return cache
    table.commit(table.write(updated(cache, answers)), version, others=False)  # the log belongs to the version before, so it counts once
    return table.read()


def ask(table: Table, index: DataFrame, provider: Callable[[dict], dict | None], lanes: int = 1, pause: float = 0.0, fallback: Callable[[dict], dict | None] | None = None, seconds: float | None = None, limit: int | None = None, each: int = EACH) -> DataFrame:
    """Asks for what is outstanding and returns the new cache.

    In rounds of `each` addresses a lane, whose answers are added to the log of the cache's version when a round ends; so
    a lost task or a stopped run loses one round at most, and the next run starts from what the log has. `pause` is the
    time between two requests of all lanes together.
    """
    ends = None if seconds is None else time.monotonic() + seconds
    cache = settle(table)
    log = table.log(table.manifest()[0])
    todo = materialise(outstanding(index, cache, limit), "outstanding")
    while True:
        left = todo if (done := table.read_log(table.manifest()[0])) is None else todo.join(done.select("qkey").distinct(), "qkey", "left_anti")
        part = materialise(left.orderBy("seq", "qkey").limit(each * lanes), "round")
        if part.isEmpty() or ends is not None and time.monotonic() >= ends:
            break
        lookup(part, provider, lanes, pause * lanes, fallback, None if ends is None else ends - time.monotonic()).write.mode("append").parquet(log)
    return settle(table)
