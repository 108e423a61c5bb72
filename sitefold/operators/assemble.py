"""One facility for each component, with every member kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sitefold.operators.resolve import position
from sitefold.vocabulary import PRECISION_RANK


def uid(keys: Column) -> Column:
    """'f' and 16 hex digits of the SHA-1 of the sorted keys joined by a bar."""
    return F.concat(F.lit("f"), F.substring(F.sha1(F.concat_ws("|", F.array_sort(keys))), 1, 16))


def _stated(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)), F.lit("")) != ""


def best_name(names: Column) -> Column:
    """The longest; of equals the first by code point; '(unnamed)' without any."""
    ranked = F.array_sort(F.transform(names, lambda x: F.struct((-F.length(x)).alias("l"), x.alias("x"))))
    return F.coalesce(F.get(ranked, F.lit(0))["x"], F.lit("(unnamed)"))


def assemble(keyed: DataFrame, tiers: DataFrame, queue: DataFrame, publish: bool = False) -> DataFrame:
    """keyed, tiers and queue as from resolve(). One aggregation over components; flags are joined on."""
    p = position()
    rank = F.coalesce(*[F.when(F.col("p.precision") == k, F.lit(v)) for k, v in PRECISION_RANK.items()])
    order = F.struct("seq", "key")
    some = F.when(_stated("address") & _stated("postcode"), 0).when(_stated("address"), 1).otherwise(2)
    member = ["key", F.col("source_id").alias("source"), F.col("source_snapshot").alias("snapshot"), "name", "national_id", "id_scheme", "foreign_id", "address", "locality", "postcode", "species", "activities", "slaughter"]
    if publish:
        member.append(F.col("raw").alias("published"))
    rows = keyed.withColumn("p", p).withColumn("_rank", rank)
    rows = rows.withColumn("_m", F.struct(F.col("source_id").alias("o"), F.col("seq").alias("s"), F.col("key").alias("k"), F.struct(*member).alias("m")))
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(c, F.array().cast("array<string>"))))))
    first = lambda c: F.min_by(F.when(_stated(c), F.col(c)), F.when(_stated(c), order))
    found = rows.groupBy("component").agg(
        uid(F.collect_list("key")).alias("uid"),
        F.array_sort(F.collect_set(F.when(_stated("name"), F.col("name")))).alias("name_variants"),
        F.min_by(F.when(F.coalesce("country_iso3", F.lit("")) != "", F.col("country_iso3")), F.when(F.coalesce("country_iso3", F.lit("")) != "", order)).alias("country_iso3"),
        F.min_by(F.struct("address", "locality", "admin1"), F.struct(some.alias("r"), "seq", "key")).alias("_a"),
        F.min_by(F.when(F.col("_rank").isNotNull(), F.col("p")), F.when(F.col("_rank").isNotNull(), F.struct("_rank", "seq", "key"))).alias("_p"),
        union("species").alias("species"), union("activities").alias("activities"), F.bool_or("slaughter").alias("slaughter"),
        first("size_class").alias("size_class"), first("operator").alias("operator"),
        F.transform(F.array_sort(F.collect_list("_m")), lambda x: x["m"]).alias("members"),
    )
    found = found.join(tiers.groupBy("component").agg(F.array_sort(F.collect_set("tier")).alias("_t")), "component", "left")
    ends = queue.select(F.explode(F.array("a_key", "b_key")).alias("key")).distinct()
    flagged = keyed.select("key", "component").join(ends, "key", "left_semi").select("component").distinct().withColumn("_r", F.lit(True))
    found = found.join(flagged, "component", "left")
    return found.select(
        "uid", best_name(F.col("name_variants")).alias("name"), "name_variants", "country_iso3", F.col("_a.address").alias("address"), F.col("_a.locality").alias("locality"),
        F.col("_a.admin1").alias("admin1"), F.col("_p.lat").alias("lat"), F.col("_p.lon").alias("lon"), F.coalesce("_p.precision", F.lit("none")).alias("geo_precision"),
        F.col("_p.provider").alias("geo_source"), "species", "activities", "slaughter", "size_class", "operator", "members",
        F.coalesce("_t", F.array().cast("array<string>")).alias("match_tiers"), F.coalesce("_r", F.lit(False)).alias("review"),
    )


def mappable() -> Column:
    from sitefold.vocabulary import MAPPABLE

    return F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("geo_precision").isin(*MAPPABLE)


def report(keyed: DataFrame, facilities: DataFrame, queue: DataFrame) -> DataFrame:
    """(section, item, n): rows by source, clusters by tier and by size, totals. n is true: no row is lost."""
    count = lambda df, s, c: df.groupBy(F.col(c).cast("string").alias("item")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(s).alias("section"), "item", "n")
    total = lambda df, item: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total").alias("section"), F.lit(item).alias("item"), "n")
    sized = facilities.withColumn("size", F.size("members"))
    parts = [total(keyed, "rows"), total(facilities, "facilities"), total(queue, "review pairs"), total(facilities.where(mappable()), "mappable"), total(facilities.where("lat IS NULL"), "unlocated"), count(keyed, "source", "source_id"), count(facilities.select(F.explode("match_tiers").alias("tier")), "tier", "tier"), count(sized, "size", "size")]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out
