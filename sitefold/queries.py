"""One query for each operator, on the driver's tables, with the SQL that gives the same rows.

The tables aren't registers, so columns are shaped into register-like ones, the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitefold.functions import geo, text
from sitefold.operators import assemble, geocode, outlines, resolve, upkeep
from sitefold.operators.components import components
from sitefold.plans import publish, tiles
from sitefold.plans.shared import materialise, new_dir
from sitefold.plans.store import Table
from sitefold.schema import FIELDS, TYPES
from sitefold.vocabulary import EXCLUDED_ACTIVITIES, LEGAL_SUFFIXES, STOPWORDS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _quoted(xs) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in xs)


# DuckDB's forms of the normalisers. Its strip_accents keeps compatibility characters, which these tables don't hold.
NT = r"trim(regexp_replace(regexp_replace(lower(strip_accents(coalesce({0}, ''))), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
NN = "array_to_string(list_filter(string_split(" + NT + ", ' '), lambda x: x <> '' AND x NOT IN (" + _quoted(LEGAL_SUFFIXES) + ")), ' ')"
TOKENS = "list_distinct(list_filter(string_split(" + NN + ", ' '), lambda x: length(x) > 1 AND x NOT IN (" + _quoted(STOPWORDS) + ")))"
JACCARD = "CASE WHEN len({0}) > 0 AND len({1}) > 0 THEN len(list_intersect({0}, {1})) / len(list_distinct(list_concat({0}, {1}))) ELSE 0.0 END"
HAVERSINE = "2 * 6371000 * asin(sqrt(least(pow(sin(radians({2} - {0}) / 2), 2) + cos(radians({0})) * cos(radians({2})) * pow(sin(radians({3} - {1}) / 2), 2), 1.0)))"
PC = r"regexp_replace(upper(strip_accents(coalesce({0}, ''))), '[^A-Z0-9]', '', 'g')"
HN = r"regexp_extract(coalesce({0}, ''), '\b([0-9]{{1,6}})\s*[a-zA-Z]?\b', 1)"
PC1 = PC.replace("{0}", "{1}")
AK = "CASE WHEN " + PC1 + " = '' THEN '' ELSE " + PC1 + " || '#' || " + HN + " END"
ID = (
    r"nullif(trim(regexp_replace(regexp_replace(regexp_replace(upper(strip_accents(coalesce({0}, ''))), "
    r"'\b(EST|ESTAB|ESTABLISHMENT|NO|N|NUM|NUMERO|APPROVAL)\b\.?', ' ', 'g'), '\s*/\s*', '/', 'g'), '[^A-Z0-9/]', '', 'g'), '/'), '')"
)

# Customers as sites: some share a place, a postcode and a number.
SITES = """sites AS (SELECT c_custkey k, 'Mill ' || c_mktsegment || ' ' || (100 + c_custkey // 2 % 10)::VARCHAR || CASE WHEN c_custkey % 3 = 0 THEN ' Ltd' ELSE '' END AS name, c_nationkey nation,
  (c_custkey // 7 % 160 - 80)::DOUBLE + (c_custkey % 7) * 0.0004 lat, (c_custkey // 3 % 340 - 170)::DOUBLE + (c_custkey % 3) * 0.0003 lon,
  CASE WHEN c_custkey % 4 > 0 THEN 'P-' || (c_custkey // 5)::VARCHAR END postcode, (c_custkey // 5 % 90)::VARCHAR || ' Mill Lane' address FROM customer)"""


def sites(spark, d, customers: DataFrame | None = None):
    k = F.col("c_custkey")
    return (table(spark, d, "customer") if customers is None else customers).select(
        k.alias("k"), F.concat(F.lit("Mill "), "c_mktsegment", F.lit(" "), (100 + F.floor(k / 2) % 10).cast("string"), F.when(k % 3 == 0, " Ltd").otherwise("")).alias("name"), F.col("c_nationkey").alias("nation"),
        (F.floor(k / 7) % 160 - 80).cast("double").__add__((k % 7) * 0.0004).alias("lat"), (F.floor(k / 3) % 340 - 170).cast("double").__add__((k % 3) * 0.0003).alias("lon"),
        F.when(k % 4 > 0, F.concat(F.lit("P-"), F.floor(k / 5).cast("string"))).alias("postcode"), F.concat((F.floor(k / 5) % 90).cast("string"), F.lit(" Mill Lane")).alias("address"),
    )


@query("c1_c2_norm_text", f"SELECT doc_id, {NT.format('text')} AS norm FROM documents")
def c2(spark, d):
    return table(spark, d, "documents").select("doc_id", text.norm_text(F.col("text")).alias("norm"))


@query("c3_norm_name", f"SELECT c_custkey, {NN.format('n')} AS norm, array_to_string(list_sort({TOKENS.format('n')}), ' ') AS tokens FROM (SELECT c_custkey, 'The ' || c_name || ' Packing Co. S.A. GmbH' n FROM customer)")
def c3(spark, d):
    n = F.concat(F.lit("The "), "c_name", F.lit(" Packing Co. S.A. GmbH"))
    return table(spark, d, "customer").select("c_custkey", text.norm_name(n).alias("norm"), F.array_join(F.array_sort(text.name_tokens(n)), " ").alias("tokens"))


#: Parts of one word set that meet another block's in one row.
PAIR_BLOCK = 2048


@query("c5_jaccard_all_pairs", f"WITH t AS (SELECT p_partkey, p_brand, {TOKENS.format('p_name')} w FROM part) SELECT a.p_partkey a, b.p_partkey b, round({JACCARD.format('a.w', 'b.w')}, 6) score FROM t a JOIN t b ON a.p_brand = b.p_brand AND a.p_partkey < b.p_partkey WHERE {JACCARD.format('a.w', 'b.w')} >= 0.4")
def c5_all(spark, d):
    """All pairs of a brand: each two word sets that share a word are compared once; the parts of each lie in blocks of about
    PAIR_BLOCK, and each two blocks are a row of their own until their pairs are dealt out."""
    named = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("brand"), F.array_sort(text.name_tokens(F.col("p_name"))).alias("w"))
    t = materialise(named.where("brand IS NOT NULL AND size(w) > 0"), "jaccard-parts")
    counted = t.groupBy("brand", "w").agg(F.count(F.lit(1)).alias("n"))
    classes = materialise(counted.withColumn("c", F.monotonically_increasing_id()), "jaccard-classes")
    sets = classes.select("brand", "c", "w", F.explode("w").alias("token"))
    both = sets.toDF("brand", "ac", "aw", "token").join(sets.toDF("brand", "bc", "bw", "token"), ["brand", "token"]).where("ac <= bc AND token = array_intersect(aw, bw)[0]")
    alike = both.withColumn("s", text.token_set_ratio(F.col("aw"), F.col("bw"))).where("s >= 0.4").select("ac", "bc", F.round("s", 6).alias("score"))
    block = F.pmod(F.xxhash64("k"), F.ceil(F.col("n") / PAIR_BLOCK))
    blocks = materialise(t.join(classes, ["brand", "w"]).groupBy("c", block.alias("block")).agg(F.array_sort(F.collect_list("k")).alias("ks")), "jaccard-blocks")
    met = alike.join(blocks.toDF("ac", "ablock", "xs"), "ac").join(blocks.toDF("bc", "bblock", "ys"), "bc").where("ac < bc OR ablock <= bblock")
    met = met.withColumn("twice", F.expr("ac = bc AND ablock = bblock")).select("ac", "ablock", "bc", "bblock", "twice", "score", "xs", "ys")
    met = met.repartition(4 * spark.sparkContext.defaultParallelism, "ac", "ablock", "bc", "bblock").select("twice", "score", "ys", F.posexplode("xs").alias("at", "x"))
    met = met.select("twice", "score", "x", F.explode(F.when(F.col("twice"), F.slice("ys", F.col("at") + 2, F.size("ys"))).otherwise(F.col("ys"))).alias("y"))
    return met.where("x < y OR x > y AND NOT twice").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "score")


@query("c6_norm_id", f"SELECT s_suppkey, 'X:' || {ID.format('v')} AS id FROM (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'Est. No ' || s_name WHEN 1 THEN s_suppkey::VARCHAR || ' / 31' WHEN 2 THEN 'M-' || s_suppkey::VARCHAR ELSE '#/ ' END v FROM supplier)")
def c6(spark, d):
    k = F.col("s_suppkey")
    v = F.when(k % 4 == 0, F.concat(F.lit("Est. No "), "s_name")).when(k % 4 == 1, F.concat(k.cast("string"), F.lit(" / 31"))).when(k % 4 == 2, F.concat(F.lit("M-"), k.cast("string"))).otherwise("#/ ")
    return table(spark, d, "supplier").select("s_suppkey", text.norm_id(F.lit("X"), v).alias("id"))


@query("c7_c8_c9_addr_key", f"WITH {SITES} SELECT k, {PC.format('postcode')} pc, {HN.format('address')} house, {AK.format('address', 'postcode')} ak FROM sites")
def c9(spark, d):
    return sites(spark, d).select("k", text.norm_postcode(F.col("postcode")).alias("pc"), text.house_number(F.col("address")).alias("house"), text.addr_key(F.col("address"), F.col("postcode")).alias("ak"))


@query("c11_haversine_pairs", f"WITH {SITES} SELECT a.k a, b.k b, round({HAVERSINE.format('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 2) m FROM sites a JOIN sites b ON b.k = a.k + 1")
def c11(spark, d):
    s = sites(spark, d).select("k", "lat", "lon")
    a, b = s.toDF("a", "alat", "alon"), s.toDF("b", "blat", "blon")
    return a.join(b, F.col("b") == F.col("a") + 1).select("a", "b", F.round(geo.haversine_m(F.col("alat"), F.col("alon"), F.col("blat"), F.col("blon")), 2).alias("m"))


@query("f9_truthy", "SELECT o_orderkey, CASE v WHEN '' THEN NULL WHEN 'n' THEN false WHEN 'no' THEN false WHEN '0' THEN false WHEN 'f' THEN false WHEN 'false' THEN false ELSE true END AS flag FROM (SELECT o_orderkey, lower(trim(CASE o_orderkey % 5 WHEN 0 THEN ' N ' WHEN 1 THEN 'Yes' WHEN 2 THEN '' WHEN 3 THEN '0' ELSE o_orderstatus END)) v FROM orders)")
def f9(spark, d):
    k = F.col("o_orderkey")
    v = F.when(k % 5 == 0, " N ").when(k % 5 == 1, "Yes").when(k % 5 == 2, "").when(k % 5 == 3, "0").otherwise(F.col("o_orderstatus"))
    return table(spark, d, "orders").select("o_orderkey", text.truthy(v).alias("flag"))


@query("c29_bracket_split", r"SELECT p_partkey, len(list_filter(string_split(p_type, ' '), lambda x: x <> ''))::INT n, p_type || ' (a, b)' AS head FROM part")
def c29(spark, d):
    cell = F.concat(F.col("p_type"), F.lit(" (a, b) , "), F.array_join(F.split("p_type", " "), ","))
    return table(spark, d, "part").select("p_partkey", (F.size(text.bracket_split(cell)) - 1).alias("n"), F.get(text.bracket_split(cell), F.lit(0)).alias("head"))


@query("c32_dot_key", "WITH x AS (SELECT c_custkey, list_filter(['bovine', 'porcine', 'poultry', 'ovine'], lambda s: (s = 'bovine' AND c_custkey % 2 = 0) OR (s = 'porcine' AND c_custkey % 3 = 0) OR (s = 'poultry' AND c_custkey % 5 = 0) OR (s = 'ovine' AND c_custkey % 7 = 0)) l FROM customer) SELECT c_custkey, CASE WHEN len(l) = 0 THEN '_unstated' WHEN len(l) > 2 THEN '_mixed' ELSE l[1] END dot FROM x")
def c32(spark, d):
    k = F.col("c_custkey")
    some = F.array_compact(F.array(F.when(k % 7 == 0, "ovine"), F.when(k % 2 == 0, "bovine"), F.when(k % 5 == 0, "poultry"), F.when(k % 3 == 0, "porcine")))
    return table(spark, d, "customer").select("c_custkey", publish.dot_key(some).alias("dot"))


@query("c33_mercator", f"WITH {SITES} SELECT k, round((lon + 180) / 360, 9) x, round(0.5 - ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) / (4 * pi()), 9) y FROM sites")
def c33(spark, d):
    x, y = geo.mercator(F.col("lat"), F.col("lon"))
    return sites(spark, d).select("k", F.round(x, 9).alias("x"), F.round(y, 9).alias("y"))


RECORDS = f"""{SITES}, rec AS (SELECT *, 'N' || (k // 60 % 3) country, CASE WHEN k % 6 = 0 THEN (k // 12)::VARCHAR END id FROM sites)"""


def records(spark, d):
    """Sites in the columns that the stages join on."""
    s = sites(spark, d).withColumn("country", F.concat(F.lit("N"), (F.floor(F.col("k") / 60) % 3).cast("string")))  # neighbours share a country
    nn = text.norm_name(F.col("name"))
    return s.select(
        F.col("k").cast("string").alias("key"), F.col("k").alias("seq"), F.lit("x").alias("source_id"), "country", "name", "address", text.norm_text(F.col("name")).alias("text"), nn.alias("nn"),
        text.folded_tokens(nn).alias("words"), text.addr_key(F.col("address"), F.col("postcode")).alias("ak"), F.when(F.col("k") % 9 > 0, F.col("lat")).alias("lat"),
        F.when(F.col("k") % 9 > 0, F.col("lon")).alias("lon"), F.array_compact(F.array(F.when(F.col("k") % 6 == 0, F.floor(F.col("k") / 12).cast("string")))).alias("ids"),
    )


@query("j2_id_edges", f"WITH {RECORDS}, f AS (SELECT id, country, min(k) k0, count(*) n FROM rec WHERE id IS NOT NULL GROUP BY ALL HAVING count(*) > 1) SELECT k0::VARCHAR src, k::VARCHAR dst FROM rec JOIN f USING (id, country)")
def j2(spark, d):
    return resolve.id_edges(records(spark, d))


@query("j3_addr_tier", f"WITH {RECORDS}, r AS (SELECT *, {AK.format('address', 'postcode')} ak, {TOKENS.format('name')} w FROM rec) SELECT a.k::VARCHAR a_key, b.k::VARCHAR b_key, round({JACCARD.format('a.w', 'b.w')}, 6) score, {JACCARD.format('a.w', 'b.w')} >= 0.6 merges FROM r a JOIN r b ON a.country = b.country AND a.ak = b.ak AND a.k < b.k AND a.ak <> '' AND a.ak NOT LIKE '%#' WHERE {JACCARD.format('a.w', 'b.w')} >= 0.4")
def j3(spark, d):
    return resolve.addr_pairs(records(spark, d)).select("a_key", "b_key", F.round("score", 6).alias("score"), "merges")


#: Sites a street apart rather than next door, so that some pairs are beyond the distance of merges.
SPREAD = 0.0016


@query("j4_grid_join", f"WITH {RECORDS}, r AS (SELECT k, country, lat + (k % 7) * ({SPREAD} - 0.0004) lat, lon FROM rec WHERE k % 9 > 0), p AS (SELECT a.k a, b.k b, {HAVERSINE.format('a.lat', 'a.lon', 'b.lat', 'b.lon')} m FROM r a JOIN r b ON a.country = b.country AND abs(a.lat - b.lat) < 0.02 AND a.k::VARCHAR < b.k::VARCHAR) SELECT a::VARCHAR a_key, b::VARCHAR b_key, round(m, 2) m FROM p WHERE m <= 1500")
def j4(spark, d):
    rows = records(spark, d).withColumn("lat", F.col("lat") + (F.col("seq") % 7) * (SPREAD - 0.0004))
    return resolve.grid_pairs(rows).select("a_key", "b_key", F.round("metres", 2).alias("m"))


@query("j5_name_review_all", f"WITH r AS (SELECT c_custkey k, {NN.format('mkt')} nn FROM (SELECT c_custkey, c_mktsegment || ' ' || (c_custkey // 30)::VARCHAR || ' Ltd' mkt FROM customer)), t AS (SELECT *, k // 20 % 3 country FROM r), g AS (SELECT nn, country FROM t GROUP BY ALL HAVING count(*) BETWEEN 2 AND 12) SELECT a.k::VARCHAR a_key, b.k::VARCHAR b_key FROM t a JOIN t b ON a.nn = b.nn AND a.country = b.country AND a.k < b.k JOIN g ON g.nn = a.nn AND g.country = a.country")
def j5_all(spark, d):
    """No customer has a postcode or a position, and the names' number grows with the table."""
    r = records(spark, d).withColumns({"country": (F.floor(F.col("seq") / 20) % 3).cast("string"), "ak": F.lit(""), "lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")})
    r = r.join(table(spark, d, "customer").select(F.col("c_custkey").alias("seq"), "c_mktsegment"), "seq")
    return resolve.name_pairs(r.withColumn("nn", text.norm_name(F.concat_ws(" ", "c_mktsegment", F.floor(F.col("seq") / 30).cast("string"), F.lit("Ltd"))))).select("a_key", "b_key")


@query("j6_components_all", "WITH RECURSIVE e AS (SELECT c_custkey a, c_custkey - c_custkey % 10 b FROM customer UNION SELECT c_custkey, c_custkey + 100 FROM customer WHERE c_custkey % 200 = 0), h AS (SELECT a, b FROM e UNION SELECT b, a FROM e), t(n, c) AS (SELECT a, a FROM h UNION SELECT h.b, t.c FROM t JOIN h ON h.a = t.n) SELECT n node, min(c) component FROM t GROUP BY 1")
def j6_all(spark, d):
    """Every customer has an edge."""
    k = table(spark, d, "customer").select("c_custkey")
    return components(k.selectExpr("c_custkey src", "c_custkey - c_custkey % 10 dst").unionAll(k.where("c_custkey % 200 = 0").selectExpr("c_custkey", "c_custkey + 100")))


CACHE = "cache AS (SELECT o_orderpriority || '|' || (o_orderkey % 37)::VARCHAR qkey, CASE WHEN o_orderkey % 37 % 3 > 0 THEN o_orderkey % 37 + 0.5 END lat, CASE WHEN o_orderkey % 37 % 3 = 1 THEN 'rooftop' WHEN o_orderkey % 37 % 3 = 2 THEN 'locality' ELSE 'none' END AS precision, (o_orderkey % 37 % 5)::INT tries FROM orders WHERE o_orderkey % 37 < 30 GROUP BY ALL), idx AS (SELECT o_orderpriority || '|' || (o_orderkey % 37)::VARCHAR qkey, o_orderkey::VARCHAR AS key, o_orderkey seq FROM orders)"


def _cache(spark, d):
    o = table(spark, d, "orders")
    h = F.col("o_orderkey") % 37
    q = F.concat_ws("|", "o_orderpriority", h.cast("string"))
    cache = o.where(h < 30).select(q.alias("qkey"), F.when(h % 3 > 0, h + 0.5).alias("lat"), F.when(h % 3 > 0, h + 1.5).alias("lon"), F.when(h % 3 == 1, "rooftop").when(h % 3 == 2, "locality").otherwise("none").alias("precision"), F.lit("dict").alias("provider"), (h % 5).cast("int").alias("tries")).distinct()
    index = o.select(q.alias("qkey"), F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderkey").alias("seq"), F.lit("XX").alias("iso2"), F.lit("").alias("street"), F.lit("").alias("city"), F.lit("").alias("postcode"))
    return index, cache


@query("j8_cache_lookup", f"WITH {CACHE} SELECT idx.key, cache.lat::DOUBLE lat, cache.precision FROM idx JOIN cache USING (qkey) WHERE lat IS NOT NULL")
def j8(spark, d):
    return geocode.hits(*_cache(spark, d)).select("key", "lat", "precision")


@query("j9_outstanding", f"WITH {CACHE} SELECT idx.qkey, min(seq) seq FROM idx LEFT JOIN cache USING (qkey) WHERE tries IS NULL OR (lat IS NULL AND tries < 3) GROUP BY 1")
def j9(spark, d):
    return geocode.outstanding(*_cache(spark, d)).select("qkey", "seq")


@query("a17_breakdown", f"WITH {CACHE} SELECT CASE WHEN tries IS NULL THEN 'never asked' WHEN lat IS NOT NULL THEN precision WHEN tries >= 3 THEN 'given up' ELSE 'to retry' END AS outcome, count(DISTINCT qkey) n FROM idx LEFT JOIN cache USING (qkey) GROUP BY 1")
def a17(spark, d):
    return geocode.breakdown(*_cache(spark, d))


@query("j10_anti_merge_all", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, o_custkey FROM orders n WHERE o_orderstatus <> 'F' AND NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderstatus <> 'P' AND e.o_orderkey = n.o_orderkey AND e.o_custkey = n.o_custkey)")
def j10_all(spark, d):
    """Every order enters: finished ones on one side, pending ones on the other, open ones on both."""
    from sitefold.sources.pastes import merged

    o = table(spark, d, "orders")
    side = lambda x: o.where(F.col("o_orderstatus") != x).select("o_orderkey", "o_custkey")
    return merged(side("P"), side("F"), ("o_orderkey", "o_custkey"))


# Two outlines: a box with a hole, and a triangle. The nearest corner counts up to a degree away.
BOX = lambda x0, y0, x1, y1: [[x0, y0], [x1, y0], [x1, y1], [x0, y1]]
OUTLINES = [("AAA", [BOX(0, 0, 60, 40), BOX(20, 10, 30, 20)]), ("BBB", [[[-90, -50], [-30, -50], [-30, -10]]])]
HELD = "CASE WHEN {x} > 0 AND {x} < 60 AND {y} > 0 AND {y} < 40 AND NOT ({x} > 20 AND {x} < 30 AND {y} > 10 AND {y} < 20) THEN 'AAA' WHEN {x} > -90 AND {x} < -30 AND {y} < -10 AND {y} > -50 AND {y} < {x} * 2 / 3 + 10 THEN 'BBB' END"
CORNERS = ", ".join(f"('{iso}', {rank}, {x}, {y})" for rank, (iso, rings) in enumerate(OUTLINES) for ring in rings for x, y in ring)


@query("j11_country_at", f"WITH {SITES} SELECT k, {HELD.format(x='lon', y='lat')} AS iso FROM (SELECT k, lat + 0.31 lat, lon + 0.27 lon FROM sites)")
def j11(spark, d):
    return outlines.with_country(sites(spark, d), OUTLINES, F.col("lat") + 0.31, F.col("lon") + 0.27, "iso", near=0.0, open_rings=True).select("k", "iso")


#: From p (k, x, y): k and iso.
IN_OUTLINE = f"c(iso, rank, cx, cy) AS (VALUES {CORNERS}), n AS (SELECT k, first(iso ORDER BY pow(cx - x, 2) + pow(cy - y, 2), rank) iso FROM p JOIN c ON pow(cx - x, 2) + pow(cy - y, 2) < 1 GROUP BY k), found AS (SELECT p.k, coalesce({HELD.format(x='x', y='y')}, n.iso) AS iso FROM p LEFT JOIN n USING (k))"


@query("j11_country_near", f"WITH {SITES}, p AS (SELECT k, lat + 0.31 y, lon + 0.27 x FROM sites), {IN_OUTLINE} SELECT k, iso FROM found")
def j11_near(spark, d):
    return outlines.with_country(sites(spark, d), OUTLINES, F.col("lat") + 0.31, F.col("lon") + 0.27, "iso", open_rings=True).select("k", "iso")


@query("j13_shaded", "WITH c AS (SELECT c_nationkey::VARCHAR country_iso3, count(*) n FROM customer WHERE c_custkey % 3 = 0 GROUP BY 1) SELECT country_iso3, n, round(0.12 + 0.5 * sqrt(n / max(n) OVER ()), 9) alpha FROM c")
def j13(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("country_iso3"), F.when(F.col("c_custkey") % 3 > 0, 1.0).alias("lat"))
    return publish.shaded(publish.unlocated(c)).withColumn("alpha", F.round("alpha", 9))


@query("j14_lookup", "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'slaughter' WHEN 'N' THEN 'cutting' END AS act FROM lineitem")
def j14(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.lookup(F.col("l_returnflag"), {"A": "slaughter", "N": "cutting"}).alias("act"))


# Orders as records, each customer one facility: what assemble() makes of them, part by part.


def _orders(spark, d) -> DataFrame:
    """Orders in the columns of keyed records, in components by customer."""
    k = F.col("o_orderkey")
    pick = lambda *v: F.get(F.array(*[x if not isinstance(x, str) else F.lit(x) for x in v]), (k % len(v)).cast("int"))
    some = F.struct(F.lit(None).cast("double").alias("x")).getField("x")
    rows = table(spark, d, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("component"), F.concat(F.lit("o:"), k.cast("string")).alias("key"), k.alias("seq"), F.lit("o").alias("source_id"), F.lit("s").alias("source_snapshot"),
        F.when(k % 7 > 0, F.concat_ws(" ", "o_orderpriority", "o_orderstatus")).alias("name"), F.lit("FRA").alias("country_iso3"), k.cast("string").alias("national_id"), F.lit("S").alias("id_scheme"), F.lit(None).cast("string").alias("foreign_id"),
        F.when(k % 3 > 0, F.concat(F.lit("Road "), k.cast("string"))).alias("address"), F.concat(F.lit("T"), k.cast("string")).alias("locality"), F.lit(None).cast("string").alias("admin1"), F.when(k % 2 > 0, "P").alias("postcode"),
        F.split(pick("bovine", "porcine", "ovine bovine"), " ").alias("species"), F.split(pick("slaughter", "cutting"), " ").alias("activities"), F.when(k % 4 == 0, True).when(k % 4 == 1, False).alias("slaughter"),
        F.when(k % 5 == 0, F.concat(F.lit("size "), k.cast("string"))).alias("size_class"), F.when(k % 2 == 0, F.concat(F.lit("Op"), k.cast("string"))).alias("operator"), F.lit("{}").alias("raw"),
        F.when(k % 6 == 0, k.cast("double")).otherwise(some).alias("src_lat"), F.when(k % 6 == 0, F.lit(1.0)).alias("src_lon"), F.when(k % 12 == 0, "street").alias("src_precision"),
    )
    return resolve.with_hits(rows, None)


def _assembled(spark, d) -> DataFrame:
    none = spark.createDataFrame([], "a_key string, b_key string"), spark.createDataFrame([], "component string, tier string")
    return assemble.assemble(_orders(spark, d), none[1], none[0])


UID = "'f' || substr(sha1(string_agg('o:' || o_orderkey, '|' ORDER BY 'o:' || o_orderkey)), 1, 16) AS uid"
NAMED = "CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority || ' ' || o_orderstatus END"


@query("a1_a2_names", f"SELECT {UID}, coalesce(list_sort(list(DISTINCT struct_pack(l := -length({NAMED}), w := {NAMED})) FILTER (WHERE o_orderkey % 7 > 0))[1].w, '(unnamed)') AS name, (count(DISTINCT {NAMED}))::INT variants FROM orders GROUP BY o_custkey")
def a1(spark, d):
    return _assembled(spark, d).select("uid", "name", F.size("name_variants").alias("variants"))


@query("a3_representative", f"SELECT {UID}, arg_min(CASE WHEN o_orderkey % 3 > 0 THEN 'Road ' || o_orderkey ELSE '-' END || '/T' || o_orderkey, struct_pack(r := CASE WHEN o_orderkey % 3 > 0 THEN CASE WHEN o_orderkey % 2 > 0 THEN 0 ELSE 1 END ELSE 2 END, k := o_orderkey)) AS pick FROM orders GROUP BY o_custkey")
def a3(spark, d):
    """The address and locality of one record: the first with address and postcode, else the first with an address, else the first."""
    return _assembled(spark, d).select("uid", F.concat_ws("/", F.coalesce("address", F.lit("-")), "locality").alias("pick"))


@query("a4_best_coordinate", f"SELECT {UID}, arg_min(o_orderkey::DOUBLE, struct_pack(r := CASE WHEN o_orderkey % 12 = 0 THEN 1 ELSE 0 END, k := o_orderkey)) FILTER (WHERE o_orderkey % 6 = 0) AS lat, coalesce(arg_min(CASE WHEN o_orderkey % 12 = 0 THEN 'street' ELSE 'rooftop' END, struct_pack(r := CASE WHEN o_orderkey % 12 = 0 THEN 1 ELSE 0 END, k := o_orderkey)) FILTER (WHERE o_orderkey % 6 = 0), 'none') AS precision FROM orders GROUP BY o_custkey")
def a4(spark, d):
    return _assembled(spark, d).select("uid", "lat", F.col("geo_precision").alias("precision"))


@query("a5_tristate", f"SELECT {UID}, bool_or(CASE WHEN o_orderkey % 4 = 0 THEN true WHEN o_orderkey % 4 = 1 THEN false END) AS slaughter FROM orders GROUP BY o_custkey")
def a5(spark, d):
    return _assembled(spark, d).select("uid", "slaughter")


@query("a6_a7_union_first", f"SELECT {UID}, array_to_string(list_sort(list_distinct(flatten(list(CASE o_orderkey % 3 WHEN 0 THEN ['bovine'] WHEN 1 THEN ['porcine'] ELSE ['ovine', 'bovine'] END)))), ',') AS species, array_to_string(list_sort(list(DISTINCT CASE o_orderkey % 2 WHEN 0 THEN 'slaughter' ELSE 'cutting' END)), ',') AS activities, arg_min('Op' || o_orderkey, o_orderkey) FILTER (WHERE o_orderkey % 2 = 0) AS operator, arg_min('size ' || o_orderkey, o_orderkey) FILTER (WHERE o_orderkey % 5 = 0) AS size_class FROM orders GROUP BY o_custkey")
def a6(spark, d):
    return _assembled(spark, d).select("uid", F.array_join("species", ",").alias("species"), F.array_join("activities", ",").alias("activities"), "operator", "size_class")


@query("a9_members", f"SELECT {UID}, string_agg(o_orderkey || ':' || coalesce({NAMED}, ''), ',' ORDER BY o_orderkey) AS members FROM orders GROUP BY o_custkey")
def a9(spark, d):
    """Every record, in input order, with its own cells."""
    shown = F.transform("members", lambda m: F.concat_ws(":", m["national_id"], F.coalesce(m["name"], F.lit(""))))
    return _assembled(spark, d).select("uid", F.array_join(shown, ",").alias("members"))


@query("f2_mappable", f"SELECT {UID} FROM orders GROUP BY o_custkey HAVING bool_or(o_orderkey % 6 = 0)")
def f2(spark, d):
    return _assembled(spark, d).where(assemble.mappable()).select("uid")


@query("a8_uid", "SELECT user_id, 'f' || substr(sha1(string_agg('e:' || event_id, '|' ORDER BY 'e:' || event_id)), 1, 16) AS uid FROM events GROUP BY 1")
def a8(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(assemble.uid(F.collect_list(F.concat(F.lit("e:"), F.col("event_id").cast("string")))).alias("uid"))


FACILITIES = "fac AS (SELECT p_partkey, 'u' || p_partkey AS uid, list_filter(['slaughter', 'cutting', 'zoo'], lambda a: (a = 'slaughter' AND p_size % 5 = 0) OR (a = 'cutting' AND p_size % 2 = 0) OR (a = 'zoo' AND p_size % 7 = 0)) acts, list_filter(['bovine', 'fish'], lambda s: (s = 'bovine' AND p_size % 3 = 0) OR (s = 'fish' AND p_size % 4 = 0)) sp, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END kills, p_brand src FROM part)"


def _facilities(spark, d):
    z, k = F.col("p_size"), F.col("p_partkey")
    acts = F.array_compact(F.array(F.when(z % 5 == 0, "slaughter"), F.when(z % 2 == 0, "cutting"), F.when(z % 7 == 0, "zoo")))
    sp = F.array_compact(F.array(F.when(z % 3 == 0, "bovine"), F.when(z % 4 == 0, "fish")))
    member = F.array(F.struct(F.col("p_brand").alias("source"), F.lit("S").alias("id_scheme"), k.cast("string").alias("national_id")))
    return table(spark, d, "part").select(
        k.alias("p_partkey"), F.concat(F.lit("u"), k.cast("string")).alias("uid"), F.col("p_name").alias("name"), acts.alias("activities"), sp.alias("species"),
        F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("slaughter"), member.alias("members"), F.array().cast("array<string>").alias("match_tiers"), F.lit(False).alias("review"),
        F.lit("street").alias("geo_precision"), (k % 90).cast("double").alias("lat"), (k % 180).cast("double").alias("lon"), F.concat(F.lit("C"), (k % 9).cast("string")).alias("country_iso3"),
    )


OUT = _quoted(EXCLUDED_ACTIVITIES)


@query("f1_excluded", f"WITH {FACILITIES} SELECT p_partkey FROM fac WHERE NOT (len(acts) > 0 AND len(list_filter(acts, lambda a: a NOT IN ({OUT}))) = 0 AND NOT coalesce(kills, false))")
def f1(spark, d):
    return publish.drop_excluded(_facilities(spark, d)).select("p_partkey")


@query("f5_facets", f"WITH {FACILITIES} SELECT p_partkey FROM fac WHERE (list_has_any(sp, ['bovine']) OR len(sp) = 0) AND list_has_any(acts, ['slaughter', 'cutting']) AND CASE WHEN kills THEN 1 WHEN NOT kills THEN 0 ELSE 2 END IN (1, 2)")
def f5(spark, d):
    return _facilities(spark, d).where(publish.facet_filter(species=["bovine", "_none"], activities=["slaughter", "cutting"], slaughter=[1, 2])).select("p_partkey")


FACETS = f"""{FACILITIES}, x AS (SELECT uid, 'species' facet, unnest(CASE WHEN len(sp) = 0 THEN ['_none'] ELSE sp END) AS value FROM fac
UNION ALL SELECT uid, 'activity', unnest(list_filter(acts, lambda a: a NOT IN ({OUT}))) FROM fac
UNION ALL SELECT uid, 'slaughter', CASE WHEN kills THEN '1' WHEN NOT kills THEN '0' ELSE '2' END FROM fac UNION ALL SELECT uid, 'source', src FROM fac)"""


@query("a11_shares", f"WITH {FACETS} SELECT facet, value, count(*) n, round(100.0 * count(*) / (SELECT count(*) FROM fac), 1) AS percent FROM x GROUP BY ALL")
def a11(spark, d):
    return publish.shares(_facilities(spark, d))


@query("a12_tallies", f"WITH {FACETS} SELECT facet, value, count(*) n FROM x JOIN fac USING (uid) WHERE kills AND value <> 'fish' GROUP BY ALL")
def a12(spark, d):
    return publish.tallies(_facilities(spark, d), F.col("slaughter"))


@query("a18_t1_most_common", "SELECT event_type, count(*) n FROM events GROUP BY 1 ORDER BY n DESC, min(event_id) LIMIT 25")
def a18(spark, d):
    return publish.top(table(spark, d, "events"), "event_type", 25, "event_id")


@query("p8_a19_crowding", f"WITH {SITES}, t AS (SELECT k, round(lat, 5) y, round(lon, 5) x, coalesce(postcode, '') town FROM (SELECT k, (k // 4 % 50)::DOUBLE lat, (k // 8 % 70)::DOUBLE lon, postcode FROM sites)) SELECT k, shared, towns FROM t JOIN (SELECT y, x, count(*) shared, count(DISTINCT town) towns FROM t GROUP BY ALL) USING (y, x)")
def p8(spark, d):
    from sitefold.sources.registers import crowded

    s = sites(spark, d).select("k", (F.floor(F.col("k") / 4) % 50).cast("double").alias("lat"), (F.floor(F.col("k") / 8) % 70).cast("double").alias("lon"), "postcode")
    return crowded(s, "lat", "lon", "postcode").select("k", F.col("_shared").alias("shared"), F.col("_towns").alias("towns"))


@query("t2_radius_topk", f"WITH {SITES}, m AS (SELECT k::VARCHAR AS uid, (lon + 180) / 360 - 0.5 dx, 0.5 - ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) / (4 * pi()) - 0.5 dy FROM sites) SELECT uid, round(dx * dx + dy * dy, 12) d2 FROM m WHERE dx * dx + dy * dy <= 0.04 ORDER BY dx * dx + dy * dy, uid LIMIT 40")
def t2(spark, d):
    s = sites(spark, d).withColumn("uid", F.col("k").cast("string"))
    return publish.nearest(s, 0.5, 0.5, 0.2, 40).select("uid", F.round("d2", 12).alias("d2"))


@query("f6_viewport", f"WITH {SITES} SELECT k FROM sites WHERE (lon + 180) / 360 BETWEEN 0.25 AND 0.6 AND 0.5 - ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) / (4 * pi()) BETWEEN 0.2 AND 0.5")
def f6(spark, d):
    return sites(spark, d).where(publish.in_viewport(0.25, 0.2, 0.6, 0.5)).select("k")


@query("t2_nearest_in_layout", SQL["t2_radius_topk"])
def t2_layout(spark, d):
    """The same by a search over the tiles of a layout."""
    path = new_dir(spark, "layout")
    tiles.lay_out(sites(spark, d).withColumn("uid", F.col("k").cast("string")), path)
    return tiles.Tiles(spark, path).nearest(0.5, 0.5, 0.2, 40).select("uid", F.round("d2", 12).alias("d2"))


@query("f6_viewport_of_layout", SQL["f6_viewport"])
def f6_layout(spark, d):
    path = new_dir(spark, "layout")
    tiles.lay_out(sites(spark, d), path)
    return tiles.Tiles(spark, path).viewport(0.25, 0.2, 0.6, 0.5).select("k")


@query("e1_dictionary", "SELECT value, (row_number() OVER (ORDER BY f, value) - 1)::INT AS id FROM (SELECT l_returnflag || ',' || l_linestatus AS value, min(l_orderkey * 10 + l_linenumber) f FROM lineitem GROUP BY 1)")
def e1(spark, d):
    li = table(spark, d, "lineitem").withColumn("o", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return publish.dictionary(li, F.concat_ws(",", "l_returnflag", "l_linestatus"), "o")


@query("e2_encode", f"WITH {FACILITIES} SELECT uid, CASE WHEN kills THEN 1 WHEN NOT kills THEN 0 ELSE 2 END AS slaughter, (p_partkey % 90 * 100000)::INT y, src || '|S|' || p_partkey AS id FROM fac")
def e2(spark, d):
    coded, _ = publish.encode(_facilities(spark, d))
    return coded.select("uid", "slaughter", "y", F.get("ids", F.lit(0)).alias("id"))


# The whole resolution of customers as sites, over all stages, and the same by recursion in SQL.

RESOLVED = f"""r AS (SELECT c_custkey k, 'x:' || c_custkey AS key, 'N' || (c_custkey // 60 % 3) country, 'Mill ' || c_mktsegment || ' ' || (100 + c_custkey // 2 % 10)::VARCHAR || CASE WHEN c_custkey % 3 = 0 THEN ' Ltd' ELSE '' END AS name,
  CASE WHEN c_custkey % 9 > 0 THEN (c_custkey // 7 % 160 - 80)::DOUBLE + (c_custkey % 7) * {SPREAD} END lat, CASE WHEN c_custkey % 9 > 0 THEN (c_custkey // 3 % 340 - 170)::DOUBLE + (c_custkey % 3) * 0.0003 END lon,
  CASE WHEN c_custkey % 4 > 0 THEN 'P-' || (c_custkey // 5)::VARCHAR END postcode, (c_custkey // 5 % 90)::VARCHAR || ' Mill Lane' address, CASE WHEN c_custkey % 6 = 0 THEN c_custkey // 12 END id FROM customer),
w AS (SELECT *, {TOKENS.format('name')} w, {NN.format('name')} nn, {AK.format('address', 'postcode')} ak FROM r),
cut AS (@cut),
ie AS (SELECT f.k0 a, w.k b FROM w JOIN (SELECT country, id, min(k) k0 FROM w WHERE id IS NOT NULL GROUP BY ALL HAVING count(*) > 1) f USING (country, id)),
i AS (SELECT a, b, 'id' tier FROM ie ANTI JOIN cut USING (a, b) UNION ALL SELECT a, b, 'review' FROM (@merge)),
pa AS (SELECT * FROM (SELECT a.k a, b.k b, NULL::DOUBLE m, {JACCARD.format('a.w', 'b.w')} score, a.country FROM w a JOIN w b ON a.country = b.country AND a.ak = b.ak AND a.k < b.k AND a.ak <> '' AND a.ak NOT LIKE '%#') WHERE score >= 0.4),
pg AS (SELECT * FROM (SELECT a.k a, b.k b, {HAVERSINE.format('a.lat', 'a.lon', 'b.lat', 'b.lon')} m, {JACCARD.format('a.w', 'b.w')} score, a.country FROM w a JOIN w b ON a.country = b.country AND abs(a.lat - b.lat) < 0.02 AND a.key < b.key) WHERE m <= 1500 AND score >= 0.4),
pn AS (SELECT a.k a, b.k b, NULL::DOUBLE m, 1.0::DOUBLE score, a.country FROM (SELECT * FROM w WHERE nn <> '' AND ak = '' AND lat IS NULL) a JOIN (SELECT * FROM w WHERE nn <> '' AND ak = '' AND lat IS NULL) b ON a.country = b.country AND a.nn = b.nn AND a.k < b.k
  JOIN (SELECT country, nn FROM w WHERE nn <> '' AND ak = '' AND lat IS NULL GROUP BY ALL HAVING count(*) BETWEEN 2 AND 12) g ON g.country = a.country AND g.nn = a.nn),
ma AS (SELECT a, b FROM pa WHERE score >= 0.6 AND (least(a, b), greatest(a, b)) NOT IN (SELECT (a, b) FROM cut)), mg AS (SELECT a, b FROM pg WHERE score >= 0.6 AND m <= 250 AND (least(a, b), greatest(a, b)) NOT IN (SELECT (a, b) FROM cut)),
h1 AS (SELECT a, b FROM i UNION SELECT b, a FROM i), h2 AS (SELECT * FROM h1 UNION SELECT a, b FROM ma UNION SELECT b, a FROM ma), h3 AS (SELECT * FROM h2 UNION SELECT a, b FROM mg UNION SELECT b, a FROM mg),
t1(n, c) AS (SELECT k, k FROM w UNION SELECT h1.b, t1.c FROM t1 JOIN h1 ON h1.a = t1.n), t2(n, c) AS (SELECT k, k FROM w UNION SELECT h2.b, t2.c FROM t2 JOIN h2 ON h2.a = t2.n), t3(n, c) AS (SELECT k, k FROM w UNION SELECT h3.b, t3.c FROM t3 JOIN h3 ON h3.a = t3.n),
c1 AS (SELECT n, min(c) c FROM t1 GROUP BY 1), c2 AS (SELECT n, min(c) c FROM t2 GROUP BY 1), c3 AS (SELECT n, min(c) c FROM t3 GROUP BY 1),
tiers AS (SELECT DISTINCT c3.c, tier FROM (SELECT a, tier FROM i UNION ALL SELECT a, 'addr' FROM ma JOIN c1 x ON x.n = a JOIN c1 y ON y.n = b WHERE x.c <> y.c UNION ALL SELECT a, 'geo' FROM mg JOIN c2 x ON x.n = a JOIN c2 y ON y.n = b WHERE x.c <> y.c) JOIN c3 ON c3.n = a),
queue AS (SELECT q.* FROM (SELECT pa.*, 'same postcode and street number' reason FROM pa JOIN c2 x ON x.n = a JOIN c2 y ON y.n = b WHERE x.c <> y.c
  UNION ALL SELECT pg.*, floor(m)::BIGINT || ' m apart' FROM pg JOIN c3 x ON x.n = a JOIN c3 y ON y.n = b WHERE x.c <> y.c
  UNION ALL SELECT pn.*, 'identical name, no usable location on either record' FROM pn JOIN c3 x ON x.n = a JOIN c3 y ON y.n = b WHERE x.c <> y.c) q WHERE (least(a, b), greatest(a, b)) NOT IN (SELECT (a, b) FROM cut)),
fac AS (SELECT c3.c, 'f' || substr(sha1(string_agg(key, '|' ORDER BY key)), 1, 16) AS uid, list_sort(list(DISTINCT struct_pack(l := -length(name), w := name)))[1].w AS name, min(country) country, count(*) members,
  arg_min(address, struct_pack(r := CASE WHEN postcode IS NULL THEN 1 ELSE 0 END, k := k)) AS address, arg_min(lat, k) FILTER (WHERE lat IS NOT NULL) AS lat, c3.c IN (SELECT unnest([x.c, y.c]) FROM queue JOIN c3 x ON x.n = a JOIN c3 y ON y.n = b) AS review FROM w JOIN c3 ON c3.n = k GROUP BY c3.c),
tiered AS (SELECT fac.*, coalesce((SELECT string_agg(tier, ',' ORDER BY tier) FROM tiers WHERE tiers.c = fac.c), '') AS tiers FROM fac)"""
NO_DECISIONS = {"cut": "SELECT 0::BIGINT a, 0::BIGINT b WHERE false", "merge": "SELECT 0::BIGINT a, 0::BIGINT b WHERE false"}
#: Every tenth pair of an identifier is split, and every other of these is held together by two merges all the same; each
#: fiftieth customer is merged with the seventh after it.
DECISIONS = {"cut": "SELECT c_custkey a, c_custkey + 6 b FROM customer WHERE c_custkey % 120 = 0", "merge": "SELECT c_custkey a, c_custkey + 7 b FROM customer WHERE c_custkey % 50 = 0 AND c_custkey + 7 <= (SELECT max(c_custkey) FROM customer) UNION ALL SELECT c_custkey + x, c_custkey + x + 3 FROM customer, (VALUES (0), (3)) v(x) WHERE c_custkey % 240 = 0 AND c_custkey + 6 <= (SELECT max(c_custkey) FROM customer)"}


def resolved_sql(decisions: dict[str, str]) -> str:
    return RESOLVED.replace("@cut", decisions["cut"]).replace("@merge", decisions["merge"])


def canonical_sites(spark, d, customers: DataFrame | None = None) -> DataFrame:
    """Customers in the canonical columns."""
    s, k = sites(spark, d, customers), F.col("k")
    at = F.when(k % 9 > 0, F.col("lat") + (k % 7) * (SPREAD - 0.0004))
    given = {
        "source_id": F.lit("x"), "source_row_id": k.cast("string"), "name": F.col("name"), "country_iso3": F.concat(F.lit("N"), (F.floor(k / 60) % 3).cast("string")), "national_id": F.when(k % 6 == 0, F.floor(k / 12).cast("string")), "id_scheme": F.lit("S"),
        "address": F.col("address"), "postcode": F.col("postcode"), "src_lat": at, "src_lon": F.when(k % 9 > 0, F.col("lon")), "src_precision": F.when(k % 9 > 0, "rooftop"),
    }
    return s.select(*[given.get(f, F.lit(None)).cast(TYPES[f]).alias(f) for f in FIELDS], k.alias("seq"))


@query("f3_hits_in_resolution", "SELECT 'x:' || k AS key, CASE WHEN g % 3 < 2 OR g % 6 = 2 THEN count(*) OVER (PARTITION BY g) ELSE 1 END AS members, CASE WHEN g % 6 = 2 THEN 'source' ELSE 'cache' END AS provider FROM (SELECT s_suppkey k, s_suppkey // 2 g FROM supplier)")
def f3(spark, d):
    """Two records of a plant are at one place by the address cache: they merge if its answer is a house or a street, not if
    it is a town. A position of the source's own goes before the cache's."""
    k = F.col("s_suppkey")
    g = F.floor(k / 2)
    own = g % 6 == 2
    given = {
        "source_id": F.lit("x"), "source_row_id": k.cast("string"), "name": F.concat(F.lit("Plant w"), g.cast("string")), "country_iso3": F.lit("N1"),
        "src_lat": F.when(own, (g % 80).cast("double")), "src_lon": F.when(own, 1.0), "src_precision": F.when(own, "rooftop"),
    }
    s = table(spark, d, "supplier")
    records = s.select(*[given.get(f, F.lit(None)).cast(TYPES[f]).alias(f) for f in FIELDS], k.alias("seq"))
    where = F.when(g % 3 == 0, "rooftop").when(g % 3 == 1, "street").otherwise("locality")
    hits = s.select(F.concat(F.lit("x:"), k.cast("string")).alias("key"), (g % 80 + 0.5).alias("lat"), F.lit(2.0).alias("lon"), where.alias("precision"), F.lit("cache").alias("provider"))
    keyed, _, _ = resolve.resolve(records, hits)
    sizes = keyed.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    return keyed.join(sizes, "component").select("key", "members", resolve.position()["provider"].alias("provider"))


def decided(spark, d) -> DataFrame:
    k = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    key = lambda c: F.concat(F.lit("x:"), c.cast("string"))
    split = k.where("k % 120 = 0").select(key(F.col("k")).alias("a_key"), key(F.col("k") + 6).alias("b_key"), F.lit("split").alias("decision"))
    pairs = k.where("k % 50 = 0").join(k.select((F.col("k") - 7).alias("k")), "k", "left_semi")
    held = k.where("k % 240 = 0").join(k.select((F.col("k") - 6).alias("k")), "k", "left_semi").select(F.explode(F.array(F.col("k"), F.col("k") + 3)).alias("k"))
    merge = pairs.select(F.col("k"), (F.col("k") + 7).alias("to")).unionByName(held.select("k", (F.col("k") + 3).alias("to")))
    return split.unionByName(merge.select(key(F.col("k")).alias("a_key"), key(F.col("to")).alias("b_key"), F.lit(" Merge").alias("decision")))


def _resolved(spark, d, decisions: bool = False):
    found = resolve.resolved(canonical_sites(spark, d), decisions=decided(spark, d) if decisions else None)
    return found.keyed, assemble.assemble(found.keyed, found.tiers, found.pairs), found.queue


def _facilities_of(found: DataFrame) -> DataFrame:
    return found.select("uid", "name", F.col("country_iso3").alias("country"), F.size("members").alias("members"), "address", F.round("lat", 9).alias("lat"), "review", F.array_join("match_tiers", ",").alias("tiers"))


FOUND = "SELECT uid, name, country, members::INT members, address, round(lat, 9) lat, review, tiers FROM tiered"


@query("resolve_all_tiers", f"WITH RECURSIVE {resolved_sql(NO_DECISIONS)} {FOUND}")
def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Facilities of all sites, through the identifier, address, proximity and name stages."""
    return _facilities_of(_resolved(spark, d)[1])


@query("resolve_with_decisions", f"WITH RECURSIVE {resolved_sql(DECISIONS)} {FOUND}")
def resolve_decided(spark, d):
    """Reviewed merges are edges, splits take edges away."""
    return _facilities_of(_resolved(spark, d, True)[1])


@query("resolve_conflicts", f"WITH RECURSIVE {resolved_sql(DECISIONS)} SELECT 'x:' || a AS a_key, 'x:' || b AS b_key FROM cut JOIN c3 x ON x.n = a JOIN c3 y ON y.n = b WHERE x.c = y.c")
def resolve_conflicts(spark, d):
    return resolve.conflicts(_resolved(spark, d, True)[0], decided(spark, d))


@query("resolve_conflict_chains", f"""WITH RECURSIVE {resolved_sql(DECISIONS)},
ed AS (SELECT a, b FROM i UNION SELECT a, b FROM ma JOIN c1 x ON x.n = a JOIN c1 y ON y.n = b WHERE x.c <> y.c UNION SELECT a, b FROM mg JOIN c2 x ON x.n = a JOIN c2 y ON y.n = b WHERE x.c <> y.c),
eb AS (SELECT a, b FROM ed UNION SELECT b, a FROM ed), far(s, e, n, d) AS (SELECT a, b, a, 0 FROM cut JOIN c3 x ON x.n = a JOIN c3 y ON y.n = b WHERE x.c = y.c UNION SELECT s, e, eb.b, d + 1 FROM far JOIN eb ON eb.a = n WHERE d < 12)
SELECT 'x:' || s AS a_key, 'x:' || e AS b_key, min(d) AS steps FROM far WHERE n = e GROUP BY ALL""")
def conflict_chains(spark, d):
    """For each split pair that is in one component all the same, how many edges its shortest chain has; edges must follow on
    each other from end to end."""
    decisions = decided(spark, d)
    found = resolve.resolved(canonical_sites(spark, d), decisions=decisions)
    pairs = materialise(resolve.conflicts(found.keyed, decisions), "conflicts")
    steps = resolve.chains(found.edges, pairs, found.groups, found.ties).groupBy("a_key", "b_key").agg(F.array_sort(F.collect_list(F.struct("step", "src", "dst"))).alias("c"))
    whole = (F.col("c")[0]["src"] == F.col("a_key")) & (F.element_at("c", -1)["dst"] == F.col("b_key")) & (F.slice("c.src", F.lit(2), F.size("c")) == F.slice("c.dst", F.lit(1), F.size("c") - 1))
    return steps.select("a_key", "b_key", F.when(whole, F.size("c")).cast("bigint").alias("steps"))


@query("p14_source_parsed_again", f"WITH RECURSIVE {resolved_sql(NO_DECISIONS)} {FOUND}")
def parsed_again(spark, d):
    """The sites once more, from a resolution in which a register had other rows: each 20th site under another number and name, each
    45th missing, and one too many. Only what that reaches is resolved again; the result is that of resolve_all_tiers."""
    now = canonical_sites(spark, d)
    k = F.col("seq")
    then = now.where(k % 45 != 1).withColumns({"name": F.when(k % 20 == 3, F.lit("Old Mill")).otherwise(F.col("name")), "national_id": F.when(k % 20 == 3, F.lit("1")).otherwise(F.col("national_id")), "id_scheme": F.lit("S")})
    extra = now.where(k % 200 == 7).withColumns({"source_row_id": F.concat(F.lit("y"), "source_row_id"), "seq": k + 10_000_000})
    was = resolve.resolved(then.unionByName(extra))
    keyed, tiers, pairs, classes = (materialise(x, "was") for x in (was.keyed, was.tiers, was.pairs, was.classes))
    kept = upkeep.replace_source(keyed, tiers, pairs, now, "x", classes=classes)
    return _facilities_of(assemble.assemble(kept.keyed, kept.tiers, kept.queue))


QUEUE = "SELECT 'x:' || a AS a_key, 'x:' || b AS b_key, country, round(score, 3) AS name_score, floor(m)::INT AS metres_apart, reason FROM queue"


@query("resolve_review_queue", f"WITH RECURSIVE {resolved_sql(NO_DECISIONS)} {QUEUE}")
def review_queue(spark, d):
    return _resolved(spark, d)[2].select("a_key", "b_key", "country", "name_score", "metres_apart", "reason")


@query("e6_review_file", f"WITH RECURSIVE {resolved_sql(NO_DECISIONS)} SELECT a_key, b_key, reason FROM ({QUEUE})")
def e6(spark, d):
    """The queue as the file that reviewers fill in, read again."""
    path = new_dir(spark, "review")
    publish.write_review(_resolved(spark, d)[2], path)
    return spark.read.option("header", True).csv(path).where("decision IS NULL").select("a_key", "b_key", "reason")


@query("e5_facility_file", f"WITH RECURSIVE {resolved_sql(NO_DECISIONS)} SELECT uid, name, members::INT members FROM tiered")
def e5(spark, d):
    path = new_dir(spark, "facilities")
    publish.write_json(_resolved(spark, d)[1], path)
    return spark.read.json(path).select("uid", "name", F.size("members").alias("members"))


@query("e5_facility_array", SQL["e5_facility_file"])
def e5_array(spark, d):
    """One array in one file, read again."""
    path = f"{new_dir(spark, 'facilities')}.json.gz"
    publish.write_json_array(_resolved(spark, d)[1], path)
    return spark.read.option("multiLine", True).json(path).select("uid", "name", F.size("members").alias("members"))


@query("a10_a20_report", f"""WITH RECURSIVE {resolved_sql(NO_DECISIONS)} SELECT 'total' AS section, item, n FROM (SELECT 'rows' item, count(*) n FROM w UNION ALL SELECT 'facilities', count(*) FROM fac UNION ALL SELECT 'review pairs', count(*) FROM queue
UNION ALL SELECT 'mappable', count(*) FROM fac WHERE lat IS NOT NULL UNION ALL SELECT 'unlocated', count(*) FROM fac WHERE lat IS NULL) UNION ALL SELECT 'source', 'x', count(*) FROM w UNION ALL SELECT 'tier', tier, count(*) FROM tiers GROUP BY tier UNION ALL SELECT 'size', members::VARCHAR, count(*) FROM fac GROUP BY members""")
def a10(spark, d):
    keyed, facilities, queue = _resolved(spark, d)
    return assemble.report(keyed, facilities, queue)


@query("t3_unlocated", f"WITH RECURSIVE {resolved_sql(NO_DECISIONS)} SELECT country AS country_iso3, count(*) AS n FROM fac WHERE lat IS NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 2")
def t3(spark, d):
    return publish.unlocated(_resolved(spark, d)[1], 2)


@query("j1_key_collisions", "SELECT CASE WHEN o_linenumber = 1 THEN 'o:' || l_orderkey ELSE 'o:' || l_orderkey || '#' || o_linenumber END AS key, seq FROM (SELECT l_orderkey, l_orderkey * 10 + l_linenumber seq, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) o_linenumber FROM lineitem)")
def f3(spark, d):
    """Rows that share a key are numbered from the second on; none is lost."""
    rows = table(spark, d, "lineitem").select(F.lit("o").alias("source_id"), F.col("l_orderkey").cast("string").alias("source_row_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.lit("n").alias("name"))
    return resolve.with_keys(rows).select("key", "seq")


@query("t4_outstanding_first", f"WITH {CACHE} SELECT idx.qkey, min(seq) seq FROM idx LEFT JOIN cache USING (qkey) WHERE tries IS NULL OR (lat IS NULL AND tries < 3) GROUP BY 1 ORDER BY seq, qkey LIMIT 20")
def t4(spark, d):
    return geocode.outstanding(*_cache(spark, d), 20).select("qkey", "seq")


@query("t5_probe", f"WITH {CACHE} SELECT least(count(DISTINCT qkey), 10) AS n, true AS known, true AS again FROM idx")
def t5(spark, d):
    """A sample of addresses: of the size asked for, known ones, the same again."""
    index, _ = _cache(spark, d)
    one, two = geocode.probe(index), geocode.probe(index.repartition(3))
    known = one.join(index.select("qkey").distinct(), "qkey").agg(F.count(F.lit(1)).alias("k"))
    same = one.join(two, "qkey").agg(F.count(F.lit(1)).alias("s"))
    return one.agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(known)).join(F.broadcast(same)).select("n", (F.col("k") == F.col("n")).alias("known"), (F.col("s") == F.col("n")).alias("again"))


def gazetteer(parts: dict) -> dict | None:
    """A provider that knows every fourth address by its street, puts the next into another country unless asked for the city, knows nothing of the third and fails at the last."""
    n = int(parts["qkey"].split("|")[1])
    if parts["street"]:
        return {"lat": float(n), "lon": 1.0, "precision": "rooftop", "provider": "dict", "country": "XX" if n % 4 == 0 else "YY"} if n % 4 < 2 else None
    if n % 4 == 3:
        raise TimeoutError("no answer")
    return {"lat": n + 0.5, "lon": 1.0, "precision": "locality", "provider": "dict"} if n % 4 == 1 else None


@query("e9_geocoding_round", f"""WITH {CACHE}, old AS (SELECT DISTINCT qkey, lat::DOUBLE lat, precision, tries FROM cache), todo AS (SELECT DISTINCT idx.qkey, split_part(idx.qkey, '|', 2)::INT n, tries FROM idx LEFT JOIN old USING (qkey) WHERE tries IS NULL OR (lat IS NULL AND tries < 3)),
new AS (SELECT qkey, CASE n % 4 WHEN 0 THEN n::DOUBLE WHEN 1 THEN n + 0.5 END lat, CASE n % 4 WHEN 0 THEN 'rooftop' WHEN 1 THEN 'locality' ELSE 'none' END AS precision, (coalesce(tries, 0) + 1)::INT tries FROM todo WHERE n % 4 < 3)
SELECT * FROM old WHERE qkey NOT IN (SELECT qkey FROM new) UNION ALL SELECT * FROM new""")
def e9(spark, d):
    """What is outstanding is asked, from the whole address down; answers from another country are turned down, failures aren't kept; answers are added to a log, which then becomes the cache's next version."""
    index, cache = _cache(spark, d)
    index = index.withColumns({"street": F.col("qkey"), "city": F.lit("C")})
    store = Table(spark, new_dir(spark, "geocache"))
    store.commit(store.write(cache), 0)
    return geocode.ask(store, index, gazetteer, lanes=2).select("qkey", "lat", "precision", "tries")


@query("e9_stale_and_misses", f"WITH {CACHE} SELECT DISTINCT qkey, tries FROM cache WHERE qkey LIKE '1%' AND lat IS NOT NULL")
def e9_stale(spark, d):
    """Entries of another version and empty answers go."""
    _, cache = _cache(spark, d)
    marked = cache.withColumn("qkey", F.when(F.col("qkey").startswith("1"), F.concat(F.lit("v2|"), "qkey")).otherwise(F.col("qkey")))
    return geocode.purge_misses(geocode.drop_stale(marked)).select(F.substring("qkey", 4, 100).alias("qkey"), "tries")

