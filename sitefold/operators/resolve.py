"""Entity resolution: identifier, address and proximity tiers, closed by connected components, and a review queue.

Stages are ordered, and each looks only at pairs that the earlier ones left apart:
  id    records of a country that list the same normalised identifier;
  addr  same country, postcode and house number, names alike;
  geo   same country, within GEO_M metres, names alike;
  name  same country and name without any location: review only.
Alike is a Jaccard of name words of STRICT or more; from LOOSE on a pair is reviewed. Registers in EXACT
need equal names to merge. A pair is reviewed if its ends are apart after the stage's own merges.

Row identity: a key that several rows share gets '#2', '#3', ... for all but its first row, so none is lost.
Identifier edges are stars, so a popular number makes no pairs. Address and grid candidates meet on country, block and
a word: with a record's words in one order, the rarest first, two records can be alike only if their prefixes, all
words but the last ceil(LOOSE * n) - 1, share one (prefix filter); where many share a word, shorter prefixes by the sizes
of both sets hold. So a crowded block makes few pairs of unlike names.
Records of one block that nothing tells apart (class_of) are compared once, through the first of them; stars tie the
others to it. Pairs for review are kept between first ones; only the queue that is asked for deals them to all.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitefold.functions.geo import haversine_m
from sitefold.functions.text import addr_key, folded_name, folded_text, folded_tokens, norm_id, same_name, strip_accents
from sitefold.operators.components import components
from sitefold.plans.shared import materialise
from sitefold.vocabulary import MAPPABLE

# Thresholds of similarity, distance in metres, grid step in degrees, and group sizes of the name stage.
STRICT, LOOSE = 0.60, 0.40
GEO_M, GEO_LOOSE_M = 250, 1500
GRID = 0.01
NAME_GROUP = (2, 12)
EXACT = ["br_trase"]
#: Links between records up to which one task closes them; registers of a country have fewer, those of the world more.
FEW_LINKS = 1 << 19


def with_keys(records: DataFrame) -> DataFrame:
    """Adds key, source_id:source_row_id, numbered from the second row of a key on."""
    base = F.concat_ws(":", "source_id", "source_row_id")
    nth = F.row_number().over(Window.partitionBy("_k").orderBy("seq", "name"))
    rows = records.withColumn("_k", base).withColumn("_n", nth)
    return rows.withColumn("key", F.when(F.col("_n") == 1, F.col("_k")).otherwise(F.concat_ws("#", "_k", F.col("_n").cast("string")))).drop("_k", "_n")


def collisions(records: DataFrame) -> DataFrame:
    """Keys that several rows share."""
    return records.groupBy(F.concat_ws(":", "source_id", "source_row_id").alias("key")).count().where("count > 1")


def position(lat: str = "src_lat", lon: str = "src_lon", precision: str = "src_precision") -> Column:
    """The position to work with: the source's if it has one, else the cache's, as (lat, lon, precision, provider)."""
    own = F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon"), F.coalesce(precision, F.lit("rooftop")).alias("precision"), F.lit("source").alias("provider"))
    hit = F.struct(F.col("hit_lat").alias("lat"), F.col("hit_lon").alias("lon"), F.col("hit_precision").alias("precision"), F.col("hit_provider").alias("provider"))
    return F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), own).when(F.col("hit_lat").isNotNull(), hit)


def with_hits(records: DataFrame, hits: DataFrame | None) -> DataFrame:
    """hits: (key, lat, lon, precision, provider) from the address cache. A source's position of too low a precision is
    not replaced by the cache's."""
    if hits is None:
        return records.withColumns({c: F.lit(None).cast(t) for c, t in (("hit_lat", "double"), ("hit_lon", "double"), ("hit_precision", "string"), ("hit_provider", "string"))})
    return records.join(hits.select("key", F.col("lat").alias("hit_lat"), F.col("lon").alias("hit_lon"), F.col("precision").alias("hit_precision"), F.col("provider").alias("hit_provider")), "key", "left")


def prepared(keyed: DataFrame, *more: str) -> DataFrame:
    """The columns that the stages join on, each computed once for a record, and more."""
    p = position()
    rows = keyed.withColumn("_name", strip_accents(F.col("name"))).withColumn("text", folded_text(F.col("_name"))).withColumn("nn", folded_name(F.col("text")))
    rows = rows.withColumn("p", p)
    precise = F.col("p.precision").isin(*MAPPABLE)
    return rows.select(
        "key", "seq", "source_id", F.coalesce(F.nullif("country_iso3", F.lit("")), F.lit("ZZZ")).alias("country"), "name", "address", "national_id", "text", "nn",
        folded_tokens(F.col("nn")).alias("words"), addr_key(F.col("address"), F.col("postcode")).alias("ak"),
        F.when(precise, F.col("p.lat")).alias("lat"), F.when(precise, F.col("p.lon")).alias("lon"),
        F.array_compact(F.array(norm_id(F.col("id_scheme"), F.col("national_id")), norm_id(F.col("foreign_id_scheme"), F.col("foreign_id")))).alias("ids"), *more,
    )


def id_edges(rows: DataFrame) -> DataFrame:
    """(src, dst) from each identifier's first record to the others. A record that lists one twice has an edge to itself."""
    listed = rows.select("key", "seq", "country", F.explode("ids").alias("id"))
    first = listed.groupBy("country", "id").agg(F.min_by("key", F.struct("seq", "key")).alias("src"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return listed.join(first, ["country", "id"]).where("key <> src OR n > 1").select("src", F.col("key").alias("dst")).distinct()


#: Words that more than 1 / COMMON of all words are, at most COMMON of them, are counted for the order of rarity; others come first.
COMMON = 1 << 16


def with_prefix(rows: DataFrame) -> DataFrame:
    """Adds prefix: the words, rarest first, of which alike records (LOOSE or more) share at least one. Words that are
    not common come first, by themselves, then the common ones by their number. Each different set of words is ordered once."""
    sets = materialise(rows.groupBy("words").agg(F.count(F.lit(1)).alias("_n")), "word-sets")
    words = sets.select("words", "_n", F.explode("words").alias("w"))
    n = words.agg(F.sum("_n")).first()[0] or 0
    common = words.groupBy("w").agg(F.sum("_n").alias("n")).where(F.col("n") * COMMON > n)
    ordered = words.join(F.broadcast(common), "w", "left").groupBy("words").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "w"))).alias("_o"))
    size = F.size("_o")
    some = F.slice("_o", F.lit(1), size - F.ceil(size * LOOSE - 1e-9).cast("int") + 1)
    prefixes = materialise(ordered.select("words", F.transform(some, lambda x: x["w"]).alias("prefix")), "prefixes")
    return rows.join(prefixes, "words", "left")


def _sides(rows: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    some = ["key", "seq", "source_id", "text", "words", "lat", "lon", *more]
    on = [c for c in ("place", "country", "block", "token") if c in rows.columns]
    return tuple(rows.select(*on, *[F.col(c).alias(f"{s}_{c}") for c in some]) for s in "ab")


#: Rows of one block and word from which they meet by their numbers of words as well, and such groups that are broadcast.
CROWD, FEW_CROWDS = 256, 100_000


def _by_size(rows: DataFrame, crowds: DataFrame | None) -> DataFrame:
    """rows (country, block, token, at, words, ...) with own and other: 0, or in a crowd the own number of words and, once
    for each, a number of words that a partner can have.

    Sets of m and n words are alike only if they share at least LOOSE / (1 + LOOSE) * (m + n); so the first word that
    they share stands before the last ones that many less one, in either.
    """
    if crowds is None:
        return rows.withColumns({"own": F.lit(0), "other": F.lit(0)}).drop("at")
    m = F.size("words")
    shared = lambda n: F.ceil((m + n) * (LOOSE / (1 + LOOSE)) - 1e-9).cast("int")
    possible = F.sequence(F.ceil(m * LOOSE - 1e-9).cast("int"), F.floor(m / LOOSE + 1e-9).cast("int"))
    partners = F.filter(possible, lambda n: F.col("at") <= m - shared(n))
    rows = rows.join(crowds, ["country", "block", "token"], "left").withColumn("own", F.when(F.col("_n").isNull(), 0).otherwise(m))
    return rows.withColumn("other", F.explode(F.when(F.col("_n").isNull(), F.array(F.lit(0))).otherwise(partners))).drop("_n", "at")


def _met(rows: DataFrame, order: str, reach: DataFrame | None = None) -> DataFrame:
    """Pairs of rows (with prefix) of one country and block that share a word of their prefixes, at the first such word only.

    reach: (country, block, to) has the blocks of the one side for each block of the other, if not just its own.
    """
    by_word = lambda r: r.select("*", F.posexplode("prefix").alias("at", "token"))
    listed = by_word(rows)
    crowds = materialise(listed.groupBy("country", "block", "token").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= CROWD), "crowds")
    n = crowds.count()
    crowds = None if n == 0 else F.broadcast(crowds) if n <= FEW_CROWDS else crowds
    far = listed if reach is None else by_word(rows.join(reach, ["country", "block"]).drop("block").withColumnRenamed("to", "block"))
    more = ("prefix", "own", "other")
    placed = lambda r: _by_size(r, crowds).withColumn("place", F.xxhash64("country", "block", "token"))
    a, b = _sides(placed(far), *more)[0], _sides(placed(listed), *more)[1]
    least = LOOSE * F.greatest(F.size("a_words"), F.size("b_words")) - 1e-9
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("place", "country", "block", "token")] + [F.col("a_own") == F.col("b_other"), F.col("a_other") == F.col("b_own")]
    pairs = a.alias("a").join(b.alias("b"), same).where(order).select("a.*", *[c for c in b.columns if c.startswith("b_")])
    pairs = pairs.where(F.least(F.size("a_words"), F.size("b_words")) >= least).where("token = array_intersect(a_prefix, b_prefix)[0]")
    return pairs.drop("a_prefix", "b_prefix", "a_own", "b_own", "a_other", "b_other", "token", "place")


def _scored(pairs: DataFrame) -> DataFrame:
    """Adds score and merges: alike by words, and by the whole name where a register asks for it."""
    exact = F.col("a_source_id").isin(*EXACT) | F.col("b_source_id").isin(*EXACT)
    shared = F.size(F.array_intersect("a_words", "b_words"))  # words are distinct, so the union need not be made
    pairs = pairs.withColumn("score", shared / (F.size("a_words") + F.size("b_words") - shared))
    return pairs.where(F.col("score") >= LOOSE).withColumn("merges", (F.col("score") >= STRICT) & (~exact | same_name(F.col("a_text"), F.col("b_text"))))


BY_SEQ, BY_KEY = "(a_seq, a_key) < (b_seq, b_key)", "a_key < b_key"
ADDR_REASON = "same postcode and street number"


def at_address(rows: DataFrame) -> DataFrame:
    """Rows with a block: postcode and house number, both stated."""
    return rows.where("ak <> '' AND NOT endswith(ak, '#')").withColumn("block", F.col("ak"))


def addr_pairs(rows: DataFrame) -> DataFrame:
    """Alike pairs of one country, postcode and house number; both must be stated."""
    rows = rows if "prefix" in rows.columns else with_prefix(rows)
    return _scored(_met(at_address(rows), BY_SEQ)).withColumns({"metres": F.lit(None).cast("double"), "reason": F.lit(ADDR_REASON)})


def in_cells(rows: DataFrame) -> DataFrame:
    """Rows with a position, with their cell as block."""
    cell = F.struct(F.round(F.col("lat") / GRID).cast("long").alias("y"), F.round(F.col("lon") / GRID).cast("long").alias("x"))
    return rows.where("lat IS NOT NULL AND lon IS NOT NULL").withColumn("block", cell)


def around(block: Column, steps: int = 1) -> Column:
    """A cell and those up to some steps from it, in an array."""
    some = range(-steps, steps + 1)
    return F.array(*[F.struct((block["y"] + dy).alias("y"), (block["x"] + dx).alias("x")) for dy in some for dx in some])


def with_cells(rows: DataFrame, occupied: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with a position in their cells (block), and reach (country, block, to): to each occupied cell all that lie
    around one of the occupied cells around it, itself included. Both are found once for each cell.

    occupied: (country, block), the cells that hold a record, if rows are not all of them.
    """
    at = in_cells(rows)
    cells = at.select("country", "block").distinct()
    if occupied is not None:
        cells = cells.select("country", F.explode(around(F.col("block"), 2)).alias("block")).distinct().join(occupied, ["country", "block"], "left_semi")
    cells = materialise(cells, "cells")
    beside = materialise(cells.select("country", "block", F.explode(around(F.col("block"))).alias("to")).join(cells.withColumnRenamed("block", "to"), ["country", "to"], "left_semi"), "cells-beside")
    reach = beside.withColumnRenamed("to", "_by").join(beside.toDF("country", "_by", "to"), ["country", "_by"]).select("country", "block", "to").distinct()
    return at, reach


def _near(pairs: DataFrame, reach: float) -> DataFrame:
    return pairs.withColumn("metres", haversine_m(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))).where(F.col("metres") <= reach)


def grid_pairs(rows: DataFrame, metres: float = GEO_LOOSE_M) -> DataFrame:
    """All pairs that share the neighbourhood of an occupied cell, whatever their names, once each, a_key < b_key."""
    at, reach = with_cells(rows)
    far = at.join(reach, ["country", "block"]).drop("block").withColumnRenamed("to", "block")
    return _near(_sides(far)[0].join(_sides(at)[1], ["country", "block"]).where(BY_KEY), metres)


def _metres_apart(metres) -> Column:
    return F.concat(metres.cast("long").cast("string"), F.lit(" m apart"))


def geo_pairs(rows: DataFrame, occupied: DataFrame | None = None) -> DataFrame:
    """Alike pairs of neighbouring cells within GEO_LOOSE_M; they merge within GEO_M. occupied: as in with_cells."""
    rows = rows if "prefix" in rows.columns else with_prefix(rows)
    at, reach = with_cells(rows, occupied)
    pairs = _scored(_near(_met(at, BY_KEY, reach), GEO_LOOSE_M))
    pairs = pairs.withColumn("merges", F.col("merges") & (F.col("metres") <= GEO_M))
    return pairs.withColumn("reason", _metres_apart(F.col("metres")))


#: Equal rows of one place from which they are compared as one. A higher bound leaves places where classes stay below it,
#: and pairs that grow with the square of the table.
MANY_EQUAL = 2
#: Columns that the stages of pairs need.
STAGE = ["key", "seq", "source_id", "country", "text", "words", "ak", "lat", "lon", "prefix", "block"]


def class_of(rows: DataFrame, place: list[str], alone: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """(rows with each large class's first one only, its members (rep, key, seq); none without large classes).

    A class holds the rows of one country with equal place, name, words and need of an exact name: they merge with each
    other, and each is to other rows what the first is. Rows whose key is in alone, and those of small classes, stay.
    """
    rows = rows.where(F.size("words") > 0).select(*[c for c in rows.columns if c in STAGE])
    rows = rows.withColumn("_exact", F.col("source_id").isin(*EXACT))
    rows = rows.withColumn("_hash", F.xxhash64("country", *place, "text", "words", "_exact"))
    # The hash comes first, as sorting by it is quick; the columns after it tell unequal rows apart.
    same = ["_hash", "country", *place, "text", "words", "_exact"]
    rows = rows if alone is None else rows.join(alone.withColumn("_alone", F.lit(True)), "key", "left")
    free = F.lit(True) if alone is None else F.col("_alone").isNull()
    first = rows.where(free).groupBy(*same).agg(F.min(F.struct("seq", "key")).alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = materialise(first.where(F.col("_n") >= MANY_EQUAL).select(*same, F.col("_first.key").alias("rep")), "first-of-classes")
    if first.isEmpty():
        return rows.drop("_hash", "_exact", "_alone"), None
    # One table for both: a stage reads its rows several times.
    told = materialise(rows.join(first, same, "left").withColumn("rep", F.when(free, F.col("rep"))).drop("_hash", "_exact", "_alone"), "classed")
    return told.where("rep IS NULL OR rep = key").drop("rep"), told.where("rep IS NOT NULL").select("rep", "key", "seq")


def stars(members: DataFrame, metres: float | None, reason: Column) -> DataFrame:
    """Pairs of a class's first row with the others; a_seq and b_seq are not needed."""
    pairs = members.where("key <> rep").select(F.col("rep").alias("a_key"), F.col("key").alias("b_key"))
    none = F.lit(None).cast("bigint")
    return pairs.withColumns({"a_seq": none, "b_seq": none, "score": F.lit(1.0), "metres": F.lit(metres).cast("double"), "reason": reason, "merges": F.lit(True)})


def dealt(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of first rows (tier, ...), for all members (tier, rep, key, seq) of either class, each pair in its stage's order."""
    for s in "ab":
        m = classes.select("tier", F.col("rep").alias(f"{s}_key"), F.col("key").alias("_key"), F.col("seq").alias("_seq"))
        pairs = pairs.join(m, ["tier", f"{s}_key"], "left").withColumns({f"{s}_key": F.coalesce("_key", f"{s}_key"), f"{s}_seq": F.coalesce("_seq", f"{s}_seq")}).drop("_key", "_seq")
    turn = ~F.when(F.col("tier") == "geo", F.expr(BY_KEY)).otherwise(F.expr(BY_SEQ))
    other = {f"{s}_{c}": F.when(turn, F.col(f"{t}_{c}")).otherwise(F.col(f"{s}_{c}")) for s, t in ("ab", "ba") for c in ("key", "seq")}
    return pairs.withColumns(other)


NAME_REASON = "identical name, no usable location on either record"


def unplaced(rows: DataFrame) -> DataFrame:
    """Rows without postcode or precise position, with their name as block."""
    return rows.where("nn <> '' AND ak = '' AND lat IS NULL").withColumn("block", F.col("nn"))


def name_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of equal names in groups of 2 to 12 without postcode or precise position."""
    bare = unplaced(rows)
    sizes = bare.groupBy("country", "block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n").between(*NAME_GROUP)).drop("n")
    a, b = _sides(bare.join(sizes, ["country", "block"], "left_semi"))
    pairs = a.join(b, ["country", "block"]).where("(a_seq, a_key) < (b_seq, b_key)")
    return pairs.withColumns({"score": F.lit(1.0), "metres": F.lit(None).cast("double"), "reason": F.lit(NAME_REASON), "merges": F.lit(False)})


PAIR = ["a_key", "b_key", "a_seq", "b_seq", "score", "metres", "reason", "merges"]


def between(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """Adds _ca and _cb, the ends' components in joined (node, component)."""
    a, b = joined.toDF("a_key", "_ca"), joined.toDF("b_key", "_cb")
    out = pairs.join(a, "a_key", "left").join(b, "b_key", "left")
    return out.withColumns({"_ca": F.coalesce("_ca", "a_key"), "_cb": F.coalesce("_cb", "b_key")})


def apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components of joined (node, component)."""
    return between(pairs, joined).where("_ca <> _cb")


def further(joined: DataFrame, new: DataFrame) -> DataFrame:
    """joined (node, component) after edges new (_ca, _cb) between its components; records without an edge are their own."""
    merged = materialise(components(new, "_ca", "_cb", small=FEW_LINKS), "merged")
    moved = joined.join(merged.toDF("component", "_to"), "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    return materialise(moved.unionByName(merged.join(joined.select("node"), "node", "left_anti")), "components")


def _split_pairs(decisions: DataFrame | None) -> DataFrame | None:
    return None if decisions is None else decisions.where("lower(trim(decision)) = 'split'").select(F.least("a_key", "b_key").alias("_l"), F.greatest("a_key", "b_key").alias("_g")).distinct()


def merge_edges(decisions: DataFrame) -> DataFrame:
    return decisions.where("lower(trim(decision)) = 'merge'").select(F.col("a_key").alias("src"), F.col("b_key").alias("dst"))


def not_split(pairs: DataFrame, decisions: DataFrame | None) -> DataFrame:
    split = _split_pairs(decisions)
    return pairs if split is None else pairs.join(split, (F.least("a_key", "b_key") == F.col("_l")) & (F.greatest("a_key", "b_key") == F.col("_g")), "left_anti")


def described(pairs: DataFrame, rows: DataFrame, decisions: DataFrame | None) -> DataFrame:
    """Pairs that are not decided already, as the review queue shows them."""
    pairs = not_split(pairs, decisions)
    side = lambda s: rows.select(F.col("key").alias(f"{s}_key"), F.col("source_id").alias(f"{s}_source"), F.col("name").alias(f"{s}_name"), F.col("address").alias(f"{s}_address"), F.col("national_id").alias(f"{s}_id"))
    pairs = pairs.join(side("a"), "a_key").join(side("b"), "b_key").join(rows.select(F.col("key").alias("a_key"), "country"), "a_key")
    names = [f"{s}_{c}" for s in "ab" for c in ("key", "source", "name", "address", "id")]
    return pairs.select(*names, "country", F.round("score", 3).alias("name_score"), F.col("metres").cast("int").alias("metres_apart"), "reason", F.lit("").alias("decision"))


def _groups(alike: DataFrame, members: DataFrame, joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups (tier, group, node, before), ties (tier, group, to)): the merging pairs of one stage, whole, in little space.

    alike: pairs (src, dst, _ca, _cb, tier) of first rows, stars among them; members: (tier, rep, key, seq). A group is a class or
    a single record, named by its first one; before is a node's component before the stage. Each node of a group is alike
    to each of the groups that it is tied to, its own class among them, and has an edge to those of another before.
    """
    many = members.join(joined.withColumnRenamed("node", "key"), "key", "left").select("tier", F.col("rep").alias("group"), F.col("key").alias("node"), F.coalesce("component", "key").alias("before"))
    pairs = alike.join(members.where("key <> rep").select(F.col("key").alias("dst"), F.col("rep").alias("src")), ["src", "dst"], "left_anti")
    ends = pairs.select("tier", F.col("src").alias("group"), F.col("src").alias("node"), F.col("_ca").alias("before")).union(pairs.select("tier", "dst", "dst", "_cb")).distinct()
    ones = ends.join(members.select(F.col("key").alias("node")), "node", "left_anti")
    within = members.select("tier", F.col("rep").alias("group"), F.col("rep").alias("to")).distinct()
    ties = pairs.select("tier", F.col("src").alias("group"), F.col("dst").alias("to")).union(pairs.select("tier", "dst", "src")).union(within).distinct()
    return many.unionByName(ones), ties


class Resolved(NamedTuple):
    #: Records with component; (component, tier); all pairs to review; edges (src, dst, tier) that tie components.
    keyed: DataFrame
    tiers: DataFrame
    queue: DataFrame
    edges: DataFrame
    #: The pairs to review between the first records of classes (tier, a_key, b_key, ...), from which dealt() makes those of
    #: queue. Members of a class share a component, so these are enough to tell which facilities are to be reviewed.
    pairs: DataFrame
    #: Members of classes, the first one among them: (tier, rep, key, seq).
    classes: DataFrame
    #: For chains(): groups (tier, group, node, before) and ties (tier, group, to).
    groups: DataFrame
    ties: DataFrame


def resolved(records: DataFrame, hits: DataFrame | None = None, decisions: DataFrame | None = None) -> Resolved:
    """decisions: (a_key, b_key, decision 'merge' or 'split'). A merge is an edge of tier 'review'; a split takes
    away the pair's own edges, and conflicts() lists split pairs that other edges still connect.
    """
    return resolve_keyed(materialise(with_hits(with_keys(records), hits), "records"), decisions)


def resolve(records: DataFrame, hits: DataFrame | None = None, decisions: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The first three of resolved(): (keyed records with component, tiers (component, tier), review pairs)."""
    return resolved(records, hits, decisions)[:3]


def resolve_keyed(keyed: DataFrame, decisions: DataFrame | None = None, occupied: DataFrame | None = None, mates: DataFrame | None = None) -> Resolved:
    """As resolved(), for records that have their keys and hits.

    For records that are only some of all: occupied, the cells that hold any record (with_cells), and mates, others
    (as from prepared) that share an identifier with them, so that stars have their centres as among all.
    """
    rows = materialise(with_prefix(materialise(prepared(keyed), "names")), "prepared")
    split = _split_pairs(decisions)

    def allowed(edges: DataFrame) -> DataFrame:
        return edges if split is None else edges.join(split, (F.least("src", "dst") == F.col("_l")) & (F.greatest("src", "dst") == F.col("_g")), "left_anti")

    listed = ["key", "seq", "country", "ids"]
    by_id = id_edges(rows if mates is None else rows.select(*listed).unionByName(mates.select(*listed)))
    if mates is not None:
        for end in ("src", "dst"):
            by_id = by_id.join(rows.select(F.col("key").alias(end)), end, "left_semi")
    edges = [(allowed(by_id), "id")]
    if decisions is not None:
        edges.append((merge_edges(decisions), "review"))
    every = None
    for e, tier in edges:
        e = e.withColumn("tier", F.lit(tier))
        every = e if every is None else every.unionByName(e)
    every = materialise(every, "edges")
    joined = materialise(components(every, small=FEW_LINKS), "components")
    alone = None if split is None else split.select(F.col("_l").alias("key")).union(split.select("_g")).distinct()
    stages = (
        ("addr", at_address(rows), ["block"], addr_pairs, None, F.lit(ADDR_REASON)),
        ("geo", rows.where("lat IS NOT NULL AND lon IS NOT NULL"), ["lat", "lon"], lambda r: geo_pairs(r, occupied), 0.0, _metres_apart(F.lit(0))),
    )
    none = rows.select(F.lit("").alias("tier"), F.col("key").alias("rep"), "key", "seq").where("false")
    classes, review, groups, ties = none, [], [], []
    for tier, located, place, pairs_of, metres, reason in stages:
        first, members = class_of(located, place, alone)
        pairs = pairs_of(first).select(*PAIR)
        pairs = pairs if members is None else pairs.unionByName(stars(members, metres, reason))
        met = materialise(between(pairs, joined).withColumn("tier", F.lit(tier)), f"{tier}-pairs")
        left = met.where("_ca <> _cb")
        new = materialise(allowed(left.where("merges").select(F.col("a_key").alias("src"), F.col("b_key").alias("dst"), "tier", "_ca", "_cb")), "edges")
        every = every.unionByName(new.select("src", "dst", "tier"))
        mine = none if members is None else members.select(F.lit(tier).alias("tier"), "rep", "key", "seq")
        classes = classes.unionByName(mine)
        stage_groups, stage_ties = _groups(allowed(met.where("merges").withColumnsRenamed({"a_key": "src", "b_key": "dst"})), mine, joined)
        groups.append(stage_groups)
        ties.append(stage_ties)
        joined = further(joined, new)
        review.append(apart(left.where("NOT merges" if split is None else "true").select("tier", *PAIR), joined).select("tier", *PAIR))
    review.append(apart(name_pairs(rows).select(F.lit("name").alias("tier"), *PAIR), joined).select("tier", *PAIR))
    pairs = not_split(review[0].unionByName(review[1]).unionByName(review[2]), decisions)
    queue = described(dealt(pairs, classes), rows, decisions)
    tiers = every.join(joined, F.col("src") == F.col("node")).select("component", "tier").distinct()
    keyed = keyed.join(joined.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    return Resolved(keyed, tiers, queue, every, pairs, classes, groups[0].unionByName(groups[1]), ties[0].unionByName(ties[1]))


def conflicts(keyed: DataFrame, decisions: DataFrame) -> DataFrame:
    """Split pairs that are in one component all the same."""
    a = keyed.select(F.col("key").alias("a_key"), F.col("component").alias("_ca"))
    b = keyed.select(F.col("key").alias("b_key"), F.col("component").alias("_cb"))
    return decisions.where("lower(trim(decision)) = 'split'").join(a, "a_key").join(b, "b_key").where("_ca = _cb").select("a_key", "b_key")


def _over_groups(open_: DataFrame, groups: DataFrame, ties: DataFrame) -> DataFrame:
    """(a_key, b_key, node, src, tier): what the nodes of open_ are linked to through groups, from the smallest src.

    Of a group's nodes that a pair has reached, the smallest counts, and for those that share its before the smallest of another.
    """
    at = ["a_key", "b_key", "tier", "group"]
    reached = open_.select("a_key", "b_key", "node").join(groups, "node").groupBy(*at, "before").agg(F.min("node").alias("src"))
    one = reached.groupBy(*at).agg(F.min(F.struct("src", "before")).alias("one"))
    two = reached.join(one, at).where(F.col("before") != F.col("one.before")).groupBy(*at).agg(F.min("src").alias("two"))
    on = one.join(two, at, "left").join(ties, ["tier", "group"]).drop("group").withColumnRenamed("to", "group").join(groups, ["tier", "group"])
    src = F.when(F.col("before") != F.col("one.before"), F.col("one.src")).otherwise(F.col("two"))
    return on.select("a_key", "b_key", "node", src.alias("src"), "tier").where("src IS NOT NULL AND src <> node")


def chains(edges: DataFrame, pairs: DataFrame, groups: DataFrame | None = None, ties: DataFrame | None = None) -> DataFrame:
    """(a_key, b_key, step, src, dst, tier): why each of pairs (a_key, b_key) is in one component, as the shortest chain
    of edges from a to b; of equal ones that whose nodes are smaller, seen from b. Pairs that nothing connects have no rows.

    A breadth-first search over edges from all pairs at once, a round for each step; a round's nodes are a table, and
    a pair that has met its end is not followed further. Each pair visits a node once at most.

    groups and ties, as in Resolved: edges besides, each node of a group to each of another before in those it is tied to;
    they are not written out. Stars among edges only repeat them.
    """
    both = edges.select("src", "dst", "tier").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "tier")).where("src <> dst")
    both = materialise(both.groupBy("src", "dst").agg(F.min("tier").alias("tier")), "links")
    if groups is not None:
        groups, ties = materialise(groups, "groups"), materialise(ties, "ties")
    none = [F.lit(None).cast("string").alias(c) for c in ("src", "tier")]
    layers = [materialise(pairs.select("a_key", "b_key").distinct().where("a_key <> b_key").select("a_key", "b_key", F.col("a_key").alias("node"), *none), "layer")]
    seen, open_ = layers[0], layers[0]
    while not open_.isEmpty():
        on = open_.select("a_key", "b_key", F.col("node").alias("src")).join(both, "src").select("a_key", "b_key", F.col("dst").alias("node"), "src", "tier")
        on = on if groups is None else on.unionByName(_over_groups(open_, groups, ties))
        on = on.groupBy("a_key", "b_key", "node").agg(F.min(F.struct("src", "tier")).alias("by")).select("a_key", "b_key", "node", "by.src", "by.tier")
        layers.append(materialise(on.join(seen, ["a_key", "b_key", "node"], "left_anti"), "layer"))
        met = layers[-1].where("node = b_key").select("a_key", "b_key")
        seen = seen.unionByName(layers[-1])
        open_ = layers[-1].join(met, ["a_key", "b_key"], "left_anti")
    at, out = None, None
    for step in range(len(layers) - 1, 0, -1):  # from the ends back, a layer at a time
        ends = layers[step].where("node = b_key").select("a_key", "b_key", "node")
        at = ends if at is None else ends.unionByName(at)
        found = materialise(at.join(layers[step], ["a_key", "b_key", "node"]).select("a_key", "b_key", F.lit(step).alias("step"), "src", F.col("node").alias("dst"), "tier"), "chain")
        out = found if out is None else out.unionByName(found)
        at = found.select("a_key", "b_key", F.col("src").alias("node"))
    return out if out is not None else layers[0].select("a_key", "b_key", F.lit(0).alias("step"), "src", F.col("node").alias("dst"), "tier").where("false")
