"""What is published: filters, facet counts, dictionaries, coded payloads and files."""

from __future__ import annotations

import gzip
import html
import json
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitefold.functions.geo import fixed_point, mercator
from sitefold.functions.text import lookup
from sitefold.operators.ranking import ranked
from sitefold.plans.page import HEAD, SCRIPT, TAIL
from sitefold.plans.shared import materialise, new_dir, release
from sitefold.vocabulary import ACTIVITY_FATES, ACTIVITY_LABELS, EXCLUDED_ACTIVITIES, EXCLUDED_SPECIES, OVERLAY_PRECISE, SPECIES

#: Facilities up to which build() writes one page; beyond it the coded tables are the payload.
MOST_IN_PAGE = 2_000_000


def _list(values) -> Column:
    return F.array(*map(F.lit, values))


def is_excluded() -> Column:
    """All activities are of the excluded kinds, there are some, and no animals are known to be killed."""
    acts = F.col("activities")
    return (F.size(acts) > 0) & (F.size(F.array_except(acts, _list(EXCLUDED_ACTIVITIES))) == 0) & ~F.coalesce(F.col("slaughter"), F.lit(False))


def drop_excluded(facilities: DataFrame) -> DataFrame:
    return facilities.where(~is_excluded())


def dot_key(species: Column) -> Column:
    """One species for a dot: the higher-ranking of two, _mixed for more, _unstated for none."""
    known = F.array_intersect(_list(SPECIES), species)
    return F.when(F.size(known) == 0, "_unstated").when(F.size(known) > 2, "_mixed").otherwise(F.get(known, F.lit(0)))


def fate(activity: Column) -> Column:
    """Whether and where animals at a place of this activity are killed; null if the activity says nothing."""
    return lookup(activity, ACTIVITY_FATES)


def activity_label(activity: Column) -> Column:
    """An activity in words; a code without a name of its own is written out, an absent one is not stated."""
    words = F.regexp_replace(activity, "_", " ")
    written = F.concat(F.upper(F.substring(words, 1, 1)), F.substring(words, 2, 100))
    return F.coalesce(lookup(activity, ACTIVITY_LABELS), written, F.lit(ACTIVITY_LABELS["unknown"]))


def slaughter_code(c: Column) -> Column:
    return F.when(c, 1).when(~c, 0).otherwise(2)


def facet_rows(facilities: DataFrame) -> DataFrame:
    """(uid, facet, value): one row for each distinct value a facility has; '_none' for an empty list."""
    some = lambda c: F.when(F.size(c) == 0, F.array(F.lit("_none"))).otherwise(F.array_distinct(c))
    acts = F.array_except("activities", _list(EXCLUDED_ACTIVITIES))
    kinds = {
        "species": some(F.col("species")), "activity": acts, "slaughter": F.array(slaughter_code(F.col("slaughter")).cast("string")),
        "source": F.array_distinct(F.transform("members", lambda m: m["source"])),
    }
    return facilities.select("uid", F.explode(F.array(*[F.struct(F.lit(k).alias("facet"), v.alias("vs")) for k, v in kinds.items()])).alias("f")).select("uid", "f.facet", F.explode("f.vs").alias("value"))


def shares(facilities: DataFrame) -> DataFrame:
    """(facet, value, n, percent of all facilities, one decimal)."""
    total = facilities.agg(F.count(F.lit(1)).alias("_all"))
    n = facet_rows(facilities).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))
    return n.join(F.broadcast(total)).select("facet", "value", "n", F.round(100 * F.col("n") / F.col("_all"), 1).alias("percent"))


def facet_filter(species=None, activities=None, slaughter=None, sources=None) -> Column:
    """Any of a facet's values, all of the facets; '_none' stands for an empty list."""

    def one(c: Column, values) -> Column:
        hit = F.arrays_overlap(c, _list(values))
        return (hit | (F.size(c) == 0)) if "_none" in values else hit

    out = F.lit(True)
    if species is not None:
        out &= one(F.col("species"), species)
    if activities is not None:
        out &= one(F.col("activities"), activities)
    if slaughter is not None:
        out &= slaughter_code(F.col("slaughter")).isin(*slaughter)
    if sources is not None:
        out &= one(F.transform("members", lambda m: m["source"]), sources)
    return out


def tallies(facilities: DataFrame, visible: Column) -> DataFrame:
    """Facet counts over visible rows, without the species that tallies leave out."""
    return facet_rows(facilities.where(visible)).where(~((F.col("facet") == "species") & F.col("value").isin(*EXCLUDED_SPECIES))).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def inside(x: Column, y: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    return x.between(x0, x1) & y.between(y0, y1)


def in_viewport(x0: float, y0: float, x1: float, y1: float) -> Column:
    return inside(*mercator(F.col("lat"), F.col("lon")), x0, y0, x1, y1)


def nearest(facilities: DataFrame, x: float, y: float, reach: float, n: int = 40) -> DataFrame:
    """The n facilities nearest to a point of the unit square, within reach."""
    px, py = mercator(F.col("lat"), F.col("lon"))
    d = (px - x) * (px - x) + (py - y) * (py - y)
    return facilities.withColumn("d2", d).where(F.col("d2") <= reach * reach).orderBy("d2", "uid").limit(n)


def unlocated(facilities: DataFrame, n: int | None = None) -> DataFrame:
    out = facilities.where("lat IS NULL").groupBy("country_iso3").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "country_iso3")
    return out.limit(n) if n else out


def shaded(counts: DataFrame) -> DataFrame:
    """Adds alpha, .12 + .5 * sqrt(n / largest), for shading countries by their unlocated facilities."""
    return counts.withColumn("alpha", 0.12 + 0.5 * F.sqrt(F.col("n") / F.max("n").over(Window.partitionBy())))


def with_laws(shapes: DataFrame, laws: DataFrame, area: str = "iso3") -> DataFrame:
    return shapes.join(F.broadcast(laws), shapes[area] == laws["area"], "left")


def top(df: DataFrame, column: str, n: int, order: str = "seq") -> DataFrame:
    """Most common values, those seen first before others of the same number."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("_first")).orderBy(F.desc("n"), "_first").limit(n).drop("_first")


def dictionary(df: DataFrame, value: Column | str, order: str) -> DataFrame:
    """(value, id): ids from 0 in order of first appearance, numbered in ranges."""
    v = F.col(value) if isinstance(value, str) else value
    firsts = df.groupBy(v.alias("value")).agg(F.min(order).alias("_first"))
    return ranked(firsts, "_first", "value").select("value", F.col("id").cast("int").alias("id"))


#: Values of a dictionary up to which it is broadcast to the rows that it codes.
FEW_VALUES = 100_000


def encode(facilities: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(coded rows, dictionaries): fixed-point positions and dictionary ids in place of text and lists."""
    combo = lambda c: F.concat_ws(",", F.array_sort(F.array_distinct(c)))
    parts = {
        "country": F.coalesce("country_iso3", F.lit("")), "species": combo(F.col("species")), "activities": combo(F.col("activities")),
        "sources": combo(F.transform("members", lambda m: m["source"])), "tiers": combo(F.col("match_tiers")), "palette": dot_key(F.col("species")),
    }
    rows = facilities.withColumns({f"_{k}": v for k, v in parts.items()})
    dims = {k: dictionary(rows, f"_{k}", "uid") for k in parts}
    for k, dim in dims.items():
        ids = dim.select(F.col("value").alias(f"_{k}"), F.col("id").alias(k + "_id"))
        rows = rows.join(F.broadcast(ids) if dim.count() <= FEW_VALUES else ids, f"_{k}")
    member = lambda m: F.concat_ws("|", F.coalesce(m["source"], F.lit("")), F.coalesce(m["id_scheme"], F.lit("")), F.coalesce(m["national_id"], F.lit("")))
    coded = rows.select(
        "uid", "name", fixed_point(F.col("lat")).alias("y"), fixed_point(F.col("lon")).alias("x"), slaughter_code(F.col("slaughter")).alias("slaughter"), "review", "geo_precision",
        *[k + "_id" for k in parts], F.transform("members", member).alias("ids"),
    )
    return coded, dims


def latest_points(features: DataFrame) -> DataFrame:
    """Monthly snapshots of point features folded to their latest period; of equals the first stays.

    features: (lon, lat, name, definition, period, seq, ...). Points are the same at five places and up to the
    name's last underscore.
    """
    rows = features.where((F.col("definition").isNull()) | (F.col("definition") == "confined-animal-facility")).where("lon IS NOT NULL AND lat IS NOT NULL")
    keys = [F.round("lon", 5).alias("_x"), F.round("lat", 5).alias("_y"), F.regexp_replace(F.coalesce("name", F.lit("")), "_[^_]*$", "").alias("stem")]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct("*"), F.struct(F.coalesce("period", F.lit("")).alias("p"), (-F.col("seq")).alias("s"))).alias("r"), F.min("seq").alias("first_seq"))
    return latest.select("stem", "r.*", "first_seq")


def encode_overlay(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(coded points, kinds): points as from load_cafo with positions at four places and kind, the stem's id in order of
    first appearance; kinds is (value, id)."""
    kinds = dictionary(points, "stem", "first_seq")
    ids = kinds.select(F.col("value").alias("stem"), F.col("id").alias("kind"))
    coded = points.join(F.broadcast(ids) if kinds.count() <= FEW_VALUES else ids, "stem")
    return coded.select(F.bround("lat", 4).alias("lat"), F.bround("lon", 4).alias("lon"), "kind", F.col("precise").cast("int").alias("precise"), "period"), kinds


# The fields of the modelled-facility overlay's features.
CAFO = "type string, geometry struct<type:string,coordinates:array<double>>, properties struct<name:string,x_asset_definition:string,x_period:string,x_capacity:double,x_capacity_units:string,x_precision:string,x_owner:string>"


def load_cafo(spark, path) -> DataFrame:
    """The overlay from feature lines (plain or gzip) or a collection, folded to the latest period."""
    lines = spark.read.option("mode", "DROPMALFORMED").schema(CAFO + f", features array<struct<{_nested(CAFO)}>>").json(path)
    one = lines.where("features IS NULL").select("geometry", "properties").unionByName(lines.where("features IS NOT NULL").select(F.explode("features").alias("f")).select("f.geometry", "f.properties"))
    one = one.where("geometry.type = 'Point'").withColumn("seq", F.monotonically_increasing_id())
    flat = one.select(F.get("geometry.coordinates", F.lit(0)).alias("lon"), F.get("geometry.coordinates", F.lit(1)).alias("lat"), F.col("properties.name").alias("name"), F.col("properties.x_asset_definition").alias("definition"), F.col("properties.x_period").alias("period"), F.col("properties.x_capacity").alias("capacity"), F.col("properties.x_capacity_units").alias("units"), F.col("properties.x_owner").alias("owner"), F.coalesce(F.lower("properties.x_precision").isin(OVERLAY_PRECISE), F.lit(False)).alias("precise"), "seq")
    return latest_points(flat)


def _nested(ddl: str) -> str:
    return "type:string,geometry:struct<type:string,coordinates:array<double>>,properties:" + ddl.split("properties ")[1]


def write_json(facilities: DataFrame, path: str) -> None:
    """Gzip JSON lines, one file for each task."""
    facilities.write.mode("overwrite").option("compression", "gzip").json(path)


def write_json_array(facilities: DataFrame, path: str) -> None:
    """All facilities by uid as one JSON array in one gzip file.

    Tasks write the array's pieces, each a gzip member whose lines carry their commas; members laid end to end are one
    gzip file. They are joined by the file system where it can (concat), else their bytes are copied as they are: no row
    is read or parsed outside the tasks. The file takes its name when it is whole.
    """
    spark = facilities.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    pieces = new_dir(spark, "array")
    line = F.to_json(F.struct(*facilities.columns), {"ignoreNullFields": "false"})
    rows = materialise(facilities.select("uid", line.alias("line")), "lines")
    first = rows.agg(F.min("uid").alias("_first"))
    lines = rows.join(F.broadcast(first)).orderBy("uid").select(F.when(F.col("uid") == F.col("_first"), F.col("line")).otherwise(F.concat(F.lit(","), "line")).alias("value"))
    lines.write.option("compression", "gzip").text(pieces)
    at = lambda name: jvm.org.apache.hadoop.fs.Path(name)
    source, target = at(pieces).getFileSystem(conf), at(path).getFileSystem(conf)
    members = sorted(s.getPath().toString() for s in source.listStatus(at(pieces)) if s.getPath().getName().startswith("part-"))
    made = f"{path}.{uuid.uuid4().hex}"

    def put(name: str, data: bytes) -> None:
        out = target.create(at(name))
        out.write(bytearray(data))
        out.close()

    put(made, gzip.compress(b"[\n"))
    put(f"{made}.end", gzip.compress(b"]\n"))
    members.append(f"{made}.end")
    if target.hasPathCapability(at(made), "fs.capability.paths.concat") and source.getUri().equals(target.getUri()):
        paths = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(members))
        for k, m in enumerate(members):
            paths[k] = at(m)
        target.concat(at(made), paths)
    else:
        whole = f"{made}.whole"
        out = target.create(at(whole))
        for m in [made, *members]:
            piece = at(m).getFileSystem(conf).open(at(m))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(piece, out, 1 << 20, False)
            piece.close()
        out.close()
        target.delete(at(made), False)
        target.delete(at(f"{made}.end"), False)
        made = whole
    target.delete(at(path), False)
    if not target.rename(at(made), at(path)):
        raise OSError(f"{made} can't be named {path}")
    release(rows)
    source.delete(at(pieces), True)


def write_review(queue: DataFrame, path: str) -> None:
    queue.write.mode("overwrite").option("header", True).csv(path)


def write_report(report: DataFrame, path: str) -> str:
    """The report's few rows as markdown; returns the text."""
    rows = report.collect()
    out = ["# Resolution report", ""]
    for section in ("total", "source", "tier", "size"):
        out += [f"## {section}", "", "| item | n |", "|---|---|"]
        mine = [r for r in rows if r.section == section]
        out += [f"| {r.item} | {r.n} |" for r in sorted(mine, key=lambda r: (int(r.item) if section == "size" else -r.n, r.item))] + [""]
    text = "\n".join(out)
    Path(path).write_text(text, encoding="utf-8")
    return text


def payload(facilities: DataFrame) -> Iterator[str]:
    """The page's data as pieces of JSON text, a facility at a time: rows in coded form, dictionaries and shares."""
    coded, dims = encode(facilities)
    text = lambda x: json.dumps(x, ensure_ascii=False, separators=(",", ":")).replace("</", "<\\/")
    yield '{"rows":['
    for n, r in enumerate(coded.orderBy("uid").toLocalIterator(prefetchPartitions=True)):
        yield ("," if n else "") + text(r.asDict(True))
    named = {k: [r.value for r in d.orderBy("id").collect()] for k, d in dims.items()}
    yield f'],"dictionaries":{text(named)},"shares":{text([r.asDict() for r in shares(facilities).collect()])}}}'


def build(facilities: DataFrame, out: str, title: str = "Facilities", subtitle: str = "", keep_excluded: bool = False, inline: bool = False) -> dict:
    """The page, its payload (plain and gzip) beside it or inside it, and a report. The payload is one client's
    download, so it is streamed through the driver, a facility at a time, up to MOST_IN_PAGE facilities."""
    kept = facilities if keep_excluded else drop_excluded(facilities)
    n = kept.count()
    if n > MOST_IN_PAGE:
        raise ValueError(f"{n} facilities are more than one page holds; publish encode()'s tables instead")
    page, size = Path(out), 0
    head = HEAD.replace("@title", html.escape(title)).replace("@subtitle", html.escape(subtitle))
    with page.open("w", encoding="utf-8") as f:
        f.write(head + SCRIPT)
        if inline:
            f.write("show(")
            for x in payload(kept):
                size += f.write(x)
            f.write(");")
        else:
            data = page.with_suffix(".data.json")
            with data.open("wb") as plain, gzip.GzipFile(f"{data}.gz", "wb", mtime=0) as packed:
                for x in payload(kept):
                    size += plain.write(x.encode())
                    packed.write(x.encode())
            f.write(f"fetch({json.dumps(data.name)}).then(r => r.json()).then(show);")
        f.write(TAIL)
    return {"facilities": n, "bytes": size, "large": inline and size > 12_000_000, "countries": [tuple(r) for r in top(kept, "country_iso3", 25, "uid").collect()]}
