"""Mixing sources to target weights.

Token counts are summed per source, a target is set for each source by its weight, and every document
is emitted floor(rate) times plus one more copy with probability equal to the fraction of the rate.
The draw is a hash of the seed and the document's id, so reruns agree. Null text has size 0; null
sources form one source, ordered last; a source without words has rate 0; repeated rows draw alike.
An empty table gives an empty table; a long text is one row with a large size. Input columns named size,
source_size, target, copies or copy are replaced; no other name clashes.

The targets are a written table with one row for each source. Up to MOST_SOURCES rows, counted first, it
is broadcast, so that documents aren't shuffled; beyond that Spark joins by source, and adaptive execution
splits a hot one. The level is found in one task, over one row for each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitefold.llm.common import documents, fresh, materialise, without, words

SEED = "mix-1"
#: No source is asked for more than this many times its own words.
MOST = 3
#: Rows of targets up to which they are broadcast.
MOST_SOURCES = 50_000


def source_targets(sizes: DataFrame, source: str = "source", most: int = MOST) -> DataFrame:
    """sizes: one row (source, source_size) for each source. Adds weight and target.

    Targets share the total by weight; those above most * size stop there and the excess is shared
    again. That ends at the level where target = least(most * size, weight * level), which one pass
    over the sources ordered by most * size / weight finds. Windows here run over sources, not rows.
    """
    by_name = Window.orderBy(F.col(source).isNull(), F.col(source))
    t = sizes.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
    t = t.withColumn("_cap", F.lit(most) * F.col("source_size"))
    every = Window.partitionBy()
    ordered = Window.orderBy(F.col("_cap") / F.col("weight"), F.col(source).isNull(), F.col(source))
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    t = t.withColumn("_level", level)
    # The level counts where the first source that stays below its stop is reached; later ones take less away.
    free = F.when(F.col("_cap") / F.col("weight") >= F.col("_level"), F.struct(F.row_number().over(ordered).alias("n"), F.col("_level").alias("level")))
    t = t.withColumn("_free", free).withColumn("_level", F.coalesce(F.min("_free").over(every)["level"], F.lit(0.0)))
    target = F.least(F.col("_cap").cast("double"), F.col("weight") * F.col("_level"))
    return t.withColumn("target", target).drop("_cap", "_level", "_free")


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from 52 bits of a digest of seed and key."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED) -> DataFrame:
    """The input's rows with size, source_size, target and copies."""
    name, size, total, target = fresh(docs.columns, "_source", "_size", "_total", "_target")
    sized = docs.withColumn(size, F.size(words(F.col(text))).cast("long"))
    sizes = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    targets = materialise(source_targets(sizes).select(F.col("source").alias(name), F.col("source_size").alias(total), F.col("target").alias(target)), "targets")
    if targets.count() <= MOST_SOURCES:
        targets = F.broadcast(targets)
    rate = F.when(F.col(total) > 0, F.col(target) / F.col(total)).otherwise(F.lit(0.0))
    extra = F.when(draw(F.col(key), seed) < rate - F.floor(rate), F.lit(1)).otherwise(F.lit(0))
    copies = F.least(F.floor(rate) + extra, F.lit(MOST)).cast("long")
    rows = sized.join(targets, F.col(source).eqNullSafe(F.col(name)), "left")
    added = [F.col(size).alias("size"), F.col(total).alias("source_size"), F.col(target).alias("target"), copies.alias("copies")]
    return rows.select(*without(docs.columns, "size", "source_size", "target", "copies"), *added)


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as often as its copies say, with the copy's number."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))


def op8(spark, sf_dir: str) -> DataFrame:
    out = mix(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


#: With {docs} for a relation of doc_id, text and source; ends in a CTE named mixed.
MIX_SQL = rf"""
z AS (SELECT *, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\f\r]+'), lambda x: x <> ''))::BIGINT size FROM {{docs}}),
s AS (SELECT source, sum(size)::BIGINT source_size, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 weight FROM z GROUP BY source),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum({MOST} * source_size) OVER o, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) lv, row_number() OVER (ORDER BY ({MOST} * source_size)::DOUBLE / weight, source IS NULL, source) n FROM s
      WINDOW o AS (ORDER BY ({MOST} * source_size)::DOUBLE / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT coalesce(arg_min(lv, n) FILTER (WHERE ({MOST} * source_size)::DOUBLE / weight >= lv), 0) lv FROM l),
t AS (SELECT source, source_size, least(({MOST} * source_size)::DOUBLE, weight * v.lv) target FROM s, v),
r AS (SELECT z.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END rate,
        ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / {float(16**13)} u
      FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source),
mixed AS (SELECT *, least(floor(rate) + (u < rate - floor(rate))::INT, {MOST})::BIGINT copies FROM r)
"""

SQL = f"WITH {MIX_SQL.format(docs='documents')} SELECT doc_id, size, source_size, target, (copies * size)::BIGINT taken FROM mixed"
