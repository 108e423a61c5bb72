"""Resolution kept up when one register is parsed again: only the components that a change can reach are opened and closed
again; the others, their tiers and their review pairs are taken over as they are. The result is that of resolve() over
all records as they are now.

What a change can reach, with changed standing for removed and added records (equal rows under equal keys are neither):
  components of removed records, and of those that share an identifier with a changed one (a star's centre may move);
  components of records that share address block and a word with an added one, or a cell two steps away and a word;
  components around a cell that was occupied and is not, or the other way round (cells are bridges for pairs);
  components that a reviewed merge, or a chain of them, ties to a changed record.
No merge leads from an opened component to one left closed, so opened records are resolved by themselves. Pairs for
review with one end outside are as before. Name groups have a size limit, so their pairs are made anew for each name of
an opened or changed record, from all records of that name.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from sitefold.operators import resolve as r
from sitefold.operators.components import components
from sitefold.plans.shared import materialise


class Kept(NamedTuple):
    keyed: DataFrame
    tiers: DataFrame
    queue: DataFrame
    #: (key, state): 'removed', 'added' or, in an opened component, 'opened'.
    touched: DataFrame
    #: Members of classes, where the queue is one of first records.
    classes: DataFrame | None = None


def _digest(rows: DataFrame) -> DataFrame:
    columns = sorted(c for c in rows.columns if c != "component")
    return rows.withColumn("_digest", F.sha2(F.to_json(F.struct(*columns)), 256))


def _words(rows: DataFrame) -> DataFrame:
    """(country, block, w) of rows with a block."""
    return rows.select("country", "block", F.explode("words").alias("w")).distinct()


def _opened(kept: DataFrame, removed: DataFrame, added: DataFrame, decisions: DataFrame | None) -> DataFrame:
    """(component) of all that a change can reach; the three are prepared rows, the first two with their component."""
    columns = [c for c in kept.columns if c != "component"]
    changed = removed.select(*columns).unionByName(added.select(*columns))
    ids = changed.select("country", F.explode("ids").alias("id")).distinct()
    reached = [removed.select("component"), kept.select("component", "country", F.explode("ids").alias("id")).join(ids, ["country", "id"], "left_semi").select("component")]
    new = r.in_cells(added).select("country", "words", F.explode(r.around(F.col("block"), 2)).alias("block"))
    for old, words in ((r.at_address(kept), _words(r.at_address(added))), (r.in_cells(kept), _words(new))):
        reached.append(old.select("component", "country", "block", F.explode("words").alias("w")).join(words, ["country", "block", "w"], "left_semi").select("component"))
    cells = lambda rows: r.in_cells(rows).select("country", "block").distinct()
    gone, come = cells(removed), cells(added)
    turned = gone.exceptAll(come).unionByName(come.exceptAll(gone)).join(cells(kept), ["country", "block"], "left_anti")
    beside = turned.select("country", F.explode(r.around(F.col("block"))).alias("block")).distinct()
    reached.append(r.in_cells(kept).join(beside, ["country", "block"], "left_semi").select("component"))
    if decisions is not None:
        tied = materialise(components(r.merge_edges(decisions), small=r.FEW_LINKS), "decided")
        groups = tied.join(changed.select(F.col("key").alias("node")), "node", "left_semi").select("component").distinct()
        nodes = tied.join(groups, "component", "left_semi").select(F.col("node").alias("key"))
        reached.append(kept.join(nodes, "key", "left_semi").select("component"))
    every = reached[0]
    for x in reached[1:]:
        every = every.unionByName(x)
    return materialise(every.distinct(), "opened")


def replace_source(keyed: DataFrame, tiers: DataFrame, queue: DataFrame, records: DataFrame, source: str, hits: DataFrame | None = None, decisions: DataFrame | None = None, classes: DataFrame | None = None) -> Kept:
    """keyed, tiers, queue: as resolve() gave them, in tables; records: the source's rows as they are now (none to take it away).
    With classes, queue has pairs of first records, both as in resolve.Resolved (pairs, classes); the result's are of that form.

    hits are the new rows' own; those of other rows, and decisions, must be as before. A row whose seq alone has changed counts
    as changed, for order of appearance chooses names and addresses.
    """
    mine = F.col("source_id").eqNullSafe(source)
    new = _digest(r.with_hits(r.with_keys(records.where(mine)), hits))
    old = _digest(keyed.where(mine))
    same = materialise(new.select("key", "_digest").join(old.select("key", "_digest"), ["key", "_digest"]).select("key"), "same")
    added = materialise(new.drop("_digest").join(same, "key", "left_anti"), "added")
    removed = materialise(old.drop("_digest").join(same, "key", "left_anti"), "removed")
    kept = keyed.join(removed.select("key"), "key", "left_anti")
    rows_kept = materialise(r.prepared(kept, "component"), "prepared-kept")
    rows_removed, rows_added = r.prepared(removed, "component"), materialise(r.prepared(added), "prepared-added")
    opened = _opened(rows_kept, rows_removed, rows_added, decisions)

    again = kept.join(opened, "component", "left_semi").drop("component")
    some = materialise(again.unionByName(added), "opened-records")
    rows_some = rows_kept.join(opened, "component", "left_semi").drop("component").unionByName(rows_added)
    occupied = r.in_cells(rows_kept).select("country", "block").unionByName(r.in_cells(rows_added).select("country", "block")).distinct()
    mates = None
    if decisions is not None:  # a split can part a star's centre from its records
        ids = rows_some.select("country", F.explode("ids").alias("id")).distinct()
        outside = rows_kept.join(opened, "component", "left_anti")
        near = outside.select("key", "country", F.explode("ids").alias("id")).join(ids, ["country", "id"], "left_semi").select("key").distinct()
        mates = outside.join(near, "key", "left_semi")
    again_resolved = r.resolve_keyed(some, decisions, occupied, mates)
    closed, closed_tiers = materialise(again_resolved.keyed, "closed"), again_resolved.tiers
    closed_queue = again_resolved.queue if classes is None else again_resolved.pairs

    now = materialise(kept.join(opened, "component", "left_anti").unionByName(closed).select(*keyed.columns), "kept-up")
    now_tiers = tiers.join(opened, "component", "left_anti").unionByName(closed_tiers.join(closed.select("component").distinct(), "component", "left_semi")).distinct()

    rows_now = rows_kept.drop("component").unionByName(rows_added)
    names = r.unplaced(rows_some).select("country", "block").unionByName(r.unplaced(rows_removed).select("country", "block")).distinct()
    unplaced = materialise(r.unplaced(rows_now).join(names, ["country", "block"], "left_semi"), "names")
    joined = now.join(unplaced.select("key"), "key", "left_semi").select(F.col("key").alias("node"), "component")
    by_name = r.apart(r.name_pairs(unplaced.drop("block")).select(F.lit("name").alias("tier"), *r.PAIR), joined).select("tier", *r.PAIR)
    by_name = r.described(by_name, unplaced, decisions) if classes is None else r.not_split(by_name, decisions)

    touched = removed.select("key", F.lit("removed").alias("state")).unionByName(again.select("key", F.lit("opened").alias("state"))).unionByName(added.select("key", F.lit("added").alias("state")))
    touched = materialise(touched, "touched")
    before = touched.where("state <> 'added'")
    old_queue, now_classes = queue, None
    if classes is not None:  # where a class's first record is removed, the first of those left stands for them
        left = classes.join(removed.select("key"), "key", "left_anti").groupBy("tier", "rep").agg(F.min(F.struct("seq", "key")).alias("_first"))
        for s in "ab":
            old_queue = old_queue.join(left.withColumnRenamed("rep", f"{s}_key"), ["tier", f"{s}_key"], "left")
            old_queue = old_queue.withColumns({f"{s}_key": F.coalesce("_first.key", f"{s}_key"), f"{s}_seq": F.coalesce("_first.seq", f"{s}_seq")}).drop("_first")
        now_classes = materialise(classes.join(before.select("key"), "key", "left_anti").unionByName(again_resolved.classes), "classes")
    for s in "ab":
        old_queue = old_queue.join(before.toDF(f"{s}_key", f"_{s}"), f"{s}_key", "left")
    is_name = F.col("reason") == r.NAME_REASON
    old_queue = old_queue.where("coalesce(_a, '') <> 'removed' AND coalesce(_b, '') <> 'removed' AND NOT (coalesce(_a, '') = 'opened' AND coalesce(_b, '') = 'opened')").select(*queue.columns)
    renamed = unplaced.select(F.col("key").alias("a_key"))
    old_queue = old_queue.where(~is_name).unionByName(old_queue.where(is_name).join(renamed, "a_key", "left_anti"))
    return Kept(now, now_tiers, materialise(old_queue.unionByName(closed_queue.where(~is_name)).unionByName(by_name).select(*queue.columns), "queue"), touched, now_classes)
