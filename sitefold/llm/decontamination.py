"""Benchmark decontamination by spaced-seed hashing.

A mask is a string of 1 and 0; a stretch of tokens is hashed over the positions marked 1, so a changed
token at a position marked 0 does not matter. Hashes of the training text are joined with those of the
benchmark, and each hit is verified along its diagonal: item and document are laid over each other at
the hit's offset, and around each window of WINDOW tokens whose surroundings hold the hit, equal tokens
are counted over the window and AROUND tokens on either side, cut to item and document. An item is
leaked if MIN_SHARE of them are equal in one of these places, so passages with changed words, and parts
of items, are found, and single shared phrases are not.

The masks are such that any place that verification admits holds a hit: of e equal tokens within n, every
second one from the first on leaves gaps whose mean is under 4 for each n from 7 to 23 but 10, so three
lie within 4 tokens, which the masks take in every way. Of 10 tokens one pattern is left, and TEN finds it.

The benchmark side is broadcast only while its measured size is under a bound; beyond it Spark joins by
shuffle. Hits are verified where they are found, from token hashes that are at hand, so no text moves
and a passage that very many documents share gathers nowhere.

Tokens are runs of letters and digits, lower-cased. Null and empty texts have no tokens and are clean;
items shorter than a window are laid over the document whole: MIN_SHARE of their tokens must be equal, and as
many as the fewest in a longer item (6); of up to 6 tokens all. Items of fewer than `least` tokens, a parameter
that is 1 by default, are passed over: a benchmark of single words would else find them everywhere. Repeated rows
are judged alike. An empty table gives an empty table, an empty benchmark leaks nothing. A long text is one row
whose windows are made and tested in place. Extra columns are kept; those named items, n_equal or leaked are
replaced, no other name clashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from sitefold.llm.common import documents, fresh, without

#: All of weight 3 within 4 tokens, and one more for items of 10 tokens.
MASKS, TEN = ("111", "1101", "1011"), "11001"
#: Tokens of a window, those on either side that are compared, the share of them that must be equal, and the fewest compared.
WINDOW, AROUND, MIN_SHARE, MIN_OVERLAP = 11, 6, 0.6, 10
#: Tokens on either side of a hit that some place around it may compare.
REACH = WINDOW + 2 * AROUND - 1
#: Bytes of benchmark text up to which its hashes are broadcast.
MOST_BROADCAST = 8 << 20


def with_tokens(df: DataFrame, text: str) -> DataFrame:
    """Adds t, the hashes of the tokens; named in two steps so that the text is folded once."""
    df = df.withColumn("_bare", F.btrim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^\\p{L}\\p{N}]+", " ")))
    none = F.array().cast("array<bigint>")
    return df.withColumn("t", F.when(F.col("_bare") == "", none).otherwise(F.transform(F.split("_bare", " "), lambda w: F.xxhash64(w)))).drop("_bare")


def _seeds(rows: DataFrame, masks: tuple[str, ...], keep: list[str]) -> DataFrame:
    """rows with tokens t, to one row for each place and mask: keep, t, at, seed. A mask that ends beyond t has no seed.

    Seeds are computed after the positions are dealt out, inside generated code. The outer form of
    explode keeps the optimiser from testing the tokens' number below the place where they are made.
    """
    span = min(map(len, masks))
    places = F.when(F.size("t") >= span, F.sequence(F.lit(0), F.size("t") - span))
    tokens = lambda m: [F.get("t", F.col("at") + F.lit(p)) for p, c in enumerate(m) if c == "1"]
    seed = lambda k, m: F.when(tokens(m)[-1].isNotNull(), F.xxhash64(F.lit(k), *tokens(m)))
    rows = rows.select(*keep, "t", F.explode_outer(places).alias("at"))
    return rows.select(*keep, "t", "at", F.explode(F.array(*[seed(k, m) for k, m in enumerate(masks)])).alias("seed"))


def _fullest(min_share: float, min_overlap: int) -> Column:
    """The most equal tokens of a place that verification admits, or null. From bits (REACH is the hit), lo and hi (the first and
    last bit that both item and document have), and n, the item's tokens."""
    bit, lo, hi, n = F.col("bits"), F.col("lo"), F.col("hi"), F.col("n")
    at = []
    for w in range(REACH - WINDOW - AROUND + 1, REACH + AROUND + 1):
        first, last = w - AROUND, w + WINDOW + AROUND - 1
        size = F.least(F.lit(last), hi) - F.greatest(F.lit(first), lo) + 1
        equal = F.bit_count(bit.bitwiseAND(F.lit((1 << last + 1) - (1 << first))))
        at.append(F.when((lo <= w) & (hi >= w + WINDOW - 1) & (size >= min_overlap) & (equal >= min_share * size), equal))
    fewest = math.ceil(min_share * min_overlap)
    whole = F.when((hi - lo + 1 == n) & (F.bit_count(bit) >= F.least(n, F.greatest(F.lit(fewest), min_share * n))), F.bit_count(bit))
    return F.when(n < WINDOW, whole).otherwise(F.greatest(*at))


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", masks=MASKS, min_share: float = MIN_SHARE, min_overlap: int = MIN_OVERLAP, least: int = 1) -> DataFrame:
    """(doc, k, item, n_equal): verified overlaps, the fullest of each document (id and text hash) and item."""
    items = with_tokens(benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("_text")), "_text").where(F.size("t") >= max(least, 1)).select("item", "t")
    bound = benchmark.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    small = bound <= MOST_BROADCAST
    dealt = F.broadcast if small else (lambda df: df)
    rows = with_tokens(docs.select(F.col(key).alias("doc"), F.col(text).alias("_text")), "_text").select("doc", F.xxhash64("_text").alias("k"), "t")
    # Bit REACH + i is set if the tokens i places from the hit are equal.
    bits = F.expr(f"aggregate(sequence(0, least(size(mine), size(theirs)) - 1), 0L, (b, i) -> b | if(mine[i] = theirs[i], shiftleft(1L, i + {REACH} - near), 0L))")

    def found(mine: DataFrame, theirs: DataFrame) -> DataFrame:
        if not small:  # what is shuffled carries the tokens around the hit alone
            near = F.least("at", F.lit(REACH))
            mine = mine.select("doc", "k", "seed", F.slice("t", F.col("at") - near + 1, near + REACH + 1).alias("t"), near.alias("at"))
        hits = mine.join(dealt(theirs.withColumnsRenamed({"t": "u", "at": "u_at"})), "seed")
        # A hit leaves the generated join with its surroundings only; the generators of one row keep the
        # comparison, which needs a lambda, from being pushed into the join and out of generated code, and
        # from being made anew for each place.
        near = F.least("at", "u_at", F.lit(REACH))
        around = lambda tokens, at: F.slice(F.col(tokens), F.col(at) - near + 1, near + REACH + 1)
        hits = hits.select("doc", "k", "item", F.inline(F.array(F.struct(around("t", "at").alias("mine"), around("u", "u_at").alias("theirs"), near.alias("near"), F.size("u").alias("n")))))
        lo = REACH - F.col("near")
        hits = hits.select("doc", "k", "item", F.inline(F.array(F.struct(bits.alias("bits"), lo.alias("lo"), (lo + F.least(F.size("mine"), F.size("theirs")) - 1).alias("hi"), "n"))))
        return hits.select("doc", "k", "item", _fullest(min_share, min_overlap).alias("n_equal")).where("n_equal IS NOT NULL")

    span = min(map(len, masks))
    out = found(_seeds(rows, masks, ["doc", "k"]), _seeds(items.where(F.size("t") >= span), masks, ["item"]).where("seed IS NOT NULL"))
    more = {10: TEN} | {n: "1" * n for n in range(1, span)}  # items too short for the masks, and those of 10 tokens
    for (n,) in items.select(F.size("t").alias("n")).where(F.col("n").isin(*more)).distinct().collect():
        theirs = _seeds(items.where(F.size("t") == n), (more[n],), ["item"]).where("seed IS NOT NULL")
        out = out.unionByName(found(_seeds(rows, (more[n],), ["doc", "k"]), theirs))
    return out.groupBy("doc", "k", "item").agg(F.max("n_equal").alias("n_equal"))


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, **how) -> DataFrame:
    """The input's rows with leaked, items (sorted ids of the leaked items) and n_equal (of the fullest overlap).

    keep: the input's columns that are wanted; without the text, ids and text hashes are joined alone.
    """
    doc, k, mine = fresh(docs.columns, "_doc", "_k", "_t")
    found = overlaps(docs, benchmark, key, text, **how).groupBy(F.col("doc").alias(doc), F.col("k").alias(k))
    found = found.agg(F.array_sort(F.collect_set("item")).alias("_items"), F.max("n_equal").alias("_n"))
    items, n = fresh(docs.columns, "_items", "_n")
    kind = dict(found.dtypes)["_items"]
    found = found.withColumnsRenamed({"_items": items, "_n": n})
    rows = docs.withColumn(mine, F.xxhash64(text)).join(found, F.col(key).eqNullSafe(F.col(doc)) & (F.col(mine) == F.col(k)), "left")
    added = [F.col(items).isNotNull().alias("leaked"), F.coalesce(items, F.array().cast(kind)).alias("items"), F.coalesce(n, F.lit(0)).cast("long").alias("n_equal")]
    return rows.select(*(keep or without(docs.columns, "items", "n_equal", "leaked")), *added)


def op4(spark, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])
