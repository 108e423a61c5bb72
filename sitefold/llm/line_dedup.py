"""Line deduplication by content-defined chunks of lines.

Lines with a word are hashed; those whose hash occurs more than once in the corpus form runs. A run is cut
into chunks in two ways: where a rolling hash over its own last two lines says so, which depends on content
alone, and where two neighbouring lines are not neighbours in every place of either, which depends on the
corpus and marks the ends of a passage. Rolling cuts alone would leave the lines between a passage's end and
its first or last cut in chunks of their own for each place, so these would stay; with both, a passage is cut
alike wherever it stands, whatever surrounds it. A chunk of one line counts as well, so that a passage that is
one long line is found.

Chunks of equal hash are compared byte by byte; of those that are equal the first, by smallest doc_id (null
last), text key and line, is the keeper and the others are repeats. Neighbouring repeated chunks form a
stretch; a stretch of MIN_WORDS words or more is removed, but for its keepers. Shorter ones (headings, licence
lines, greetings) stay: they are what clean documents share by nature. MIN_WORDS is a parameter; 1 removes all.

Each text is hashed once, into a table of one array for each document; texts move by document only, and bytes
of repeated chunks once, grouped by their value, so that a passage that very many documents hold collapses
before it moves. Counts and keepers are written tables, joined by joins that adaptive execution may split.

Null text stays null and empty text empty. An empty table gives an empty table. Rows equal in id and text share
one result, so repeated rows are all kept or all cut alike. Blank lines separate nothing and stay. A very long
text is one row, as in the input; its lines are compared in chunks. All input columns are kept; those named
n_lines_removed, n_words_removed or emptied are replaced, no other name clashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitefold.llm.common import documents, fresh, materialise, row_key, without, words

#: Words that a stretch of repeated chunks has at least to be removed, and lines of a chunk on average.
MIN_WORDS, CHUNK_LINES = 50, 8


def _numbered(text: Column) -> Column:
    """Lines with a word, each with its place among all lines."""
    every = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("line")))
    return F.filter(every, lambda x: x["line"].rlike("[^ \\t-\\r]"))


def line_hashes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, hs): the hashes of the lines with a word, one row for rows equal in id and text. A written table."""
    hashes = F.transform(_numbered(F.col(text)), lambda x: F.xxhash64(x["line"]))
    rows = docs.where(F.col(text).isNotNull()).select(row_key(key, text).alias("k"), hashes.alias("hs"))
    return materialise(rows.dropDuplicates(["k"]), "line-hashes")


def line_counts(hashed: DataFrame) -> DataFrame:
    """(h, one_p, one_q) of the lines that occur more than once: whether they always have the same line before and after."""
    beside = F.arrays_zip(F.col("hs").alias("h"), F.expr("slice(concat(array(0L), hs), 1, size(hs))").alias("p"), F.expr("concat(slice(hs, 2, size(hs)), array(0L))").alias("q"))
    lines = hashed.where("size(hs) > 0").select(F.inline_outer(beside).alias("h", "p", "q"))
    counts = lines.groupBy("h").agg(F.count(F.lit(1)).alias("c"), *[f(x).alias(f"{f.__name__}_{x}") for x in "pq" for f in (F.min, F.max)]).where("c > 1")
    return materialise(counts.select("h", F.expr("min_p = max_p").alias("one_p"), F.expr("min_q = max_q").alias("one_q")), "line-counts")


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", chunk_lines: int = CHUNK_LINES, hash_bits: int = 64) -> DataFrame:
    """(k, ch, j0, j1): chunks of repeated lines whose hash occurs more than once. j counts lines with a word."""
    hashed = line_hashes(docs, key, text)
    lines = hashed.select("k", F.posexplode_outer("hs").alias("j", "h"))
    here = Window.partitionBy("k").orderBy("j")
    rows = lines.join(line_counts(hashed), "h").repartition("k")
    follows = (F.lag("j").over(here) + 1 == F.col("j")) & F.lag("one_q").over(here) & F.col("one_p")
    rows = rows.withColumn("edge", ~F.coalesce(follows, F.lit(False)))
    rows = rows.select("k", "j", "h", "edge", F.lag("h").over(here).alias("h1"), F.when(~F.lag("edge").over(here), F.lag("h", 2).over(here)).alias("h2"))
    starts = F.col("edge") | (F.pmod(F.xxhash64("h2", "h1"), F.lit(chunk_lines)) == 0)
    rows = rows.withColumn("n", F.sum(starts.cast("int")).over(here))
    found = rows.groupBy("k", "n").agg(F.min("j").alias("j0"), F.max("j").alias("j1"), F.array_sort(F.collect_list(F.struct("j", "h"))).alias("hs"))
    found = found.select("k", "j0", "j1", F.shiftrightunsigned(F.xxhash64(F.transform("hs", lambda x: x["h"])), 64 - hash_bits).alias("ch"))
    twice = materialise(found.groupBy("ch").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("ch"), "chunk-hashes")
    return found.join(twice, "ch", "left_semi")


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, chunk_lines: int = CHUNK_LINES, hash_bits: int = 64) -> DataFrame:
    """(k, cut, n_lines, n_words): for each document with removed lines, the ranges [i0, i1] of places among all
    lines whose lines with a word go."""
    per_doc = chunks(docs, key, text, chunk_lines, hash_bits).groupBy("k").agg(F.collect_list(F.struct("j0", "j1", "ch")).alias("cs"))
    held = docs.where(F.col(text).isNotNull()).select(row_key(key, text).alias("k"), F.col(key).alias("id"), F.col(text).alias("text"))
    held = held.join(per_doc, "k").select("k", "id", _numbered(F.col("text")).alias("lines"), "cs").select("k", "id", "lines", F.explode("cs").alias("c"))
    held = held.select("k", "id", "c.*", F.slice("lines", F.col("c.j0") + 1, F.col("c.j1") - F.col("c.j0") + 1).alias("part"))
    found = held.select(
        "k", "ch", "j0", "j1", F.struct(F.col("id").isNull().alias("no"), "id", F.col("k").alias("at"), F.col("j0").alias("line")).alias("place"),
        F.get("part", F.lit(0))["i"].alias("i0"), F.element_at("part", -1)["i"].alias("i1"), F.array_join(F.transform("part", lambda x: x["line"]), "\n").alias("bytes"),
    )
    found = materialise(found, "line-chunks")
    # The comparison of bytes: a group is one value. Its words are counted once.
    equal = found.groupBy("ch", "bytes").agg(F.min("place").alias("keeper"), F.max("place").alias("last"))
    equal = materialise(equal.select("ch", "keeper", (F.col("keeper") != F.col("last")).alias("again"), F.size(words(F.col("bytes"))).alias("w"), "bytes"), "chunk-values")
    values = equal.groupBy("ch").agg(F.count(F.lit(1)).alias("values"), F.min(F.struct("keeper", "again", "w")).alias("v"))
    values = materialise(values.select("ch", "values", "v.*"), "chunk-keepers")
    known = found.drop("bytes").join(values.where("values = 1").drop("values"), "ch")
    clash = values.where("values > 1").select("ch")  # hashes that stand for several values, hardly ever any
    if not clash.isEmpty():
        known = known.unionByName(found.join(clash, "ch", "left_semi").join(equal, ["ch", "bytes"]).select(known.columns))
    known = known.where("again").select("k", "j0", "j1", "i0", "i1", "w", (F.col("place") == F.col("keeper")).alias("first")).dropDuplicates(["k", "j0"])
    here = Window.partitionBy("k").orderBy("j0")
    known = known.withColumn("gap", ~(F.lag("j1").over(here) + 1).eqNullSafe(F.col("j0")))
    known = known.withColumn("s", F.sum(F.col("gap").cast("int")).over(here))
    known = known.withColumn("all", F.sum("w").over(Window.partitionBy("k", "s")))
    gone = known.where((F.col("all") >= min_words) & ~F.col("first"))
    return gone.groupBy("k").agg(F.collect_list(F.struct("i0", "i1")).alias("cut"), F.sum(F.expr("j1 - j0 + 1")).alias("n_lines"), F.sum("w").alias("n_words"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, chunk_lines: int = CHUNK_LINES, hash_bits: int = 64) -> DataFrame:
    """The input with text cut, and n_lines_removed, n_words_removed and emptied (nothing but blank is left)."""
    k, k2, cut, n_lines, n_words = fresh(docs.columns, "_k", "_k2", "_cut", "_lines", "_words")
    gone = repeats(docs, key, text, min_words, chunk_lines, hash_bits).withColumnsRenamed({"k": k2, "cut": cut, "n_lines": n_lines, "n_words": n_words})
    rows = docs.withColumn(k, row_key(key, text)).join(gone, F.col(k) == F.col(k2), "left")
    goes = lambda x, i: x.rlike("[^ \\t-\\r]") & F.exists(cut, lambda r: i.between(r["i0"], r["i1"]))
    left = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda x, i: ~goes(x, i)), "\n")
    own = without(docs.columns, "n_lines_removed", "n_words_removed", "emptied")
    rows = rows.withColumn(text, F.when(F.col(cut).isNull(), F.col(text)).otherwise(left))
    return rows.select(
        *own,
        F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines_removed"),
        F.coalesce(n_words, F.lit(0)).cast("long").alias("n_words_removed"),
        (F.col(cut).isNotNull() & ~F.col(text).rlike("[^ \\t-\\r]")).alias("emptied"),
    )


def op3(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
