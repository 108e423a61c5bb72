"""Scans: every cell is a string, and columns are known from the header only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sitefold.functions.text import HeaderError
from sitefold.plans.store import Table


def read_csv(spark: SparkSession, path, sep: str = ",") -> DataFrame:
    """Header, quoted line breaks, doubled quotes; a byte order mark is dropped. Adds file, the path of each row's file.

    Files are split by bytes as text, so that many tasks read one file. Whether a line begins inside a quoted cell follows
    from all lines before it; where no line leaves a cell open, each is a record by itself and nothing is shuffled.
    """
    columns = spark.read.options(header=True, multiLine=True, escape='"', sep=sep).csv(path).columns
    lines = _placed(spark.read.option("lineSep", "\n").text(path))
    head = (F.col(_BLOCK) == 0) & F.startswith("value", F.lit("\ufeff"))
    lines = lines.withColumn("value", F.when(head, F.substring("value", 2, 1 << 30)).otherwise(F.col("value")))
    if not lines.where(_left_open(F.col("value"), sep)).isEmpty():
        lines = _whole_records(lines, sep)
    lines = lines.withColumn("value", F.regexp_replace("value", r"\r$", "")).where("value <> ''")
    first = lines.where(F.col(_BLOCK) == 0).groupBy("file").agg(F.min(_ROW).alias("_head"))
    rows = lines.join(first, "file").where((F.col(_BLOCK) > 0) | (F.col(_ROW) > F.col("_head")))
    names = [f"c{k}" for k in range(len(columns))]
    parsed = rows.withColumn("_r", F.from_csv("value", ", ".join(f"{n} string" for n in names), {"sep": sep, "escape": '"'}))
    return parsed.select(*[F.col("_r")[n].alias(c) for n, c in zip(names, columns)], "file", _BLOCK, _ROW)


def _left_open(line: Column, sep: str) -> Column:
    """Whether a line that begins outside a quoted cell ends inside one: whole cells, then one that opens and isn't closed."""
    quoted, other = '"(?:[^"]++|"")*+', "\\x%02x" % ord(sep)
    return line.rlike(f'(?s)^(?:(?:{quoted}"[^{other}]*+|[^"{other}][^{other}]*+|){other})*+{quoted}$')


def _whole_records(lines: DataFrame, sep: str) -> DataFrame:
    """Lines joined to records where a quoted cell holds line breaks; a record stands at the place of its first line.

    A line takes 'inside a cell' or 'outside' to one of them: it sets either, keeps both or turns them. What a split does to
    them follows from its last line that sets and the turns after it; splits are composed in order within a file, and
    then each line's own state follows. Windows hold a split, or a row for each split of a file; only records of several lines are
    brought together.
    """
    out, inside = _left_open(F.col("value"), sep), _left_open(F.concat(F.lit('"'), "value"), sep)
    lines = lines.withColumns({"_sets": F.when(out == inside, out), "_turns": (out & ~inside).cast("int")})
    split, so_far = Window.partitionBy("file", _BLOCK).orderBy(_ROW), (Window.unboundedPreceding, -1)
    lines = lines.withColumns({"_all": F.coalesce(F.sum("_turns").over(split.rowsBetween(*so_far)), F.lit(0))})
    # A line that sets: its value, corrected by the turns up to it, so that later ones can be added.
    mark = F.when(F.col("_sets").isNotNull(), (F.col("_sets").cast("int") + F.col("_all")) % 2)
    lines = lines.withColumn("_mark", mark).withColumn("_last", F.last("_mark", True).over(split.rowsBetween(*so_far)))
    ends = lines.groupBy("file", _BLOCK).agg(F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col(_ROW))).alias("_m"), F.sum("_turns").alias("_t"))
    files, before = Window.partitionBy("file").orderBy(_BLOCK), (Window.unboundedPreceding, -1)
    ends = ends.withColumn("_past", F.coalesce(F.sum("_t").over(files.rowsBetween(*before)), F.lit(0)))
    ends = ends.withColumn("_set", F.when(F.col("_m").isNotNull(), (F.col("_m") + F.col("_past")) % 2))
    ends = ends.select("file", _BLOCK, ((F.coalesce(F.last("_set", True).over(files.rowsBetween(*before)), F.lit(0)) + F.col("_past")) % 2).alias("_begin"))
    lines = lines.join(ends, ["file", _BLOCK])
    lines = lines.withColumn("_inside", (F.coalesce("_last", "_begin") + F.col("_all")) % 2 == 1)
    place = F.struct(_BLOCK, _ROW)
    starts = F.when(~F.col("_inside"), place)
    held = F.last(starts, True).over(split)
    lines = lines.withColumn("_at", held)
    # Lines at a split's beginning that go on with the record of an earlier split.
    tails = lines.groupBy("file", _BLOCK).agg(F.max(starts).alias("_s")).withColumn("_from", F.last("_s", True).over(files.rowsBetween(*before))).select("file", _BLOCK, "_from")
    lines = lines.join(tails, ["file", _BLOCK]).withColumn("_at", F.coalesce("_at", "_from", place))
    lines = lines.withColumn("_more", F.col("_inside") | F.coalesce(F.lead("_inside").over(split), F.lit(True)))
    alone = lines.where("NOT _more").select("value", "file", _BLOCK, _ROW)
    several = lines.where("_more").groupBy("file", "_at").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(_BLOCK, _ROW, "value"))), lambda x: x["value"]), "\n").alias("value"))
    return alone.unionByName(several.select("value", "file", F.col(f"_at.{_BLOCK}").alias(_BLOCK), F.col(f"_at.{_ROW}").alias(_ROW)))


#: The place of a row in its file, in columns that with_seq takes away again.
_BLOCK, _ROW = "_file_block", "_file_row"


def _placed(df: DataFrame) -> DataFrame:
    """Adds file and the row's place: a file's split is read by one task in order, so ids that grow within a task
    order the rows of a split, whichever task reads it."""
    return df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias(_BLOCK), F.monotonically_increasing_id().alias(_ROW))


def with_seq(df: DataFrame, *order: str) -> DataFrame:
    """Adds seq, the input ordinal by file and place in it, or by the order columns. Ordinals count up within a
    split of a file (a file, with order columns), so that no task holds all rows; they order rows as a whole and need not be dense."""
    files = df.select("file").distinct()
    files = files.withColumn("_f", F.row_number().over(Window.orderBy("file")))
    if order:
        df = df.withColumns({"_n": F.row_number().over(Window.partitionBy("file").orderBy(*order)), "_past": F.lit(0)})
    else:  # by splits, moved up by the rows of the splits before
        sizes = df.groupBy("file", _BLOCK).agg(F.count(F.lit(1)).alias("_rows"))
        past = F.coalesce(F.sum("_rows").over(Window.partitionBy("file").orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        df = df.withColumn("_n", F.row_number().over(Window.partitionBy("file", _BLOCK).orderBy(_ROW)))
        df = df.join(sizes.select("file", _BLOCK, past.alias("_past")), ["file", _BLOCK])
    return df.join(F.broadcast(files), "file").withColumn("seq", F.col("_f").cast("long") * F.lit(1 << 32) + F.col("_past") + F.col("_n")).drop("_f", "_n", "_past", _BLOCK, _ROW)


def read_json_document(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_features(spark: SparkSession, path, required: tuple[str, ...] = ()) -> DataFrame:
    """(properties, geometry) of a FeatureCollection's features. HeaderError without a required property."""
    df = read_json_document(spark, path).select(F.explode("features").alias("f")).select("f.properties", "f.geometry")
    have = set(df.schema["properties"].dataType.names)
    if missing := [r for r in required if r not in have]:
        raise HeaderError(f"no properties {missing} among {sorted(have)}")
    return df


def read_feature_lines(spark: SparkSession, path, schema: str) -> DataFrame:
    """One feature for each line, plain or gzip; lines that aren't JSON are skipped."""
    return spark.read.option("mode", "DROPMALFORMED").schema(schema).json(path)


def read_json_lines(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    return _placed((spark.read.schema(schema) if schema else spark.read).json(path))


def read_documents(spark: SparkSession, path) -> DataFrame:
    """(file, text): whole files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def file_stem(c="file"):
    return F.url_decode(F.regexp_extract(F.col(c), r"([^/]+?)(?:\.[^./]*)?$", 1))


def load_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A store that may not have been written yet, in versions or as plain Parquet."""
    store = Table(spark, path)
    if store.versioned:
        return store.read()
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path) if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) else None


def load_json_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """Optional overlays: laws and outlines degrade to nothing when their file is missing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return read_json_document(spark, path) if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) else None


def laws(spark: SparkSession, path: str) -> DataFrame | None:
    """(area, kind, status, what, label, colour) of the law overlay, by country or state code."""
    doc = load_json_or_none(spark, path)
    if doc is None:
        return None
    statuses = doc.select(F.explode(F.from_json(F.to_json("statuses"), "map<string,struct<label:string,colour:string>>")).alias("status", "s")).select("status", "s.label", "s.colour")
    rows = [doc.select(F.explode(c).alias("x")).select(F.col("x.code").alias("area"), F.lit(c).alias("kind"), "x.status", "x.what") for c in ("countries", "us_states") if c in doc.columns]
    every = rows[0]
    for r in rows[1:]:
        every = every.unionByName(r)
    return every.join(F.broadcast(statuses), "status", "left")


def dig(doc, path: str):
    """The value at a dotted path of a JSON string, or null."""
    return F.get_json_object(doc, "$." + path)


def members(doc):
    """The document's own names with their values as get_json_object writes them, '' as null; null if it is not an object."""
    found = F.map_filter(F.from_json(doc, "map<string,string>", {"allowUnquotedControlChars": "true"}), lambda _, v: v.isNotNull())
    written = lambda k, v: F.when(v.rlike("^(?:[\\[{]|-?[0-9]+[.eE])"), F.call_function("get_json_object", doc, F.concat(F.lit("$."), k))).otherwise(F.nullif(v, F.lit("")))
    return F.transform_values(found, written)


def alias_get(doc, *names: str, exact=None, folded=None):
    """The first name with a value that isn't empty, exact names first, then in lower case. exact, folded: the members()
    of the document and of it in lower case, for callers that ask for several values."""
    exact, folded = members(doc) if exact is None else exact, members(F.lower(doc)) if folded is None else folded
    return F.coalesce(*[exact[n] for n in names], *[folded[n.lower()] for n in names])
