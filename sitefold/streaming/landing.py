"""Harvested rows land as JSON-lines files and stream into a table, each registration once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The harvested fields, with other names under which a response may have them.
ALIASES = {
    "registerNo": ("registerNo", "registerNumber", "regNo"), "foreignRegisterNo": ("foreignRegisterNo", "foreignRegNo"), "enName": ("enName", "nameEn", "enterpriseNameEn"),
    "name": ("name", "enterpriseName"), "countryCode": ("countryCode", "country"), "address": ("address", "addr"), "enAddress": ("enAddress", "addressEn"),
    "productCategory": ("productCategory", "category", "categories"), "validDate": ("validDate", "validUntil"),
}


def normalised(lines: DataFrame, value: str = "value") -> DataFrame:
    """The nine fields of a response row, with the row itself as _raw; a row is parsed twice, as it is and in lower case."""
    from sitefold.sources.files import alias_get, members

    parsed = lines.select(F.col(value).alias("_raw"), members(F.col(value)).alias("_exact"), members(F.lower(value)).alias("_folded"))
    found = {c: alias_get(F.col("_raw"), *names, exact=F.col("_exact"), folded=F.col("_folded")) for c, names in ALIASES.items()}
    return parsed.select(*[x.alias(c) for c, x in found.items()], "_raw")


def stream(spark: SparkSession, folder: str) -> DataFrame:
    """Rows as files arrive."""
    rows = spark.readStream.schema("value string").text(folder).where("trim(value) <> ''")
    return normalised(rows.select("value")).withColumn("landed", F.current_timestamp())


def add_new(batch: DataFrame, number: int, table: str) -> None:
    """Adds the batch's registrations that no other batch has landed, in a folder of its own: a batch that runs again
    replaces what it wrote. Only the numbers of what is there are read. Rows without a number are all kept."""
    spark = batch.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(table)
    # One key for each registration, and for each row without a number, so that the rows are parsed and dealt out once.
    one = lambda number: F.concat(F.lit("r"), number)
    new = batch.withColumn("_one", F.coalesce(one(F.col("registerNo")), F.concat(F.lit("n"), F.monotonically_increasing_id().cast("string")))).dropDuplicates(["_one"])
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        there = spark.read.schema("registerNo string, batch bigint").parquet(table).where(F.col("batch") != number)
        new = new.join(there.select(one(F.col("registerNo")).alias("_one")), "_one", "left_anti")
    new = new.drop("_one")
    new.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(table)


def land(spark: SparkSession, folder: str, table: str, checkpoint: str) -> None:
    """Takes all files that are there and ends; files done before are skipped by the checkpoint, registrations landed
    before, however long ago, by the table."""
    q = stream(spark, folder).writeStream.foreachBatch(lambda batch, number: add_new(batch, number, table)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
