"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, as in tests on one machine, a folder of our own. On a cluster such a
    folder would be on one machine only, so an unset one is an error there."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sitefold-"))
        known = spark.sparkContext.getCheckpointDir()
    return known


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/sitefold/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.materialised_at = path
    return out


def release(df: DataFrame) -> None:
    """Deletes a table that materialise() wrote and that nothing reads any more. Other frames are left alone."""
    path = getattr(df, "materialised_at", None)
    if path:
        p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def clean(spark: SparkSession) -> None:
    """Deletes all tables of this library under the shared folder: for the end of a job whose results are written elsewhere."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/sitefold")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
