"""Column expressions that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sitefold.plans.shared import materialise, new_dir  # noqa: F401

#: The six ASCII white-space characters that separate words.
SPACE = " \t\n\x0b\f\r"
SPACE_RE = "[ \\t-\\r]+"


def words(text: Column) -> Column:
    """The runs of characters other than SPACE, as an array; empty for null and blank text."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare.isNull() | (bare == ""), F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RE))


def fresh(taken: list[str], *names: str) -> list[str]:
    """Each name, with as many underscores behind it as keep it apart from the names taken, whatever their case."""
    used = {t.casefold() for t in taken}
    out = []
    for n in names:
        while n.casefold() in used:
            n += "_"
        out.append(n)
    return out


def without(columns: list[str], *added: str) -> list[str]:
    """The columns but for those that added ones replace."""
    gone = {a.casefold() for a in added}
    return [c for c in columns if c.casefold() not in gone]


def row_key(key: str, text: str) -> Column:
    """A key of 16 bytes that rows equal in id and text share and others do not, under null or repeated ids as well.

    Operators that must find a row again join on it.
    """
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.col(text))))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
