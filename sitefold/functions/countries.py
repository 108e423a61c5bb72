"""Country names to ISO codes. The tables are built from the JVM's own locale data, in English and Chinese."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sitefold.functions.text import norm_text, squeeze

# Names in registers that the locale data spell otherwise.
ALIASES = {
    "usa": "USA", "united states of america": "USA", "us": "USA", "uk": "GBR", "great britain": "GBR", "england": "GBR", "scotland": "GBR", "wales": "GBR",
    "northern ireland": "GBR", "united kingdom northern ireland": "GBR", "united kingdom of great britain and northern ireland": "GBR",
    "czech republic": "CZE", "czechia": "CZE", "myanmar": "MMR", "burma": "MMR", "russian federation": "RUS", "russia": "RUS", "viet nam": "VNM",
    "korea republic of": "KOR", "republic of korea": "KOR", "south korea": "KOR", "north korea": "PRK", "turkiye": "TUR", "turkey": "TUR",
    "ivory coast": "CIV", "cote d ivoire": "CIV", "cape verde": "CPV", "cabo verde": "CPV", "swaziland": "SWZ", "eswatini": "SWZ", "macedonia": "MKD",
    "north macedonia": "MKD", "republic of north macedonia": "MKD", "moldova republic of": "MDA", "republic of moldova": "MDA", "iran islamic republic of": "IRN",
    "tanzania united republic of": "TZA", "united republic of tanzania": "TZA", "bolivia plurinational state of": "BOL",
    "venezuela bolivarian republic of": "VEN", "hong kong": "HKG", "hong kong sar": "HKG", "macao": "MAC", "macau": "MAC", "taiwan": "TWN", "kosovo": "XKX",
    "congo": "COD", "democratic republic of the congo": "COD", "republic of the congo": "COG", "faroe islands": "FRO", "falkland islands": "FLK",
    "saint helena": "SHN", "vatican city": "VAT", "holy see": "VAT", "palestine": "PSE", "east timor": "TLS", "timor leste": "TLS", "brunei": "BRN",
    "brunei darussalam": "BRN", "lao people s democratic republic": "LAO", "laos": "LAO", "syrian arab republic": "SYR", "syria": "SYR", "bosnia": "BIH",
    "bosnia and herzegovina": "BIH", "the netherlands": "NLD", "holland": "NLD", "svalbard": "SJM", "saint pierre and miquelon": "SPM", "faroes": "FRO", "the gambia": "GMB",
}


def country_table(spark: SparkSession) -> list[tuple[str, str, str, str]]:
    """(iso3, iso2, English name, Chinese name) of every country that the JVM lists; 250 or so."""
    locale = spark._jvm.java.util.Locale
    out = []
    for two in locale.getISOCountries():
        at = locale("", two)
        out.append((at.getISO3Country(), two, at.getDisplayCountry(locale.ENGLISH), at.getDisplayCountry(locale.CHINESE)))
    return [x for x in out if x[0]]


def country_names(spark: SparkSession) -> DataFrame:
    """(norm, iso3): every folded name and code, once. Bounded by the number of countries."""
    rows = []
    for iso3, iso2, en, zh in country_table(spark):
        rows += [(n, iso3, r) for r, n in enumerate((zh, iso3, iso2, en.replace("&", "and").replace("St.", "Saint"), en))]
    rows += [(n, iso3, 5) for n, iso3 in ALIASES.items()]
    named = spark.createDataFrame(rows, "name string, iso3 string, rank int").withColumn("norm", norm_country("name"))
    return named.groupBy("norm").agg(F.max_by("iso3", "rank").alias("iso3"))


def norm_country(name: str | Column) -> Column:
    return norm_text(F.col(name) if isinstance(name, str) else name)


def with_iso3(df: DataFrame, value: str, into: str) -> DataFrame:
    """Adds the ISO code of a country's name or code: the whole value, then its parts between / | , 'e', 'y'; null on a miss.

    The misses are those with a value and no code. Codes of values are looked up once for each distinct value.
    """
    parts = F.split(F.col("_v"), "\\s*[/|,]\\s*|\\s+[ey]\\s+|\\s*\\(\\s*|\\s*\\)\\s*")
    values = df.select(F.col(value).alias("_v")).where("_v IS NOT NULL").distinct()
    tried = values.select("_v", F.posexplode(F.concat(F.array("_v"), parts)).alias("_k", "_p")).withColumn("norm", norm_country(squeeze(F.col("_p"))))
    found = tried.join(F.broadcast(country_names(df.sparkSession)), "norm").groupBy("_v").agg(F.min_by("iso3", "_k").alias(into))
    return df.drop(into).join(found, F.col(value) == F.col("_v"), "left").drop("_v")


def unresolved(df: DataFrame, value: str, iso3: str) -> DataFrame:
    """Country values without a code, with their numbers, most common first."""
    return df.where(F.col(iso3).isNull() & (F.coalesce(F.trim(value), F.lit("")) != "")).groupBy(value).count().orderBy(F.desc("count"), value)


def with_iso2(df: DataFrame, iso3: str = "country_iso3", into: str = "iso2", name: str | None = None) -> DataFrame:
    """Adds the two-letter code, and the English name if asked for."""
    table = df.sparkSession.createDataFrame([(a, b, c) for a, b, c, _ in country_table(df.sparkSession)], "_i string, _two string, _en string")
    out = df.join(F.broadcast(table), F.col(iso3) == F.col("_i"), "left").withColumn(into, F.col("_two"))
    return (out.withColumn(name, F.col("_en")) if name else out).drop("_i", "_two", "_en")
