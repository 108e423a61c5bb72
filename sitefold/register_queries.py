"""Queries that run the register readers and scans: the driver's tables are written in each register's form to the shared
folder, read back by the reader, and compared with what the same tables give in SQL.

Cells and expected values are expressions that Spark and DuckDB read alike, so both sides start from the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitefold.functions import address, countries, text
from sitefold.plans import publish
from sitefold.plans.shared import new_dir
from sitefold.queries import IN_OUTLINE, OUTLINES, query, table
from sitefold.sources import files, pastes, registers
from sitefold.streaming import landing

#: Features in one document, lines of listings in one page.
IN_ONE = 100


def case(k: str, *values: str | None) -> str:
    """The k-th value, by the remainder of k; values are texts, None is null."""
    quoted = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return f"CASE {k} % {len(values)} " + " ".join(f"WHEN {i} THEN {quoted(v)}" for i, v in enumerate(values)) + " END"


def flag(k: str, *values: bool | None) -> str:
    word = {True: "true", False: "false", None: "CAST(NULL AS BOOLEAN)"}
    return f"CASE {k} % {len(values)} " + " ".join(f"WHEN {i} THEN {word[v]}" for i, v in enumerate(values)) + " END"


def select(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in columns.items()) + f" FROM {source}"


def cells(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(v).alias(k) for k, v in columns.items()])


def as_csv(df: DataFrame, name: str, sep: str = ",") -> str:
    path = new_dir(df.sparkSession, name)
    df.write.option("header", True).option("escape", '"').option("sep", sep).csv(path)
    return path


def as_lines(df: DataFrame, name: str, value: str, of: str | None = None) -> str:
    """A text file for each value of `of`, in the order that the rows have."""
    path = new_dir(df.sparkSession, name)
    w = df.select(F.col(value).alias("value"), *([F.col(of).alias("g")] if of else [])).write
    (w.partitionBy("g") if of else w).text(path)
    return path


def as_documents(df: DataFrame, name: str, key: str, item, under: str) -> str:
    """JSON documents of at most IN_ONE items each, in a list named `under`."""
    docs = df.select(F.floor(F.col(key) / IN_ONE).alias("g"), item.alias("x")).groupBy("g").agg(F.collect_list("x").alias(under))
    return as_lines(docs.select("g", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), under)).alias("v")), name, "v", "g")


def joined(df: DataFrame, *more: str) -> DataFrame:
    """The canonical columns that queries compare; lists joined by commas."""
    lists = [F.array_join(c, ",").alias(c) for c in ("species", "activities")]
    return df.select("source_id", "name", "country_iso3", "national_id", "id_scheme", *lists, "slaughter", *more)


@query(
    "p1_j1_s1_fsis",
    "WITH o AS (SELECT o_custkey k, max(o_orderkey) o FROM orders GROUP BY 1), j AS (SELECT c.*, c_custkey k, o.o FROM customer c LEFT JOIN o ON o.k = c_custkey) "
    + select(
        {
            "source_id": "'us_fsis_mpi'", "source_row_id": "'M' || k", "name": "c_name", "country_iso3": "'USA'", "national_id": "'M' || k", "id_scheme": "'US-FSIS'", "postcode": "'Z' || k",
            "species": "CASE WHEN o % 2 = 0 THEN 'bovine' ELSE '' END", "slaughter": flag("o", True, False, None),
            "activities": "CASE WHEN o % 3 = 0 AND o % 5 = 0 THEN 'slaughter,cutting' WHEN o % 3 = 0 THEN 'slaughter' WHEN o % 5 = 0 THEN 'cutting' ELSE 'unknown' END",
            "size_class": "CASE WHEN k % 2 = 1 THEN 'Small' WHEN o % 2 = 0 THEN '1' END", "src_lat": "CASE WHEN k % 4 = 0 THEN 37.5::DOUBLE END", "src_lon": "CASE WHEN k % 4 = 0 THEN -100.1::DOUBLE END",
            "src_precision": "CASE WHEN k % 4 = 0 THEN 'rooftop' END",
        },
        "j",
    ),
)
def p1(spark, d):
    """The last flags of a number win; positions out of range, unreadable or at 0, 0 aren't positions."""
    k = "c_custkey"
    directory = cells(table(spark, d, "customer"), {
        "Establishment_Number": f"'m' || {k}", "Establishment_Name": "c_name", "Street": "'1 Rd'", "City": "'Town'", "State": "'KS'", "Zip": f"'Z' || {k}",
        "Latitude": case(k, "37.5", "0", "91", "x"), "Longitude": case(k, "-100.1", "0", "10", "5"), "Size": case(k, "", "Small"), "DBAs": "''",
    })
    o = "o_orderkey"
    flags = table(spark, d, "orders").repartition("o_custkey").sortWithinPartitions("o_custkey", o)
    flags = cells(flags, {
        "establishment_number": "'M' || o_custkey", "slaughter": case(o, "Yes", "No", ""), "meat_slaughter": "''", "beef_cow_slaughter": case(o, "Y", ""), "raw_intact": case(o, "Y", "", "", "", ""),
        "slaughter_volume_category": case(o, "1", ""),
    })
    return joined(registers.fsis(spark, as_csv(directory, "fsis"), as_csv(flags, "fsis-flags")), "source_row_id", "postcode", "size_class", "src_lat", "src_lon", "src_precision")


UNGULATES, BIRDS = "bovine,porcine,ovine,caprine,equine", "poultry,lagomorph"


@query(
    "p2_f7_c20_eu_list",
    select(
        {
            "source_id": case("k", "eu_traces_member_state", "eu_traces_third_country", "eu_member_states"), "name": "p_name", "country_iso3": case("k", "FRA", "DEU"),
            "national_id": "CASE WHEN k % 5 > 0 THEN 'A' || k END", "id_scheme": "'EU-APPROVAL'", "admin1": case("k", "North", "South", None), "postcode": "'P' || k",
            "species": f"CASE WHEN k % 6 = 0 THEN 'ovine,bovine' WHEN k % 3 = 0 THEN 'bovine' ELSE {case('k', UNGULATES, BIRDS, '', UNGULATES)} END",
            "activities": case("k", "cutting,slaughter", "cutting", "unknown", "game_handling,processing"),
            "slaughter": f"CASE k % 7 WHEN 0 THEN true WHEN 1 THEN false ELSE {flag('k', True, False, None, False)} END",
        },
        "(SELECT *, p_partkey k FROM part)",
    ),
)
def p2(spark, d):
    """Species from the list and the region's lines, else from the section; the flag before the codes; nothing said is null."""
    k = "p_partkey"
    rows = cells(table(spark, d, "part"), {
        "approval_number": f"CASE WHEN {k} % 5 > 0 THEN 'A' || {k} END", "name": "p_name", "address": f"'Road ' || {k}", "city": "'Town'", "postcode": f"'P' || {k}", "region": case(k, "North; B Bovinae; 12345", "South", ""),
        "country": case(k, "France", "Germany"), "group": case(k, "EU-EFTA", "third-country", ""), "section": case(k, "SECTION I", "PM", "FFP", "RM"), "activity": case(k, "SH CP", "CP", "", "GHE, PP"),
        "slaughter": case(k, "Y", "N", "", "", "", "", ""), "species": case(k, "ovine; zebra", "", "", "", "", ""),
    })
    return joined(registers.eu_list(spark, as_csv(rows, "eu-list")), "admin1", "postcode")


@query(
    "p3_eu_health",
    select(
        {
            "source_id": "'eu_traces_animal_health'", "name": "p_name", "country_iso3": "'ESP'", "national_id": "'H' || k", "id_scheme": "'TRACES-AH'",
            "species": "CASE WHEN k % 3 = 0 THEN 'ovine,caprine' WHEN k % 5 = 1 THEN 'bovine' WHEN k % 5 = 4 THEN 'equine' ELSE '' END",
            "activities": case("k", "slaughter", "germinal_products", "hatchery", "holding_yard", "holding_yard"), "slaughter": "k % 5 = 0",
        },
        "(SELECT *, p_partkey k FROM part)",
    ),
)
def p3(spark, d):
    k = "p_partkey"
    rows = cells(table(spark, d, "part"), {
        "approval_number": f"'H' || {k}", "name": "p_name", "address": "''", "city": "''", "postcode": "''", "region": "''", "country": "'Spain'", "section": case(k, "AQUA-EST-DISEASE", "SEM-COL", "HATCH-AP", "", "asc-ung"),
        "activity": case(k, "x", "Bovine semen", "y", "Assembly centre", "Equine"), "species": case(k, "ovine|caprine", "", ""),
    })
    return joined(registers.eu_health(spark, as_csv(rows, "eu-health")))


@query(
    "p4_eu_ied",
    select(
        {
            "source_id": "'eu_ied'", "name": "p_name", "country_iso3": "'ITA'", "national_id": "'I' || k", "id_scheme": "'EU-INSPIRE'", "species": case("k", "", "porcine", "", ""),
            "activities": case("k", "slaughter", "farm_meat", "", "rendering"), "slaughter": flag("k", True, None, None, None), "src_lat": "CASE WHEN k % 3 = 0 THEN 10.5::DOUBLE END", "src_lon": "CASE WHEN k % 3 = 0 THEN 20.25::DOUBLE END",
        },
        "(SELECT *, p_partkey k FROM part WHERE p_partkey % 4 <> 2)",
    ),
)
def p4(spark, d):
    """One of four activities isn't listed and its rows go."""
    k = "p_partkey"
    rows = cells(table(spark, d, "part"), {
        "IEDAnnexIMainActivity": case(k, "6.4(a)", "6.6(b)", "9.9", "6.5"), "Latitude": case(k, "10.5", "95", "x"), "Longitude": "'20.25'", "installationName": "p_name", "InstallationInspireId": f"'I' || {k}", "CountryName": "'Italy'",
        "City_of_Facility": "'C'",
    })
    return joined(registers.eu_ied(spark, as_csv(rows, "eu-ied")), "src_lat", "src_lon")


@query(
    "p4_country_from_position",
    f"WITH p AS (SELECT p_partkey k, (p_partkey % 131 - 70)::DOUBLE + 0.25 x, (p_partkey % 97 - 48)::DOUBLE + 0.75 y FROM part WHERE p_partkey % 4 <> 2), {IN_OUTLINE} SELECT 'I' || k national_id, CASE WHEN k % 5 = 0 THEN 'ITA' ELSE iso END country_iso3 FROM found",
)
def p4_position(spark, d):
    """Only each fifth installation names its country."""
    k = "p_partkey"
    rows = cells(table(spark, d, "part"), {
        "IEDAnnexIMainActivity": case(k, "6.4(a)", "6.6(b)", "9.9", "6.5"), "Latitude": f"CAST({k} % 97 - 48 + 0.75 AS STRING)", "Longitude": f"CAST({k} % 131 - 70 + 0.25 AS STRING)", "installationName": "p_name",
        "InstallationInspireId": f"'I' || {k}", "CountryName": f"CASE WHEN {k} % 5 = 0 THEN 'Italy' ELSE '' END", "City_of_Facility": "'C'",
    })
    return registers.eu_ied(spark, as_csv(rows, "eu-ied-at"), outlines=OUTLINES, open_rings=True).select("national_id", "country_iso3")


def _cfia(spark, d) -> str:
    k = "p_partkey"
    return as_csv(cells(table(spark, d, "part"), {
        "EST_NUM1": f"'E' || {k}", "NAME1": f"CASE WHEN {k} % 10 > 0 THEN p_name END", "CODES_11": case(k, "ab", "f", "", "dz"), "CODES_31": case(k, "x", "", ""), "LOC_ADD11": f"'a' || {k}", "LOC_ADD21": "''", "LOC_CITY1": "'Town'",
        "LOC_PROV1": "'ON'", "LOC_PC1": f"'K' || {k}", "ADB_NAME1": "''",
    }), "cfia")


@query(
    "p5_ca_cfia",
    select(
        {
            "source_id": "'ca_cfia'", "name": "p_name", "country_iso3": "'CAN'", "national_id": "'E' || k", "id_scheme": "'CA-EST'", "species": case("k", "bovine", "poultry", "", "porcine"),
            "activities": "CASE WHEN k % 4 = 2 THEN CASE WHEN k % 3 = 0 THEN 'cutting' ELSE 'unknown' END ELSE CASE WHEN k % 3 = 0 THEN 'slaughter,cutting' ELSE 'slaughter' END END", "slaughter": "k % 4 <> 2",
            "address": "'a' || k", "postcode": "'K' || k",
        },
        "(SELECT *, p_partkey k FROM part WHERE p_partkey % 10 > 0)",
    ),
)
def p5(spark, d):
    return joined(registers.ca_cfia(spark, _cfia(spark, d)), "address", "postcode")


@query("p5_unmapped_letters", "SELECT 'z' AS letter, count(*) AS count FROM part WHERE p_partkey % 4 = 3")
def p5_letters(spark, d):
    return registers.unmapped_letters(spark, _cfia(spark, d))


@query(
    "p6_a15_nz_mpi",
    "WITH f AS (SELECT min(o_orderkey) o, o_custkey c FROM orders WHERE o_orderkey % 11 > 0 GROUP BY 2 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 11 = 0) "
    + select(
        {
            "source_id": "'nz_mpi'", "name": "CASE WHEN o % 3 = 0 THEN 'B' || o ELSE 'T' || o END", "country_iso3": "'NZL'", "national_id": "'N' || c", "id_scheme": "'NZ-MPI'", "species": case("o", "bovine", "ovine", ""),
            "activities": "coalesce(nullif(concat_ws(',', " + case("o", "slaughter", "rendering", None, "cold_store") + ", CASE WHEN o % 5 = 0 AND o % 4 <> 0 THEN 'slaughter' WHEN o % 5 = 1 THEN 'egg_products,farm_eggs' END), ''), 'unknown')",
            "slaughter": "o % 4 = 0 OR o % 5 = 0", "operator": "'B' || o",
        },
        "f",
    ),
)
def p6(spark, d):
    """The first row of an id stays, and every row without one."""
    o = "o_orderkey"
    rows = table(spark, d, "orders").repartition("o_custkey").sortWithinPartitions("o_custkey", o)
    rows = cells(rows, {
        "MPI ID Number": f"CASE WHEN {o} % 11 > 0 THEN 'N' || o_custkey END", "Operator Trading Name": f"CASE WHEN {o} % 3 > 0 THEN 'T' || {o} END", "Operator Business Name": f"'B' || {o}", "Primary": case(o, "Slaughter", "Rendering", "", "Refrigeration"),
        "Secondary Process": "''", "Programme Type": case(o, "Micro Abattoir", "Eggs layer", "", "", ""), "Product/Material": case(o, "Cattle", "sheep and lamb", "Bees"), "Physical Address": "''", "Physical Town/City": "''",
        "Location Local Authority": "''", "Operator Local Authority": "''",
    })
    return joined(registers.nz_mpi(spark, as_csv(rows, "nz-mpi")), "operator")


@query(
    "p7_a16_br_sif",
    "SELECT 'br_mapa_sif' AS source_id, o_custkey || '|9' AS source_row_id, 'F' || min(o_orderkey) AS name, 'BRA' AS country_iso3, CAST(o_custkey AS VARCHAR) AS national_id, 'BR-SIF' AS id_scheme, 'L' || min(o_orderkey) || ', B' AS address, "
    "array_to_string(list_sort(list(DISTINCT " + case("o_orderkey", "bovine", None, "poultry") + ") FILTER (WHERE o_orderkey % 3 <> 1)), ',') AS sp, "
    "array_to_string(list_sort(list(DISTINCT " + case("o_orderkey", "slaughter", "cold_store", "farm_eggs") + ")), ',') AS activities, bool_or(o_orderkey % 3 = 0) AS slaughter FROM orders GROUP BY o_custkey",
)
def p7(spark, d):
    """Rows of one number and tax id fold into one: the first row's cells, all rows' activities and species."""
    o = "o_orderkey"
    rows = table(spark, d, "orders").repartition("o_custkey").sortWithinPartitions("o_custkey", o)
    rows = cells(rows, {
        "NR_SIF": "o_custkey", "CPF_CNPJ": "'9'", "RAZAO_SOCIAL": f"'Op' || {o}", "NOME_FANTASIA": f"'F' || {o}", "CATEGORIA_CLASSE": case(o, "ABATEDOURO - BOVINO", "ENTREPOSTO", "GRANJA AVES"), "AREA_CATEGORIA": "''",
        "LOGRADOURO": f"'L' || {o}", "BAIRRO": "'B'", "MUNICIPIO": "'M'", "UF": "'GO'", "CEP": "'C'",
    })
    out = joined(registers.br_sif(spark, as_csv(rows, "br-sif", ";")), "source_row_id", "address")
    return out.withColumn("sp", F.nullif("species", F.lit(""))).drop("species")


TRASE = """f AS (SELECT s_suppkey - s_suppkey % 2 p, min(s_suppkey) k, count(*) n FROM supplier GROUP BY 1), g AS (SELECT *, CAST(p % 8 AS DOUBLE) lat, 'M' || CASE WHEN p % 8 < 4 THEN 0 ELSE p % 24 // 8 END town FROM f),
c AS (SELECT lat, count(*) shared, count(DISTINCT town) towns FROM g GROUP BY 1)"""


@query(
    "p8_s4_c31_br_trase",
    f"WITH {TRASE} "
    + select(
        {
            "source_id": "'br_trase'", "name": "'C' || k", "country_iso3": "'BRA'", "national_id": "CASE WHEN p % 4 = 0 THEN 'N' || k ELSE 'f' || p END", "id_scheme": "CASE WHEN p % 4 = 0 THEN 'BR-SIF' ELSE 'BR-TRASE' END",
            "foreign_id": "CASE WHEN p % 4 = 0 THEN 'f' || p END", "species": "CASE WHEN n = 2 THEN 'bovine,porcine' WHEN k % 2 = 0 THEN 'bovine' ELSE 'porcine' END", "activities": "'slaughter'", "slaughter": "true", "locality": "town",
            "src_lat": "CASE WHEN towns = 1 THEN lat END", "src_precision": "CASE WHEN towns = 1 THEN CASE WHEN shared >= 3 THEN 'locality' ELSE 'rooftop' END END", "masked": "'***01'", "plain": "'12345678901'",
        },
        "g JOIN c USING (lat)",
    ),
)
def p8(spark, d):
    """Rows of a site fold; shared positions lose their precision or go; tax numbers of persons are masked unless asked for."""
    k = "s_suppkey"
    p = f"({k} - {k} % 2)"
    props = {
        "facility_id": f"'f' || {p}", "company": f"'C' || {k}", "commodity": case(k, "BEEF", "PORK"), "inspection_level": case(k, "SIF", "SIF", "SIE", "SIE"), "inspection_num": f"'N' || {k}", "lat": f"CAST({p} % 8 AS DOUBLE)", "long": "CAST(10 AS DOUBLE)",
        "type_english": "'Slaughterhouse'", "type_portuguese": "'Abatedouro'", "municipality": f"'M' || CASE WHEN {p} % 8 < 4 THEN 0 ELSE {p} % 24 DIV 8 END", "state": "'GO'", "cnpj": "'12345678901'",
    }
    item = F.struct(F.struct(*[F.expr(v).alias(c) for c, v in props.items()]).alias("properties"), F.struct(F.lit("Point").alias("type")).alias("geometry"))
    path = as_documents(table(spark, d, "supplier"), "trase", k, item, "features")
    tax = F.get_json_object("raw", "$.cnpj")
    plain = registers.br_trase(spark, path, mask=False).select("source_row_id", tax.alias("plain"))
    out = registers.br_trase(spark, path).withColumn("masked", tax).join(plain, "source_row_id")
    return joined(out, "foreign_id", "locality", "src_lat", "src_precision", "masked", "plain")


@query(
    "p9_s3_cifer",
    select(
        {
            "source_id": "'cifer_china'", "name": "p_name", "country_iso3": case("k", "USA", "AUS", "FRA"), "national_id": "'R' || k", "id_scheme": "'CN-CIFER'", "foreign_id": "CASE WHEN k % 4 > 0 THEN 'M' || k END",
            "foreign_id_scheme": "CASE WHEN k % 4 > 0 THEN " + case("k", "US-FSIS", "AU-EXPORT", None) + " END", "species": case("k", "bovine", "porcine,poultry", "fish", "", "ovine"), "activities": case("k", "slaughter", "unknown", "unknown", "slaughter", "unknown"),
            "slaughter": flag("k", True, None, None, True, None),
        },
        "(SELECT *, p_partkey k FROM part)",
    ),
)
def p9(spark, d):
    k = "p_partkey"
    rows = cells(table(spark, d, "part"), {
        "registerNo": f"'R' || {k}", "foreignRegisterNo": f"CASE WHEN {k} % 4 > 0 THEN 'M' || {k} END", "enName": "p_name", "countryCode": case(k, "US", "AU", "FR"),
        "productCategory": f"array({case(k, 'Beef slaughter', 'frozen pork', 'Aquatic', '屠宰', '羊')}, {case(k, 'x', 'chicken', 'x', 'x', 'x')})",
    })
    path = new_dir(spark, "cifer")
    rows.write.json(path)
    return joined(registers.cifer(spark, path), "foreign_id", "foreign_id_scheme")


@query(
    "p10_s2_s6_osm",
    select(
        {
            "source_id": "'osm_overpass'", "source_row_id": "CASE WHEN k % 2 = 0 THEN 'node/' || k ELSE 'way/' || k END", "name": "CASE WHEN k % 3 > 0 THEN s_name END", "country_iso3": "'DEU'", "activities": "'slaughter'", "slaughter": "true",
            "address": "k || ' High St'", "src_lat": "CAST(k % 80 AS DOUBLE)", "src_lon": "CAST(k % 170 AS DOUBLE)",
        },
        "(SELECT *, s_suppkey k FROM supplier WHERE s_suppkey % 7 > 0)",
    ),
)
def p10(spark, d):
    """Elements with a position of their own or of their centre; those without one go."""
    k = "s_suppkey"
    at = "struct(CAST(s_suppkey % 80 AS DOUBLE) AS lat, CAST(s_suppkey % 170 AS DOUBLE) AS lon)"
    item = F.struct(
        F.expr(case(k, "node", "way")).alias("type"), F.col(k).alias("id"), F.expr(f"CASE WHEN {k} % 7 > 0 AND {k} % 2 = 0 THEN CAST({k} % 80 AS DOUBLE) END").alias("lat"),
        F.expr(f"CASE WHEN {k} % 7 > 0 AND {k} % 2 = 0 THEN CAST({k} % 170 AS DOUBLE) END").alias("lon"), F.expr(f"CASE WHEN {k} % 7 > 0 AND {k} % 2 = 1 THEN {at} END").alias("center"),
        F.create_map(F.lit("name"), F.expr(f"CASE WHEN {k} % 3 > 0 THEN s_name ELSE '' END"), F.lit("addr:country"), F.lit("DE"), F.lit("addr:housenumber"), F.col(k).cast("string"), F.lit("addr:street"), F.lit("High St")).alias("tags"),
    )
    out = registers.osm(spark, as_documents(table(spark, d, "supplier"), "osm", k, item, "elements"))
    return out.select("source_id", "source_row_id", "name", "country_iso3", F.array_join("activities", ",").alias("activities"), "slaughter", "address", "src_lat", "src_lon")


@query(
    "p10_country_from_position",
    f"WITH p AS (SELECT s_suppkey k, CAST(s_suppkey % 80 AS DOUBLE) - 39.5 y, CAST(s_suppkey % 170 AS DOUBLE) - 99.75 x FROM supplier), {IN_OUTLINE} SELECT 'node/' || k source_row_id, iso country_iso3 FROM found",
)
def p10_position(spark, d):
    """No element names its country."""
    k = "s_suppkey"
    item = F.struct(F.lit("node").alias("type"), F.col(k).alias("id"), F.expr(f"CAST({k} % 80 AS DOUBLE) - 39.5").alias("lat"), F.expr(f"CAST({k} % 170 AS DOUBLE) - 99.75").alias("lon"), F.create_map(F.lit("name"), F.col("s_name")).alias("tags"))
    return registers.osm(spark, as_documents(table(spark, d, "supplier"), "osm-at", k, item, "elements"), outlines=OUTLINES, open_rings=True).select("source_row_id", "country_iso3")


@query(
    "p11_c28_generic",
    select(
        {
            "source_id": "'s1'", "source_row_id": "CAST(s_suppkey AS VARCHAR)", "name": "s_name", "country_iso3": "'AUS'", "national_id": "CAST(s_suppkey AS VARCHAR)", "id_scheme": "'AU-X'", "species": "''", "activities": "'slaughter'", "slaughter": "true",
            "locality": "CASE WHEN s_suppkey % 2 = 0 THEN 'Here' END",
        },
        "supplier",
    ),
)
def p11(spark, d):
    rows = cells(table(spark, d, "supplier"), {"Number ": "s_suppkey", "Name": "' ' || s_name || ' '", "Suburb": case("s_suppkey", " Here", "  "), "Postal Code": "'9'"})
    return joined(registers.generic(spark, as_csv(rows, "generic"), "s1", "AU-X", "AUS", slaughter=True), "source_row_id", "locality")


FTP = {
    "species": case("k", "bovine,porcine", "insect", ""), "activities": case("k", "farm_meat,zoo", "slaughter", "unknown", "unknown"), "slaughter": flag("k", False, True, None, None),
}


@query(
    "p12_c30_ftp_csv",
    select(
        {
            "source_id": "'farm_transparency'", "name": "p_name", "country_iso3": "'AUS'", "national_id": "CASE WHEN k % 5 > 0 THEN 'id' || k END", "id_scheme": "'FTP'", **FTP, "source_row_id": "CASE WHEN k % 5 > 0 THEN 'id' || k ELSE '1.5,2.25' END",
            "unknown": case("k", None, None, "Castle", None),
        },
        "(SELECT *, p_partkey k FROM part)",
    ),
)
def p12(spark, d):
    k = "p_partkey"
    rows = cells(table(spark, d, "part"), {
        "id": f"CASE WHEN {k} % 5 > 0 THEN 'id' || {k} END", "name": "p_name", "categories": case(k, "Farm (meat), Zoo", "Slaughterhouse (unconfirmed)", "Castle", ""), "species": case(k, "Pigs, Cows/Cattle", "Bees", ""), "lat": "'1.5'", "lng": "'2.25'",
        "country": "'Australia'",
    })
    out = registers.ftp_csv(spark, as_csv(rows, "ftp"))
    return joined(out.withColumn("unknown", F.get_json_object("raw", "$.unknown_categories[0]")), "source_row_id", "unknown")


@query(
    "p13_s7_ftp_kml",
    select(
        {
            "source_id": "'farm_transparency'", "name": "p_name", "country_iso3": "'AUS'", "national_id": "'m' || k", "id_scheme": "'FTP'", **FTP, "address": "k || ' Rd'", "src_lat": "-33.25::DOUBLE", "src_lon": "150.5::DOUBLE",
        },
        "(SELECT *, p_partkey k FROM part WHERE p_partkey % 6 > 0)",
    ),
)
def p13(spark, d):
    """Placemarks of many documents; those without a point go."""
    k = "p_partkey"
    categories, kinds = case(k, "Farm (meat), Zoo", "Slaughterhouse (unconfirmed)", "Castle", ""), case(k, "Pigs, Cows/Cattle", "Bees", "")
    mark = (
        f"'<Placemark id=\"m' || {k} || '\"><name>' || p_name || ' (AU #a1f)</name><description>Categories: ' || {categories} || '\\nSpecies: ' || {kinds} || '\\nAddress: ' || {k} || ' Rd</description>' || "
        f"CASE WHEN {k} % 6 > 0 THEN '<Point><coordinates>150.5,-33.25,0</coordinates></Point>' ELSE '' END || '</Placemark>'"
    )
    path = as_lines(table(spark, d, "part").select(F.expr(mark).alias("v")), "kml", "v")
    return joined(registers.ftp_kml(spark, path), "address", "src_lat", "src_lon")


def _pages(df: DataFrame, head: list[str], lines: list[str], k: str, country: str) -> str:
    """Pages of at most IN_ONE rows: the head's lines, then each row's. Lines that are null are left out."""
    spark = df.sparkSession
    at = F.floor(F.col(k) / IN_ONE)
    heads = df.select(at.alias("g")).distinct().select("g", F.posexplode(F.array(*map(F.lit, head))).alias("i", "v")).select("g", F.lit(-1).cast("long").alias("n"), "i", "v")
    rows = df.select(at.alias("g"), F.col(k).cast("long").alias("n"), F.posexplode(F.array(*map(F.expr, lines))).alias("i", "v")).where("v IS NOT NULL")
    every = heads.unionByName(rows).repartition("g").sortWithinPartitions("g", "n", "i")
    return as_lines(every, f"paste-{country}", "v", "g") + "/*"


@query(
    "s9_s11_pasted_food",
    select(
        {
            "approval_number": "'X' || k", "name": "s_name", "address": "'Road ' || k", "city": "'Santiago'", "postcode": "'1234'", "country": "'Chile'", "grp": "'third-country'", "section": "'RM'", "activity": case("k", "SH", "CP"), "slaughter": case("k", "Y", "N"),
            "species": case("k", "bovine", ""), "date_of_approval": case("k", "13/07/2026", ""),
        },
        "(SELECT *, s_suppkey k FROM supplier)",
    ),
)
def s9(spark, d):
    k = "s_suppkey"
    head = ["junk", pastes.MARK, "", pastes.MARK, "List view ( Chile - Meat of domestic ungulates )", "Country: Chile", "Food RM Meat of domestic ungulates", "Approval number\tName\tStreet\tCity\tRegion"]
    lines = [f"'X' || {k} || '\t' || s_name || '\tRoad ' || {k} || '\t1234 Santiago'", case(k, "SH - Slaughterhouse", "CP - Cutting plant"), case(k, "B Bovinae", None), case(k, "13/07/2026", None)]
    out = pastes.food(spark, _pages(table(spark, d, "supplier"), head, lines, k, "chile"))
    return out.select("approval_number", "name", "address", "city", "postcode", "country", F.col("group").alias("grp"), "section", "activity", "slaughter", "species", "date_of_approval")


@query(
    "s10_f8_pasted_blocks",
    select(
        {"approval_number": "'P' || k", "name": "s_name", "address": "'Road ' || k", "city": "'Lima'", "country": "'Peru'", "section": "'PM'", "activity": case("k", "SH", ""), "slaughter": case("k", "Y", ""), "species": case("k", "poultry", "")},
        "(SELECT *, s_suppkey k FROM supplier)",
    ),
)
def s10(spark, d):
    """Blocks of lines between blank ones; lines of the page's chrome in between are no part of them."""
    k = "s_suppkey"
    head = ["Legal Notice", "Country: Peru", "Food PM Meat from poultry", ""]
    lines = [f"'P' || {k}", case(k, "Contact us", None, None), "s_name", f"'Road ' || {k}", "'Lima'", case(k, None, None, "Privacy Statement"), case(k, "SH - Slaughterhouse", None), case(k, "A Poultry", None), case(k, None, None, None, "Log in"), "''"]
    out = pastes.food(spark, _pages(table(spark, d, "supplier"), head, lines, k, "peru"))
    return out.select("approval_number", "name", "address", "city", "country", "section", "activity", "slaughter", "species")


@query(
    "s12_pasted_health",
    select(
        {
            "approval_number": "'E' || k", "name": "s_name", "address": "'Calle ' || k", "city": "'Villacarriedo'", "postcode": "'39649'", "region": "'Cantabria'", "country": "'Spain'", "section": "'ASC-UNG'", "section_label": "'Assembly centres'",
            "activity": "'Assembly centre'", "species": case("k", "bovine porcine", "bovine"), "last_update": "'01/02/2026'",
        },
        "(SELECT *, s_suppkey k FROM supplier)",
    ),
)
def s12(spark, d):
    """Lines after a row add to it: a running count of row starts makes the records."""
    k = "s_suppkey"
    head = ["Country:", "Spain", "Section:", "Animal ASC-UNG Assembly centres", "Last update:", "01/02/2026", "Approval number|Name|Street|City|Region|Activities|Remarks|"]
    lines = [f"'E' || {k} || '|' || s_name || '|Calle ' || {k} || '|39649 Villacarriedo|Cantabria|• Assembly centre|B Bovinae|'", case(k, "\tP Suidae", None)]
    out = pastes.health(spark, _pages(table(spark, d, "supplier"), head, lines, k, "spain"))
    return out.select("approval_number", "name", "address", "city", "postcode", "region", "country", "section", "section_label", "activity", "species", "last_update")


@query("e8_write_rows", select({"approval_number": "'X' || s_suppkey", "name": "s_name", "remarks": "s_name || ', \"so\" it is'"}, "supplier"))
def e8(spark, d):
    """Rows written as a listing's table and read again: quotes, separators and blanks survive."""
    path = new_dir(spark, "listing")
    rows = table(spark, d, "supplier").select(F.concat(F.lit("X"), F.col("s_suppkey").cast("string")).alias("approval_number"), F.col("s_name").alias("name"), F.concat("s_name", F.lit(', "so" it is')).alias("remarks"))
    pastes.write_rows(rows.withColumns({c: F.lit('a "b", c') for c in pastes.FOOD if c not in rows.columns}), path)
    back = files.read_csv(spark, path)
    return back.where(F.col("city") == 'a "b", c').select("approval_number", "name", "remarks")


@query(
    "a14_c34_s5_s8_overlay",
    "SELECT 'S' || o_custkey AS stem, CAST(o_custkey % 100 AS DOUBLE) AS lon, CAST(o_custkey % 50 AS DOUBLE) AS lat, CAST(max(o_orderkey) AS DOUBLE) AS capacity, count(*) > 0 AS any FROM orders GROUP BY o_custkey",
)
def a14(spark, d):
    """Monthly snapshots in gzip feature lines, lines that aren't JSON among them, folded to a point's latest period."""
    return _overlay(spark, d).select("stem", "lon", "lat", "capacity", F.lit(True).alias("any"))


def _overlay(spark, d, aside: float = 0.0):
    o = table(spark, d, "orders")
    ck, ok = F.col("o_custkey"), F.col("o_orderkey")
    precision = F.when(ck % 3 == 0, "Asset").when(ck % 3 == 1, "admin-centroid")
    props = F.struct(F.concat_ws("_", F.concat(F.lit("S"), ck.cast("string")), ok.cast("string")).alias("name"), F.lit("confined-animal-facility").alias("x_asset_definition"), F.lpad(ok.cast("string"), 12, "0").alias("x_period"), ok.cast("double").alias("x_capacity"), precision.alias("x_precision"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array((ck % 100).cast("double") + aside, (ck % 50).cast("double")).alias("coordinates")).alias("geometry"), props.alias("properties"))
    path = new_dir(spark, "overlay")
    o.select(F.to_json(feature).alias("v")).unionByName(spark.range(3).select(F.lit("not json").alias("v"))).write.option("compression", "gzip").text(path)
    return publish.load_cafo(spark, path)


@query(
    "e3_overlay_codes",
    "SELECT 'S' || o_custkey AS kind, (o_custkey % 100 + 0.1234)::DOUBLE AS lon, CAST(o_custkey % 50 AS DOUBLE) AS lat, (o_custkey % 3 = 0)::INT AS precise, count(*) OVER ()::BIGINT AS ids FROM (SELECT DISTINCT o_custkey FROM orders)",
)
def e3(spark, d):
    """The overlay's points in coded form, with their kinds looked up again, and the number of ids, which are 0, 1, ..."""
    coded, kinds = publish.encode_overlay(_overlay(spark, d, 0.12344))
    span = kinds.agg((F.max("id") - F.min("id") + 1).cast("bigint").alias("ids"))
    return coded.join(kinds, coded["kind"] == kinds["id"]).join(F.broadcast(span)).select(F.col("value").alias("kind"), "lon", "lat", "precise", "ids")


@query(
    "s18_dig_and_alias",
    select({"k": "p_partkey", "deep": "p_name", "number": case("p_partkey", "r1", "r2", "r3", None), "missing": "CAST(NULL AS VARCHAR)"}, "part"),
)
def s18(spark, d):
    """A value at a path, and the first of several names with a value, exact names before folded ones."""
    k = F.col("p_partkey")
    doc = F.to_json(F.struct(F.struct(F.struct(F.col("p_name").alias("c")).alias("b")).alias("a"), F.when(k % 4 == 0, "r1").alias("registerNo"), F.when(k % 4 == 1, "r2").alias("regNo"), F.when(k % 4 == 2, "r3").alias("REGNO"), F.lit("").alias("registerNumber")))
    t = table(spark, d, "part").select(k.alias("k"), doc.alias("doc"))
    return t.select("k", files.dig(F.col("doc"), "a.b.c").alias("deep"), files.alias_get(F.col("doc"), "registerNo", "registerNumber", "regNo").alias("number"), files.dig(F.col("doc"), "a.x").alias("missing"))


@query("s16_s19_e10_landing", "SELECT 'R' || o_custkey AS \"registerNo\", count(*) AS rows FROM (SELECT DISTINCT o_custkey FROM orders) GROUP BY 1")
def s16(spark, d):
    """Harvested rows under several names of the number stream into a table, each registration once, whatever is run again."""
    inbox, out, checkpoint = (new_dir(spark, x) for x in ("inbox", "landed", "landing"))
    o = F.col("o_orderkey")
    number = F.concat(F.lit("R"), F.col("o_custkey").cast("string"))
    row = F.to_json(F.struct(F.when(o % 3 == 0, number).alias("registerNo"), F.when(o % 3 == 1, number).alias("registerNumber"), F.when(o % 3 == 2, number).alias("regNo"), F.lit("A").alias("nameEn")))
    table(spark, d, "orders").select(row.alias("value")).write.text(inbox)
    for _ in range(2):
        landing.land(spark, inbox, out, checkpoint)
    return spark.read.parquet(out).where("enName = 'A'").groupBy("registerNo").agg(F.count(F.lit(1)).alias("rows"))


@query("s20_optional_stores", "SELECT count(*) AS stored, true AS no_table, true AS no_document FROM region")
def s20(spark, d):
    """A store that is there is read; those that aren't give nothing and don't fail."""
    path = new_dir(spark, "store")
    table(spark, d, "region").write.parquet(path)
    gone = [files.load_table(spark, path + "-none") is None, files.load_json_or_none(spark, path + "-none") is None, files.laws(spark, path + "-none") is None]
    return files.load_table(spark, path).agg(F.count(F.lit(1)).alias("stored")).select("stored", F.lit(gone[0]).alias("no_table"), F.lit(gone[1] and gone[2]).alias("no_document"))


@query(
    "j12_s21_laws",
    "SELECT c_custkey AS k, 'N' || c_nationkey AS iso3, CASE WHEN c_nationkey % 3 > 0 THEN 's' || c_nationkey % 2 END AS status, CASE WHEN c_nationkey % 3 > 0 THEN CASE c_nationkey % 2 WHEN 0 THEN 'none' ELSE 'partial' END END AS label, CASE WHEN c_nationkey % 3 > 0 THEN n_name END AS what FROM customer JOIN nation ON n_nationkey = c_nationkey",
)
def j12(spark, d):
    """The law overlay, one document, joined to shapes by area."""
    n = table(spark, d, "nation").where("n_nationkey % 3 > 0").select(F.struct(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"), F.concat(F.lit("s"), (F.col("n_nationkey") % 2).cast("string")).alias("status"), F.col("n_name").alias("what")).alias("x"))
    status = F.struct(*[F.struct(F.lit(label).alias("label"), F.lit(colour).alias("colour")).alias(s) for s, label, colour in (("s0", "none", "#fff"), ("s1", "partial", "#888"))])
    doc = n.agg(F.collect_list("x").alias("countries")).select(F.to_json(F.struct(status.alias("statuses"), "countries")).alias("v"))  # the overlay is one document, as long as there are countries
    overlay = files.laws(spark, as_lines(doc.coalesce(1), "laws", "v"))
    shapes = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("iso3"))
    return publish.with_laws(shapes, overlay).select("k", "iso3", "status", "label", "what")


@query(
    "p14_p15_store",
    "SELECT 's1' AS source_id, 'new ' || s_name AS name, count(*) AS n FROM supplier WHERE s_suppkey % 2 = 0 GROUP BY s_name UNION ALL SELECT 's2', s_name, count(*) FROM supplier GROUP BY s_name",
)
def p14(spark, d):
    """A source that is parsed again replaces its own rows and leaves the others; sources without input are passed over."""
    store = new_dir(spark, "records")
    s = table(spark, d, "supplier")
    old = as_csv(cells(s, {"number": "s_suppkey", "name": "s_name"}), "store-old")
    new = as_csv(cells(s.where("s_suppkey % 2 = 0"), {"number": "s_suppkey", "name": "'new ' || s_name"}), "store-new")
    for source, path in (("s1", old), ("s2", old), ("s1", new)):
        done = registers.load_all(spark, {"generic": path, "nz_mpi": path + "-none"}, store, source_id=source, id_scheme="S", country="AUS")
        assert done == ["generic"]
    return files.load_table(spark, store).groupBy("source_id", "name").agg(F.count(F.lit(1)).alias("n"))


# Codes of ISO 3166 with a name that registers use, for the countries that a table of 25 nations can stand for.
NAMED = [
    ("France", "FRA", "FR"), ("Deutschland / Germany", "DEU", "DE"), ("UK", "GBR", "GB"), ("Viet Nam", "VNM", "VN"), ("Côte d’Ivoire", "CIV", "CI"), ("Korea (Republic of)", "KOR", "KR"), ("中国", "CHN", "CN"), ("US", "USA", "US"), ("BRA", "BRA", "BR"),
    ("New Zealand", "NZL", "NZ"), ("Türkiye", "TUR", "TR"), ("Russian Federation", "RUS", "RU"), ("Czech Republic", "CZE", "CZ"), ("Bosnia and Herzegovina", "BIH", "BA"), ("United Kingdom (Northern Ireland)", "GBR", "GB"), ("Lao People's Democratic Republic", "LAO", "LA"),
    ("Iran, Islamic Republic of", "IRN", "IR"), ("Congo", "COD", "CD"), ("Hong Kong SAR", "HKG", "HK"), ("Faroes", "FRO", "FO"), ("Atlantis", None, None), ("", None, None), ("Moldova (Republic of)", "MDA", "MD"), ("North Macedonia", "MKD", "MK"), ("Eswatini", "SWZ", "SZ"),
]


@query(
    "c12_c13_c14_countries",
    select({"k": "c_custkey", "iso3": case("c_nationkey", *[x[1] for x in NAMED]), "iso2": case("c_nationkey", *[x[2] for x in NAMED])}, "customer"),
)
def c12(spark, d):
    t = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.expr(case("c_nationkey", *[x[0] for x in NAMED])).alias("country"))
    return countries.with_iso2(countries.with_iso3(t, "country", "iso3"), "iso3").select("k", "iso3", "iso2")


@query("c12_unresolved", "SELECT 'Atlantis' AS country, count(*) AS count FROM customer WHERE c_nationkey = 20")
def c12_unresolved(spark, d):
    """Values without a code, with their numbers; blank ones aren't misses."""
    t = table(spark, d, "customer").select(F.expr(case("c_nationkey", *[x[0] for x in NAMED])).alias("country"))
    return countries.unresolved(countries.with_iso3(t, "country", "iso3"), "country", "iso3")


# Address and listing functions: clean cells with the dirt of registers around them, and the clean cells as the result.


@query(
    "c15_c16_clean_part",
    select({"k": "s_suppkey", "clean": "'Mill Lane ' || s_suppkey", "admin": "'Mill Lane ' || s_suppkey"}, "supplier"),
)
def c15(spark, d):
    k = F.col("s_suppkey")
    street = F.concat(F.lit("Mill Lane "), k.cast("string"))
    dirty = F.concat(F.lit("  "), street, F.when(k % 4 == 0, "; 12/34 5.6-7").when(k % 4 == 1, " info@mill.example ,").when(k % 4 == 2, " Tel: 0123 456").otherwise(" ;, -"))
    return table(spark, d, "supplier").select(k.alias("k"), address.clean_part(dirty).alias("clean"), address.first_admin(F.concat(street, F.lit(", Shire; Land"))).alias("admin"))


@query(
    "c17_c18_query_key",
    select(
        {
            "k": "s_suppkey", "qkey": "CASE s_suppkey % 4 WHEN 0 THEN 'v2|fr|mill lane ' || s_suppkey || '|lyon|6900' || s_suppkey % 10 WHEN 1 THEN 'v2|fra|x||' WHEN 2 THEN 'v2|??||shire|' ELSE '' END",
            "street": "s_suppkey % 4 = 0",
        },
        "supplier",
    ),
)
def c17(spark, d):
    """Country, street, city and postcode in lower case; the city falls back on the region; nothing to ask for gives ''."""
    k = F.col("s_suppkey")
    pick = lambda *v: F.when(k % 4 == 0, v[0]).when(k % 4 == 1, v[1]).when(k % 4 == 2, v[2]).otherwise(v[3])
    street = pick(F.concat(F.lit("Mill Lane "), k.cast("string"), F.lit(" fax 1")), F.lit("X"), F.lit(""), F.lit(None))
    key = address.query_key(pick(F.lit("FR"), F.lit(""), F.lit(None), F.lit("DE")), pick(F.lit("FRA"), F.lit("FRA"), F.lit(None), F.lit("DEU")), street, pick(F.lit("Lyon"), F.lit(None), F.lit(""), F.lit(" ")), pick(F.lit("Rhone"), F.lit(""), F.lit("Shire, Land"), F.lit("")), pick(F.concat(F.lit("69 00"), (k % 10).cast("string")), F.lit(None), F.lit(""), F.lit("")))
    return table(spark, d, "supplier").select(k.alias("k"), key.alias("qkey"), address.has_street(street).alias("street"))


@query(
    "c19_precision",
    select({"k": "p_partkey", "nominatim": case("p_partkey", "rooftop", "rooftop", "rooftop", "street", "street", "locality", "admin"), "photon": case("p_partkey", "rooftop", "rooftop", "rooftop", "street", "street", "locality", "admin")}, "part"),
)
def c19(spark, d):
    k = F.col("p_partkey")
    at = lambda *v: F.get(F.array(*[F.lit(x).cast("string") for x in v]), (k % 7).cast("int"))
    n = address.nominatim_precision(at("7", None, None, None, None, None, None), at(None, None, None, "Main St", None, None, None), at(None, "shop", "x", "x", "x", "x", "x"), at(None, None, "farm", None, "road", "village", "county"))
    p = address.photon_precision(at("7", None, None, None, None, None, None), at(None, None, None, "Main St", None, None, None), at(None, "shop", "x", "x", "highway", "x", "x"), at(None, None, "building", "x", "x", "x", "x"), at(None, None, None, None, None, "city", "county"))
    return table(spark, d, "part").select(k.alias("k"), n.alias("nominatim"), p.alias("photon"))


@query(
    "c20_c21_c25_regions",
    select(
        {"k": "s_suppkey", "region": case("s_suppkey", "North; South", "North", ""), "species": case("s_suppkey", "bovine,lagomorph", "", "ovine"), "grp": case("s_suppkey", "EU-EFTA", "third-country")},
        "supplier",
    ),
)
def c20(spark, d):
    k = F.col("s_suppkey")
    region = F.expr(case("s_suppkey", "North; B Bovinae; South 20345 01/02/2020; North; L Lagomorphs; 12 remarks here", "CAT1; North; 12345 01/02/2020; SH - Slaughterhouse", "O Ovis aries; 123456"))
    group = address.group_for(F.expr(case("s_suppkey", " Norway", "Norwich")))
    return table(spark, d, "supplier").select(k.alias("k"), address.clean_region(region).alias("region"), F.array_join(address.recover_species(region), ",").alias("species"), group.alias("grp"))


@query(
    "c22_c23_cities",
    select(
        {"k": "s_suppkey", "food_city": "'Town ' || s_suppkey", "food_code": case("s_suppkey", "1234", "1234 AB", "EC1A 1BB", "X-77", ""), "health_city": "'Town'", "health_code": case("s_suppkey", "39649", "L1234", "")},
        "supplier",
    ),
)
def c22(spark, d):
    k = F.col("s_suppkey")
    city, code = address.split_food_city(F.concat(F.expr(case("s_suppkey", "1234  ", "1234 AB ", "EC1A 1BB ", "X-77 ", " ")), F.lit("Town "), k.cast("string")))
    town, post = address.split_health_city(F.concat(F.expr(case("s_suppkey", "39649 ", "L1234  ", "")), F.lit("Town")))
    return table(spark, d, "supplier").select(k.alias("k"), city.alias("food_city"), code.alias("food_code"), town.alias("health_city"), post.alias("health_code"))


@query(
    "c24_c26_bullets",
    select({"k": "s_suppkey", "items": "'One|Two ' || s_suppkey || '|Three'", "letter": case("s_suppkey", "Y", "N", "", "")}, "supplier"),
)
def c24(spark, d):
    k = F.col("s_suppkey")
    cell = F.concat(F.lit("• One\t Two  "), k.cast("string"), F.lit(" ••\t| Three |"))
    codes = F.expr("CASE s_suppkey % 4 WHEN 0 THEN array('CP', 'SH') WHEN 1 THEN array('CP') WHEN 2 THEN array() ELSE array('CP') END")
    letter = address.slaughter_letter(codes, F.expr(case("s_suppkey", "RM", "RM", "RM", "FFP")), ["FFP"])
    return table(spark, d, "supplier").select(k.alias("k"), F.array_join(address.bullets(cell), "|").alias("items"), letter.alias("letter"))


@query("c27_f10_headers", "SELECT c_custkey AS k, c_name AS name, c_mktsegment AS phone, CAST(NULL AS VARCHAR) AS fax, true AS raised FROM customer")
def c27(spark, d):
    """A table's columns found by folded name, else by a part of it; a missing one is null or, if required, an error."""
    t = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias(" Plant  NAME "), F.col("c_mktsegment").alias("Phone No."))
    name, phone, fax = (text.resolve(t.columns, *x) for x in (("name",), ("telephone", "phone_no"), ("fax",)))
    try:
        text.resolve(t.columns, "fax", required=True)
        raised = False
    except text.HeaderError:
        raised = True
    return t.select(F.col("c_custkey").alias("k"), F.col(f"`{name}`").alias("name"), F.col(f"`{phone}`").alias("phone"), F.lit(fax).cast("string").alias("fax"), F.lit(raised).alias("raised"))


@query("c10_same_name", select({"k": "c_custkey", "same": "c_custkey % 3 = 0", "distinct_words": case("c_custkey", "b,a", "a", "c,b,a")}, "customer"))
def c10(spark, d):
    """Folded names that aren't empty are the same name; lists keep the first of equals, in order."""
    k = F.col("c_custkey")
    a = text.norm_text(F.when(k % 3 < 2, F.concat(F.lit("Café "), "c_name")).otherwise(""))
    b = text.norm_text(F.when(k % 3 == 0, F.concat(F.lit("CAFE "), "c_name")).when(k % 3 == 1, "c_name").otherwise(" "))
    words = F.expr("CASE c_custkey % 3 WHEN 0 THEN array('b', 'a', 'b') WHEN 1 THEN array('a', 'a') ELSE array('c', 'b', 'a', 'b') END")
    return table(spark, d, "customer").select(k.alias("k"), text.same_name(a, b).alias("same"), F.array_join(text.ordered_distinct(words), ",").alias("distinct_words"))


@query("c35_fates", "SELECT l_orderkey AS k, l_linenumber AS n, CASE l_shipmode_no WHEN 0 THEN 'here' WHEN 1 THEN 'elsewhere' WHEN 2 THEN 'after' WHEN 3 THEN 'some' WHEN 4 THEN 'transit' WHEN 5 THEN 'no' END AS fate, CASE l_shipmode_no WHEN 0 THEN 'Slaughterhouse' WHEN 1 THEN 'Dairy farm' WHEN 2 THEN 'Cold store' WHEN 3 THEN 'Zoo' WHEN 4 THEN 'Authorised transporter' WHEN 5 THEN 'Apiary' ELSE 'Activity not stated' END AS label FROM (SELECT *, (l_orderkey + l_linenumber) % 7 l_shipmode_no FROM lineitem)")
def c35(spark, d):
    """What becomes of animals at a place of each activity, and the activity's label."""
    act = F.expr(case("(l_orderkey + l_linenumber)", "slaughter", "farm_dairy", "cold_store", "zoo", "transporter", "farm_honey", "unknown"))
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), publish.fate(act).alias("fate"), publish.activity_label(act).alias("label"))
