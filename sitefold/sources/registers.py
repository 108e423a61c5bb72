"""One projection for each register, to the canonical row (sitefold.schema.SOURCE_RECORD) and seq."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sitefold import vocabulary as V
from sitefold.functions.address import clean_region, group_for, recover_species
from sitefold.functions.countries import with_iso3
from sitefold.functions.geo import degrees
from sitefold.functions.text import blank_to_null, bracket_split, contained, lookup, mapped, matches, resolve, resolve_exact, strip_accents, truthy
from sitefold.plans.store import Conflict, Table
from sitefold.schema import FIELDS, TYPES
from sitefold.sources.files import file_stem, read_csv, read_documents, read_features, read_json_document, read_json_lines, with_seq


def _null() -> Column:
    return F.lit(None).cast("string")


def _no_list() -> Column:
    return F.array().cast("array<string>")


def _unknown() -> Column:
    return F.array(F.lit("unknown"))


def canonical(df: DataFrame, **columns: Column) -> DataFrame:
    """The canonical fields from columns; those not given are null, or empty lists."""
    empty = {"species": _no_list(), "activities": _no_list()}
    return df.select(*[columns.get(f, empty.get(f, _null())).cast(TYPES[f]).alias(f) for f in FIELDS], F.col("seq"))


def _raw(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in ("file", "seq") and not c.startswith("_")]))


def _cell(df: DataFrame, header: str | None) -> Column:
    return blank_to_null(F.col(f"`{header}`").cast("string")) if header else _null()


def _row_id(c: Column) -> Column:
    return F.coalesce(c, F.concat(F.lit("row"), F.col("seq").cast("string")))


def vote(*flags: Column) -> Column:
    """Any true is true, else any stated is false, else null."""
    some = F.coalesce(*flags).isNotNull()
    yes = F.greatest(*[F.coalesce(f.cast("int"), F.lit(0)) for f in flags]) == 1
    return F.when(yes, True).when(some, False)


def fsis(spark: SparkSession, directory, demographic=None, snapshot: str = "") -> DataFrame:
    """A directory with an optional table of flags, joined by number; the last row of a number wins."""
    d = with_seq(read_csv(spark, directory))
    h = lambda *c, **k: resolve(d.columns, *c, **k)
    num = F.upper(_cell(d, h("establishment_number", "est_number", "establishmentnumber", required=True)))
    raw = _raw(d)
    d = d.withColumns({"_num": num, "_raw": raw}).where("_num IS NOT NULL")
    flags: list[str] = []
    if demographic is not None:
        g = with_seq(read_csv(spark, demographic))
        key = resolve(g.columns, "establishment_number", "est_number", required=True)
        flags = [c for c in g.columns if c not in (key, "file", "seq")]
        g = g.select(F.upper(F.trim(F.col(f"`{key}`"))).alias("_num"), F.col("seq").alias("_s"), *[F.col(f"`{c}`").alias(f"d_{i}") for i, c in enumerate(flags)])
        last = g.groupBy("_num").agg(F.max_by(F.struct(*[f"d_{i}" for i in range(len(flags))]), "_s").alias("_d"))
        d = d.join(last, "_num", "left")
    flag = lambda name: truthy(F.col(f"_d.d_{flags.index(x)}")) if (x := resolve_exact(flags, name)) else _null().cast("boolean")
    species = [F.when(truthy(F.col(f"_d.d_{i}")), F.lit(s)) for i, c in enumerate(flags) for s, words in V.FLAG_SPECIES.items() if re.search(words, c.lower().replace("_", " "))]
    kills = vote(*[flag(c) for c in ("slaughter", "meat_slaughter", "poultry_slaughter")])
    acts = [F.when(kills, F.lit("slaughter"))] + [F.when(flag(c), F.lit(a)) for c, a in V.FLAG_ACTIVITIES.items()]
    lat, lon = degrees(_cell(d, h("latitude", "lat")), -90, 90), degrees(_cell(d, h("longitude", "lon", "lng")), -180, 180)
    placed = lat.isNotNull() & lon.isNotNull() & ~((lat == 0) & (lon == 0))
    volume = resolve_exact(flags, "slaughter_volume_category")
    return canonical(
        d, source_id=F.lit("us_fsis_mpi"), source_snapshot=F.lit(snapshot), source_row_id=F.col("_num"), name=_cell(d, h("establishment_name", "company", "name")),
        country_iso3=F.lit("USA"), national_id=F.col("_num"), id_scheme=F.lit("US-FSIS"), address=_cell(d, h("street", "address")), locality=_cell(d, h("city")),
        admin1=_cell(d, h("state")), postcode=_cell(d, h("zip", "postcode")), species=F.array_sort(F.array_distinct(F.array_compact(F.array(*species)))) if species else _no_list(),
        activities=_or_unknown(F.array_distinct(F.array_compact(F.array(*acts)))), slaughter=kills,
        size_class=F.coalesce(_cell(d, h("size")), blank_to_null(F.col(f"_d.d_{flags.index(volume)}")) if volume else _null()), operator=_cell(d, h("dbas", "doing business as")),
        src_lat=F.when(placed, lat), src_lon=F.when(placed, lon), src_precision=F.when(placed, "rooftop"), raw=F.col("_raw"),
    )


def _or_unknown(acts: Column) -> Column:
    return F.when(F.size(acts) > 0, acts).otherwise(_unknown())


def eu_list(spark: SparkSession, path, source_id: str = "eu_member_states", id_scheme: str = "EU-APPROVAL", country: str | None = None, snapshot: str = "") -> DataFrame:
    """Approval lists. A recognised activity code other than SH denies slaughter, none says nothing, and an
    explicit flag overrides both. A section that isn't a known code or numeral names no species."""
    d = with_seq(read_csv(spark, path))
    h = lambda *c: resolve(d.columns, *c)
    d = d.withColumn("_raw", _raw(d)).withColumn("_num", _cell(d, h("approval_number", "approval", "number"))).withColumn("_name", _cell(d, h("name")))
    d = d.where("_num IS NOT NULL OR _name IS NOT NULL")
    section = F.upper(F.coalesce(_cell(d, resolve_exact(d.columns, "section")), F.lit("")))
    section = F.regexp_replace(section, "^SECTION\\s+", "")
    region = _cell(d, h("region", "state"))
    text = F.coalesce(_cell(d, h("activity", "activities")), F.lit(""))
    codes = F.array_distinct(F.regexp_extract_all(text, F.lit("\\b(SH|CP|GHE|PP|MSM|MM|MP|CS)\\b"), F.lit(1)))
    stated = truthy(_cell(d, resolve_exact(d.columns, "slaughter")))
    listed = F.array_intersect(F.split(F.lower(F.coalesce(_cell(d, h("species")), F.lit(""))), "[\\s,;]+"), F.array(*map(F.lit, V.SPECIES)))
    listed = F.array_distinct(F.concat(listed, recover_species(region)))
    fallback = F.filter(F.split(F.coalesce(lookup(section, V.SECTION_SPECIES), F.lit("")), " "), lambda x: x != "")
    d = d.withColumns({"_codes": codes, "_species": F.when(F.size(listed) > 0, listed).otherwise(fallback)})
    acts = F.array_sort(F.array_distinct(F.array_compact(F.transform("_codes", lambda x: lookup(x, V.ACTIVITY_CODES)))))
    kills = F.coalesce(stated, F.when(F.array_contains("_codes", "SH"), True).when(F.size("_codes") > 0, False))
    group = _cell(d, resolve_exact(d.columns, "group"))
    source = F.when(group == "EU-EFTA", "eu_traces_member_state").when(group == "third-country", "eu_traces_third_country").otherwise(F.lit(source_id))
    d = d.withColumn("_country", F.coalesce(F.lit(country), _cell(d, resolve_exact(d.columns, "country")), F.regexp_replace(file_stem(), "_", " ")))
    d = with_iso3(d, "_country", "_iso3")
    return canonical(
        d, source_id=source, source_snapshot=F.lit(snapshot), source_row_id=_row_id(F.col("_num")), name=F.col("_name"), country_iso3=F.col("_iso3"),
        national_id=F.col("_num"), id_scheme=F.lit(id_scheme), address=_cell(d, h("address", "street")), locality=_cell(d, h("city", "town")),
        admin1=blank_to_null(clean_region(region)), postcode=_cell(d, h("postcode", "zip")), species=F.col("_species"), activities=_or_unknown(acts), slaughter=kills, raw=F.col("_raw"),
    )


def eu_health(spark: SparkSession, path, snapshot: str = "") -> DataFrame:
    """Premises approved for live animals; only one section kills."""
    d = with_seq(read_csv(spark, path))
    h = lambda *c: resolve(d.columns, *c)
    d = d.withColumns({"_raw": _raw(d), "_num": _cell(d, h("approval_number")), "_name": _cell(d, h("name"))}).where("_num IS NOT NULL OR _name IS NOT NULL")
    section, text = F.upper(F.coalesce(_cell(d, resolve_exact(d.columns, "section")), F.lit(""))), F.lower(F.coalesce(_cell(d, h("activity")), F.lit("")))
    act = F.coalesce(lookup(section, V.HEALTH_SECTIONS), lookup(F.trim(text), V.HEALTH_TEXTS), F.lit("unknown"))
    listed = F.array_intersect(F.split(F.lower(F.coalesce(_cell(d, h("species")), F.lit(""))), "[\\s,;|]+"), F.array(*map(F.lit, V.SPECIES)))
    spoken = matches(text, {s: rf"\b{s}" for s in V.HEALTH_SPECIES})
    d = with_iso3(d.withColumns({"_sp": F.when(F.size(listed) > 0, listed).otherwise(spoken), "_country": _cell(d, h("country"))}), "_country", "_iso3")
    return canonical(
        d, source_id=F.lit("eu_traces_animal_health"), source_snapshot=F.lit(snapshot), source_row_id=_row_id(F.col("_num")), name=F.col("_name"), country_iso3=F.col("_iso3"),
        national_id=F.col("_num"), id_scheme=F.lit("TRACES-AH"), address=_cell(d, h("address")), locality=_cell(d, h("city")), admin1=_cell(d, h("region")),
        postcode=_cell(d, h("postcode")), species=F.array_distinct(F.col("_sp")), activities=F.array(act), slaughter=section == "AQUA-EST-DISEASE", raw=F.col("_raw"),
    )


def eu_ied(spark: SparkSession, path, snapshot: str = "", outlines=None, open_rings: bool = False) -> DataFrame:
    """Installations of the listed activities; a country that has no name is found from the position, given outlines."""
    from sitefold.operators.outlines import with_country

    d = with_seq(read_csv(spark, path))
    h = lambda *c: resolve(d.columns, *c)
    rows = spark.createDataFrame([(k, a, s or None, f) for k, (a, s, f) in V.IED.items()], "_code string, _act string, _sp string, _kills boolean")
    d = d.withColumns({"_raw": _raw(d), "_code": _cell(d, h("IEDAnnexIMainActivity")), "_name": _cell(d, h("installationName")), "_id": _cell(d, h("InstallationInspireId")), "_country": _cell(d, h("CountryName"))})
    d = with_iso3(d.join(F.broadcast(rows), "_code").where("_name IS NOT NULL OR _id IS NOT NULL"), "_country", "_iso3")
    lat, lon = degrees(_cell(d, h("Latitude")), -90, 90), degrees(_cell(d, h("Longitude")), -180, 180)
    placed = lat.isNotNull() & lon.isNotNull()
    d = with_country(d, outlines, lat, lon, "_iso3", open_rings=open_rings) if outlines else d
    return canonical(
        d, source_id=F.lit("eu_ied"), source_snapshot=F.lit(snapshot), source_row_id=_row_id(F.col("_id")), name=F.col("_name"), country_iso3=F.col("_iso3"), national_id=F.col("_id"),
        id_scheme=F.lit("EU-INSPIRE"), locality=_cell(d, h("City_of_Facility", "city")), species=F.array_compact(F.array("_sp")), activities=F.array("_act"), slaughter=F.col("_kills"),
        src_lat=F.when(placed, lat), src_lon=F.when(placed, lon), src_precision=F.when(placed, "rooftop"), raw=F.col("_raw"),
    )


def ca_cfia(spark: SparkSession, path, snapshot: str = "") -> DataFrame:
    """P5: ten code columns; the letters of the first name species. unmapped_letters() reports the others."""
    d = with_seq(read_csv(spark, path))
    code = {c: _cell(d, resolve_exact(d.columns, c)) for c in V.CFIA_COLUMNS}
    d = d.withColumns({"_raw": _raw(d), "_name": _cell(d, resolve_exact(d.columns, "NAME1")), "_num": _cell(d, resolve_exact(d.columns, "EST_NUM1"))}).where("_name IS NOT NULL")
    letters = F.filter(F.split(F.lower(F.coalesce(code["CODES_11"], F.lit(""))), ""), lambda x: x.rlike("[a-z]"))
    species = F.array_sort(F.array_distinct(F.array_compact(F.transform(letters, lambda x: lookup(x, V.CFIA_SPECIES)))))
    acts = F.array_distinct(F.array_compact(F.array(*[F.when(code[c].isNotNull(), F.lit(a)) for c, a in V.CFIA_COLUMNS.items()])))
    at = lambda *names: F.concat_ws(", ", *[_cell(d, resolve_exact(d.columns, n)) for n in names])
    return canonical(
        d, source_id=F.lit("ca_cfia"), source_snapshot=F.lit(snapshot), source_row_id=_row_id(F.col("_num")), name=F.col("_name"), country_iso3=F.lit("CAN"), national_id=F.col("_num"),
        id_scheme=F.lit("CA-EST"), address=blank_to_null(at("LOC_ADD11", "LOC_ADD21", "LOC_ADD31")), locality=_cell(d, resolve_exact(d.columns, "LOC_CITY1")),
        admin1=_cell(d, resolve_exact(d.columns, "LOC_PROV1")), postcode=_cell(d, resolve_exact(d.columns, "LOC_PC1")), species=species, activities=_or_unknown(acts),
        slaughter=code["CODES_11"].isNotNull(), operator=_cell(d, resolve_exact(d.columns, "ADB_NAME1")), raw=F.col("_raw"),
    )


def unmapped_letters(spark: SparkSession, path) -> DataFrame:
    """Species letters without a meaning, with their numbers."""
    d = read_csv(spark, path)
    letters = d.select(F.explode(F.split(F.lower(F.coalesce(_cell(d, resolve_exact(d.columns, "CODES_11")), F.lit(""))), "")).alias("letter"))
    return letters.where(F.col("letter").rlike("[a-z]") & ~F.col("letter").isin(*V.CFIA_SPECIES)).groupBy("letter").count()


def nz_mpi(spark: SparkSession, path, snapshot: str = "") -> DataFrame:
    """The first row of an id; rows without one all stay."""
    d = with_seq(read_csv(spark, path))
    h = lambda *c: resolve(d.columns, *c)
    trading = F.coalesce(_cell(d, h("Operator Trading Name")), _cell(d, h("Operator Business Name")))
    d = d.withColumns({"_raw": _raw(d), "_num": _cell(d, h("MPI ID Number")), "_name": trading}).where("_name IS NOT NULL")
    own = F.coalesce("_num", F.concat(F.lit("#"), F.col("seq").cast("string")))
    d = d.withColumn("_first", F.row_number().over(Window.partitionBy(own).orderBy("seq"))).where("_first = 1")
    low = lambda *c: F.lower(F.concat_ws(" ", *[_cell(d, h(x)) for x in c]))
    process, programme, material = low("Primary", "Secondary Process"), low("Programme Type"), low("Product/Material")
    eggs = F.when(F.concat(material, programme, process).rlike("layer|rearer"), F.array(F.lit("farm_eggs"))).otherwise(_no_list())
    acts = F.array_distinct(F.concat(contained(process, V.NZ_PROCESS), contained(programme, V.NZ_PROGRAMME), eggs))
    return canonical(
        d, source_id=F.lit("nz_mpi"), source_snapshot=F.lit(snapshot), source_row_id=_row_id(F.col("_num")), name=F.col("_name"), country_iso3=F.lit("NZL"), national_id=F.col("_num"),
        id_scheme=F.lit("NZ-MPI"), address=_cell(d, h("Physical Address")), locality=_cell(d, h("Physical Town/City")), admin1=F.coalesce(_cell(d, h("Location Local Authority")), _cell(d, h("Operator Local Authority"))),
        species=matches(material, V.NZ_SPECIES), activities=_or_unknown(acts), slaughter=process.contains("slaughter") | programme.contains("micro abattoir"),
        operator=_cell(d, h("Operator Business Name")), raw=F.col("_raw"),
    )


def br_sif(spark: SparkSession, path, snapshot: str = "") -> DataFrame:
    """Rows of one number and tax id are one plant: the first row's cells, every row's activities and species."""
    d = with_seq(read_csv(spark, path, sep=";"))
    h = lambda *c: resolve(d.columns, *c)
    name = F.coalesce(_cell(d, h("NOME_FANTASIA")), _cell(d, h("RAZAO_SOCIAL")))
    kind = F.upper(F.concat_ws(" ", _cell(d, h("CATEGORIA_CLASSE")), _cell(d, h("AREA_CATEGORIA"))))
    cols = {"_num": h("NR_SIF"), "_cnpj": h("CPF_CNPJ"), "_op": h("RAZAO_SOCIAL"), "_street": h("LOGRADOURO"), "_quarter": h("BAIRRO"), "_city": h("MUNICIPIO"), "_uf": h("UF"), "_cep": h("CEP")}
    d = d.withColumns({"_raw": _raw(d), "_name": name, "_kind": kind, **{k: _cell(d, c) for k, c in cols.items()}})
    d = d.where("(_num IS NOT NULL OR _cnpj IS NOT NULL) AND _name IS NOT NULL")
    d = d.withColumns({"_acts": contained(F.col("_kind"), V.SIF_ACTIVITIES), "_species": matches(F.col("_kind"), V.SIF_SPECIES), "_key": F.concat_ws("|", F.coalesce("_num", F.lit("")), F.coalesce("_cnpj", F.lit("")))})
    first = F.struct("_num", "_cnpj", "_op", "_name", "_street", "_quarter", "_city", "_uf", "_cep")
    merged = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    f = d.groupBy("_key").agg(F.min_by(first, "seq").alias("x"), F.min("seq").alias("seq"), merged("_acts").alias("_acts"), merged("_species").alias("_species"), F.array_sort(F.collect_set("_kind")).alias("_kinds"))
    return canonical(
        f, source_id=F.lit("br_mapa_sif"), source_snapshot=F.lit(snapshot), source_row_id=F.col("_key"), name=F.col("x._name"), country_iso3=F.lit("BRA"), national_id=F.col("x._num"),
        id_scheme=F.lit("BR-SIF"), address=blank_to_null(F.concat_ws(", ", "x._street", "x._quarter")), locality=F.col("x._city"), admin1=F.col("x._uf"), postcode=F.col("x._cep"),
        species=F.col("_species"), activities=_or_unknown(F.col("_acts")), slaughter=F.array_contains("_acts", "slaughter"), operator=F.col("x._op"), raw=F.to_json(F.struct("x", "_kinds")),
    )


def masked_tax_id(c: Column) -> Column:
    """A person's number of 11 digits is masked; a company's stays."""
    digits = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    return F.when(F.length(digits) == 11, F.concat(F.lit("***"), F.substring(digits, 10, 2))).otherwise(c)


def crowded(df: DataFrame, lat: str, lon: str, locality: str) -> DataFrame:
    """Adds _shared and _towns: rows at the same point (to five places), and distinct localities there."""
    at = df.groupBy(F.round(lat, 5).alias("_y"), F.round(lon, 5).alias("_x")).agg(F.count(F.lit(1)).alias("_shared"), F.count_distinct(F.coalesce(locality, F.lit(""))).alias("_towns"))
    return df.join(at, (F.round(df[lat], 5) == F.col("_y")) & (F.round(df[lon], 5) == F.col("_x")), "left").drop("_y", "_x")


def br_trase(spark: SparkSession, path, snapshot: str = "", mask: bool = True) -> DataFrame:
    """Rows of one site folded; a position that sites of several towns share is dropped, one that three or more
    sites of a town share is only a locality."""
    need = ("company", "commodity", "inspection_level", "lat", "long", "type_english")
    d = read_features(spark, path, need).select("properties.*").withColumn("file", F.lit(""))
    d = with_seq(d, *[c for c in ("facility_id", "commodity") if c in d.columns])
    get = lambda c: _cell(d, c if c in d.columns else None)
    own = F.coalesce(get("facility_id"), get("unique_id"), F.concat(F.lit("row"), F.col("seq").cast("string")))
    words = F.concat_ws(" ", get("type_english"), get("type_portuguese"))
    folded = F.concat_ws(" ", F.lower(strip_accents(words)), F.lower(words))
    d = d.withColumns({"_key": own, "_words": folded, "_goods": F.lower(F.coalesce(get("commodity"), F.lit(""))), "_tax": masked_tax_id(get("cnpj")) if mask else get("cnpj")})
    farm = F.when(F.col("_words").rlike("granja|poultry farm") & F.col("_goods").isin("chicken", "egg"), F.array(F.when(F.col("_goods") == "egg", "farm_eggs").otherwise("farm_poultry"))).otherwise(_no_list())
    species = F.array_distinct(F.concat(F.array_compact(F.array(lookup(F.col("_goods"), V.TRASE_COMMODITIES))), matches(F.col("_words"), V.TRASE_SPECIES)))
    d = d.withColumns({"_acts": F.array_distinct(F.concat(matches(F.col("_words"), V.TRASE_ACTIVITIES), farm)), "_species": species, "_name": get("company"), "_level": get("inspection_level"), "_num": get("inspection_num"), "_city": get("municipality"), "_uf": get("state"), "_lat": degrees(get("lat"), -90, 90), "_lon": degrees(get("long"), -180, 180)})
    first = F.struct("_name", "_level", "_num", "_city", "_uf", "_lat", "_lon", "_tax")
    merged = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    rows = F.struct("_goods", "_words", "_num")
    f = d.groupBy("_key").agg(F.min_by(first, "seq").alias("x"), F.min("seq").alias("seq"), merged("_acts").alias("_acts"), merged("_species").alias("_species"), F.sort_array(F.collect_set(rows)).alias("rows")).select("_key", "seq", "x.*", "_acts", "_species", "rows")
    f = crowded(f, "_lat", "_lon", "_city")
    placed = F.col("_lat").isNotNull() & F.col("_lon").isNotNull() & (F.coalesce("_towns", F.lit(1)) <= 1)
    sif = F.upper(F.coalesce("_level", F.lit(""))).contains("SIF")
    return canonical(
        f, source_id=F.lit("br_trase"), source_snapshot=F.lit(snapshot), source_row_id=F.col("_key"), name=F.col("_name"), country_iso3=F.lit("BRA"),
        national_id=F.when(sif, F.col("_num")).otherwise(F.col("_key")), id_scheme=F.when(sif, "BR-SIF").otherwise("BR-TRASE"), foreign_id=F.when(sif, F.col("_key")),
        foreign_id_scheme=F.when(sif, "BR-TRASE"), locality=F.col("_city"), admin1=F.col("_uf"), species=F.col("_species"), activities=_or_unknown(F.col("_acts")),
        slaughter=F.when(F.array_contains("_acts", "slaughter"), True).when(F.size("_acts") > 0, False), src_lat=F.when(placed, F.col("_lat")), src_lon=F.when(placed, F.col("_lon")),
        src_precision=F.when(placed, F.when(F.col("_shared") >= 3, "locality").otherwise("rooftop")), raw=F.to_json(F.struct(F.col("_tax").alias("cnpj"), "rows", (F.col("_shared") - 1).alias("position_shared_with"))),
    )


def cifer(spark: SparkSession, path, snapshot: str = "") -> DataFrame:
    """Customs registrations as JSON lines."""
    d = with_seq(read_json_lines(spark, path))
    has = lambda c: F.col(c) if c in d.columns else _null()
    kinds = F.lower(F.coalesce(F.to_json(F.col("productCategory")) if "productCategory" in d.columns else _null(), F.lit("")))
    given = F.coalesce(F.col("_species"), _no_list()) if "_species" in d.columns else _no_list()
    own, foreign = blank_to_null(has("registerNo").cast("string")), blank_to_null(has("foreignRegisterNo").cast("string"))
    raw = F.to_json(F.struct(*[F.col(c) for c in d.columns if c not in ("file", "seq")]))
    d = d.withColumns({"_raw": raw, "_own": own, "_foreign": foreign, "_kinds": kinds, "_sp": F.when(F.size(given) > 0, given).otherwise(matches(kinds, V.CIFER_SPECIES)), "_country": F.coalesce(blank_to_null(has("_country_iso3")), blank_to_null(has("countryCode")))})
    d = with_iso3(d, "_country", "_iso3")
    kills = F.col("_kinds").rlike("slaughter|屠宰")
    return canonical(
        d, source_id=F.lit("cifer_china"), source_snapshot=F.lit(snapshot), source_row_id=_row_id(F.col("_own")), name=F.coalesce(blank_to_null(has("enName")), blank_to_null(has("name"))), country_iso3=F.col("_iso3"),
        national_id=F.col("_own"), id_scheme=F.lit("CN-CIFER"), foreign_id=F.col("_foreign"), foreign_id_scheme=F.when(F.col("_foreign").isNotNull(), lookup(F.col("_iso3"), V.FOREIGN_SCHEMES)),
        address=F.coalesce(blank_to_null(has("enAddress")), blank_to_null(has("address"))), species=F.array_distinct("_sp"),
        activities=F.when(kills, F.array(F.lit("slaughter"))).otherwise(_unknown()), slaughter=F.when(kills, True), raw=F.col("_raw"),
    )


OVERPASS = "elements array<struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>"


def osm(spark: SparkSession, path, snapshot: str = "", outlines=None, open_rings: bool = False) -> DataFrame:
    """P10: elements with a position, their own or their centre's."""
    from sitefold.operators.outlines import with_country

    d = read_json_document(spark, path, OVERPASS).select(F.posexplode("elements").alias("seq", "e")).withColumn("seq", F.col("seq").cast("long"))
    d = d.select("seq", "e.*").withColumns({"_lat": F.coalesce("lat", "center.lat"), "_lon": F.coalesce("lon", "center.lon")}).where("_lat IS NOT NULL AND _lon IS NOT NULL")
    tag = lambda k: blank_to_null(F.element_at("tags", k))
    d = with_iso3(d.withColumn("_country", tag("addr:country")), "_country", "_iso3")
    d = with_country(d, outlines, F.col("_lat"), F.col("_lon"), "_iso3", open_rings=open_rings) if outlines else d
    return canonical(
        d, source_id=F.lit("osm_overpass"), source_snapshot=F.lit(snapshot), source_row_id=F.concat_ws("/", "type", F.col("id").cast("string")), name=tag("name"), country_iso3=F.col("_iso3"),
        address=blank_to_null(F.concat_ws(" ", tag("addr:housenumber"), tag("addr:street"))), locality=tag("addr:city"), postcode=tag("addr:postcode"), operator=tag("operator"),
        activities=F.array(F.lit("slaughter")), slaughter=F.lit(True), src_lat=F.col("_lat"), src_lon=F.col("_lon"), src_precision=F.lit("rooftop"), raw=F.to_json("tags"),
    )


def generic(spark: SparkSession, path, source_id: str, id_scheme: str, country: str, snapshot: str = "", slaughter: bool | None = None) -> DataFrame:
    """Any list with a number and a name."""
    d = with_seq(read_csv(spark, path))
    h = lambda *c, **k: resolve(d.columns, *c, **k)
    d = d.withColumns({"_raw": _raw(d), "_num": _cell(d, h("number", "establishment_number", "approval", "id")), "_name": _cell(d, h("name", "establishment", required=True))}).where("_name IS NOT NULL")
    return canonical(
        d, source_id=F.lit(source_id), source_snapshot=F.lit(snapshot), source_row_id=_row_id(F.col("_num")), name=F.col("_name"), country_iso3=F.lit(country), national_id=F.col("_num"),
        id_scheme=F.lit(id_scheme), address=_cell(d, h("address", "street")), locality=_cell(d, h("city", "town", "suburb")), admin1=_cell(d, h("state", "region")),
        postcode=_cell(d, h("postcode", "zip")), activities=F.array(F.lit("slaughter")) if slaughter else _unknown(), slaughter=F.lit(slaughter), raw=F.col("_raw"),
    )


def ftp_csv(spark: SparkSession, path, country: str | None = None, snapshot: str = "") -> DataFrame:
    """Categories and species in lists with brackets."""
    d = with_seq(read_csv(spark, path))
    h = lambda *c: resolve_exact(d.columns, *c)
    lat, lon = degrees(_cell(d, h("lat", "latitude")), -90, 90), degrees(_cell(d, h("lng", "lon", "longitude")), -180, 180)
    d = d.withColumns({"_raw": _raw(d), "_id": _cell(d, h("id")), "_lat": lat, "_lon": lon, "_cats": bracket_split(_cell(d, h("categories"))), "_kinds": bracket_split(_cell(d, h("species"))), "_country": F.coalesce(F.lit(country), _cell(d, h("country")))})
    d = with_iso3(d, "_country", "_iso3")
    acts, unknown = mapped(F.col("_cats"), V.FTP_ACTIVITIES, strip_unconfirmed=True)
    species, _ = mapped(F.col("_kinds"), V.FTP_SPECIES)
    placed = F.col("_lat").isNotNull() & F.col("_lon").isNotNull()
    return canonical(
        d, source_id=F.lit("farm_transparency"), source_snapshot=F.lit(snapshot), source_row_id=F.coalesce("_id", F.concat_ws(",", F.col("_lat").cast("string"), F.col("_lon").cast("string"))),
        name=_cell(d, h("name")), country_iso3=F.col("_iso3"), national_id=F.col("_id"), id_scheme=F.lit("FTP"), address=blank_to_null(F.concat_ws(" ", _cell(d, h("streetnum")), _cell(d, h("street")))),
        locality=_cell(d, h("suburb")), admin1=_cell(d, h("state")), postcode=_cell(d, h("postcode")), species=species, activities=_or_unknown(acts),
        slaughter=F.when(F.array_contains(acts, "slaughter"), True).when(F.size(acts) > 0, False), operator=F.coalesce(_cell(d, h("ownedby")), _cell(d, h("contractedto"))),
        src_lat=F.when(placed, F.col("_lat")), src_lon=F.when(placed, F.col("_lon")), src_precision=F.when(placed, "rooftop"), raw=F.to_json(F.struct("_raw", unknown.alias("unknown_categories"))),
    )


def ftp_kml(spark: SparkSession, path, country: str = "AUS", snapshot: str = "") -> DataFrame:
    """Placemarks whose description holds 'Label: value' lines. An empty label's line gives null."""
    marks = read_documents(spark, path).select("file", F.posexplode(F.split("text", "(?=<Placemark\\b)")).alias("seq", "m")).where(F.col("m").startswith("<Placemark"))
    part = lambda p, g=1: blank_to_null(F.regexp_extract("m", p, g))
    field = lambda label: part(rf"(?m)(?:^|>|\[){label}:[ \t]*([^\n<]*)")
    point = r"<coordinates>\s*(-?[\d.]+)\s*,\s*(-?[\d.]+)"
    d = marks.withColumns({"seq": F.col("seq").cast("long"), "_id": part(r'<Placemark[^>]*\bid="([^"]*)"'), "_lon": degrees(part(point), -180, 180), "_lat": degrees(part(point, 2), -90, 90)})
    d = d.where("_lat IS NOT NULL AND _lon IS NOT NULL")
    name = F.trim(F.regexp_replace(part(r"(?s)<name>(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?</name>"), r"\s*\([^()]*#[0-9a-fA-F]+\)\s*$", ""))
    d = d.withColumns({"_name": name, "_cats": bracket_split(field("Categories")), "_kinds": bracket_split(field("Species")), "_addr": field("Address"), "_status": field("Last known status")})
    acts, unknown = mapped(F.col("_cats"), V.FTP_ACTIVITIES, strip_unconfirmed=True)
    species, _ = mapped(F.col("_kinds"), V.FTP_SPECIES)
    return canonical(
        d, source_id=F.lit("farm_transparency"), source_snapshot=F.lit(snapshot), source_row_id=_row_id(F.col("_id")), name=F.col("_name"), country_iso3=F.lit(country), national_id=F.col("_id"),
        id_scheme=F.lit("FTP"), address=F.col("_addr"), species=species, activities=_or_unknown(acts), slaughter=F.when(F.array_contains(acts, "slaughter"), True).when(F.size(acts) > 0, False),
        src_lat=F.col("_lat"), src_lon=F.col("_lon"), src_precision=F.lit("rooftop"), raw=F.to_json(F.struct(F.col("_status").alias("status"), unknown.alias("unknown_categories"))),
    )


#: Parsers by source. Sources that share a key are cleared together when one is parsed again.
PARSERS: dict[str, Callable[..., DataFrame]] = {
    "us_fsis_mpi": fsis, "eu_traces_third_country": eu_list, "eu_traces_member_state": eu_list, "eu_member_states": eu_list, "eu_traces_animal_health": eu_health,
    "eu_ied": eu_ied, "ca_cfia": ca_cfia, "nz_mpi": nz_mpi, "br_mapa_sif": br_sif, "br_trase": br_trase, "cifer_china": cifer, "osm_overpass": osm,
    "farm_transparency": ftp_csv, "farm_transparency_kml": ftp_kml, "generic": generic,
}
TOGETHER = {"eu_traces_third_country": ["eu_traces_member_state"], "eu_traces_member_state": ["eu_traces_third_country"]}


def load(spark: SparkSession, source: str, path, store: str, **how) -> None:
    """Parses a source and replaces its rows in the store, with those of the sources cleared with it, in one version.

    An input that can't be parsed leaves the store as it was. Versions of other sources that come in between are taken
    along; one of the same sources raises Conflict.
    """
    table = Table(spark, store)
    base, old = table.manifest()
    parts = table.write(PARSERS[source](spark, path, **how), "source_id")
    gone = {source, *TOGETHER.get(source, [])} - {*parts}
    while True:
        newest, now = table.manifest()
        if any(now.get(k) != old.get(k) for k in {*parts, *gone}):
            raise Conflict(f"{store}: {source} has been parsed by another writer since version {base}")
        try:
            table.commit(parts, newest, gone)
            return
        except Conflict:
            continue  # look again at what has come in between


def load_all(spark: SparkSession, inputs: dict[str, str], store: str, **how) -> list[str]:
    """Every source whose input exists; returns those loaded."""
    done = []
    for source, path in inputs.items():
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p):
            load(spark, source, path, store, **how)
            done.append(source)
    return done
