"""Address parts and the lines of pasted listings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sitefold.functions.text import squeeze
from sitefold.vocabulary import EU_EFTA, LATIN_SPECIES, LOCALITY_TYPES, ROOFTOP_CLASSES, ROOFTOP_TYPES, SPECIES_CODES

# Debris at the end of addresses and regions, and the shapes of species, remark and activity parts.
ID_DATE_TAIL = r";\s*\d[\d\s/.\-]*$"
CONTACT_TAIL = r"(?i)\b(tel|fax|e-?mail|phone|mob)\b\s*[:.]?.*$"
REGION_TAIL = r"[;,]?\s*\d{4,}(?:\s+\d{2}/\d{2}/\d{4})?\s*$"
SPECIES_LINE = r"^([BCOSP])\s+(Bovinae|Capra hircus|Ovis aries|Equidae|Suidae)\s*$"
CODE_LINE = r"^([A-Za-z]{1,4}!?)\s+([A-Z].*)$"
REMARK_LINE = r"^\d{1,3}\s+\S"
ACTIVITY_LINE = r"^([A-Z]{2,4})\s*[-–]\s*(.+)$"
CATEGORY_LINE = r"(?i)^CAT\d\b|^[A-Z]{2,4}\s*-\s*"
DATE_LINE = r"^\d{2}/\d{2}/\d{4}$"
ID_DATE_LINE = r"^(\d{4,})(?:\s+(\d{2}/\d{2}/\d{4}))?$"


def clean_part(c: Column) -> Column:
    """Without ids, dates, e-mail addresses and contact details at the end."""
    v = F.regexp_replace(F.coalesce(c, F.lit("")), ID_DATE_TAIL, "")
    v = F.regexp_replace(F.regexp_replace(v, r"\S+@\S+", " "), CONTACT_TAIL, "")
    return squeeze(F.btrim(F.regexp_replace(v, "\\s", " "), F.lit(" ,;-")))


def first_admin(c: Column) -> Column:
    return F.trim(F.get(F.split(F.get(F.split(clean_part(c), ";"), F.lit(0)), ","), F.lit(0)))


def query_key(iso2: Column, iso3: Column, street: Column, locality: Column, admin1: Column, postcode: Column) -> Column:
    """v2|country|street|city|postcode in lower case; '' without any of the three. The city falls back on the region."""
    s, c, p = clean_part(street), clean_part(locality), F.regexp_replace(clean_part(postcode), "\\s", "")
    c = F.when(c == "", first_admin(admin1)).otherwise(c)
    country = F.coalesce(F.nullif(iso2, F.lit("")), F.nullif(iso3, F.lit("")), F.lit("??"))
    return F.when((s == "") & (c == "") & (p == ""), F.lit("")).otherwise(F.lower(F.concat_ws("|", F.lit("v2"), country, s, c, p)))


def has_street(street: Column) -> Column:
    return F.coalesce(street, F.lit("")).rlike("[0-9]")


def nominatim_precision(house_number: Column, road: Column, kind: Column, address_type: Column) -> Column:
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    rooftop = some(house_number) | F.coalesce(kind.isin(*ROOFTOP_CLASSES), F.lit(False)) | F.coalesce(address_type.isin(*ROOFTOP_TYPES), F.lit(False))
    street = F.coalesce(address_type == "road", F.lit(False)) | some(road)
    return F.when(rooftop, "rooftop").when(street, "street").when(address_type.isin(*LOCALITY_TYPES), "locality").otherwise("admin")


def photon_precision(house_number: Column, street: Column, key: Column, value: Column, kind: Column) -> Column:
    names = [x for x in ROOFTOP_TYPES if x not in ("building", "man_made", "farmyard")] + ["building"]
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    is_in = lambda c, xs: F.coalesce(c.isin(*xs), F.lit(False))
    return (
        F.when(some(house_number) | is_in(key, names) | is_in(value, names), "rooftop")
        .when(some(street) | is_in(key, ["highway"]), "street")
        .when(is_in(kind, ["city", "district", "locality"]) | is_in(key, ["place"]), "locality")
        .otherwise("admin")
    )


def group_for(country: Column) -> Column:
    return F.when(F.lower(F.trim(country)).isin(*EU_EFTA), "EU-EFTA").otherwise("third-country")


def species_of_line(x: Column) -> Column:
    """The species that a listing line names, or null: a letter with a Latin name, or a code with a phrase."""
    from sitefold.functions.text import lookup

    latin = lookup(F.regexp_extract(x, SPECIES_LINE, 2), LATIN_SPECIES)
    code = F.regexp_replace(F.regexp_extract(x, CODE_LINE, 1), "!", "")
    return F.coalesce(latin, lookup(code, SPECIES_CODES))


def recover_species(region: Column) -> Column:
    parts = F.transform(F.split(F.coalesce(region, F.lit("")), ";"), lambda x: F.trim(x))
    return F.array_distinct(F.array_compact(F.transform(parts, species_of_line)))


def clean_region(region: Column) -> Column:
    """Distinct parts between ';', in order, without ids, dates, species, activities and remarks."""
    parts = F.transform(F.split(F.coalesce(region, F.lit("")), ";"), lambda x: F.trim(F.regexp_replace(F.trim(x), REGION_TAIL, "")))
    keep = lambda x: (x != "") & species_of_line(x).isNull() & ~x.rlike(REMARK_LINE) & ~x.rlike(CATEGORY_LINE) & ~x.rlike(DATE_LINE) & ~x.rlike(ID_DATE_LINE)
    return F.array_join(F.array_distinct(F.filter(parts, keep)), "; ")


def split_food_city(raw: Column) -> tuple[Column, Column]:
    """(city, postcode): a first token with a digit of up to ten characters, with a second for Dutch and British codes."""
    v = squeeze(F.coalesce(raw, F.lit("")))
    two = F.regexp_extract(v, r"^(\d{4} [A-Z]{2}|[A-Z]{1,2}\d[A-Z\d]? \d[A-Z]{2})(?: |$)", 1)
    one = F.regexp_extract(v, r"^((?=\S*\d)[A-Za-z0-9\-]{1,10})(?: |$)", 1)
    code = F.when(two != "", two).otherwise(one)
    return F.trim(F.substring(v, F.length(code) + 1, F.length(v))), code


def split_health_city(raw: Column) -> tuple[Column, Column]:
    v = squeeze(F.regexp_replace(F.coalesce(raw, F.lit("")), " ", " "))
    pattern = r"^([A-Z]{0,2}\d[\w\-]*(?:\s+\d[\w\-]*)?)\s+(.+)$"
    return F.when(v.rlike(pattern), F.regexp_extract(v, pattern, 2)).otherwise(v), F.regexp_extract(v, pattern, 1)


def bullets(cell: Column) -> Column:
    """Items of a cell between tabs and bullets."""
    items = F.transform(F.split(F.regexp_replace(F.coalesce(cell, F.lit("")), " ", " "), "\t|•"), lambda x: F.btrim(squeeze(x), F.lit(" •|")))
    return F.filter(items, lambda x: x != "")


def slaughter_letter(codes: Column, section: Column, vocabulary_free: list[str]) -> Column:
    """Y with SH, '' for a section without activity codes or a row without any, else N."""
    return F.when(F.array_contains(codes, "SH"), "Y").when(section.isin(*vocabulary_free) | (F.size(codes) == 0), "").otherwise("N")
