import math
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from sitefold.functions import address, countries, geo, text
from sitefold.operators import outlines


def values(spark, **exprs):
    return spark.range(1).select(*[e.alias(k) for k, e in exprs.items()]).first().asDict()


def lit(x):
    return F.lit(x).cast("string")


def test_names_ids_and_addresses(spark):
    got = values(
        spark,
        accents=text.strip_accents(lit("Ærøskøbing Žižkov ß ﬁ")), null=text.norm_text(lit(None)), norm=text.norm_text(lit("  Café-Bar, S.A.  №1_x ")), name=text.norm_name(lit("Smithfield Packaged Meats Corp.")),
        tokens=text.name_tokens(lit("The Meats of Smithfield Smithfield a Ltd")), id1=text.norm_id(lit("S"), lit("EST. M1234")), id2=text.norm_id(lit("S"), lit("M-1234")), id3=text.norm_id(lit("S"), lit("M 1234")),
        id4=text.norm_id(lit("S"), lit("1234 M")), id5=text.norm_id(lit("S"), lit("1 / 31")), id6=text.norm_id(lit("S"), lit("No. /")), id7=text.norm_id(lit(None), lit("é-7")), pc=text.norm_postcode(lit("sw1a 1aa")),
        house=text.house_number(lit("Unit 12b, 4400 Road")), house0=text.house_number(lit("Nettuno")), ak=text.addr_key(lit("12 Mill"), lit("A-1")), ak2=text.addr_key(lit("Mill"), lit("A-1")), ak3=text.addr_key(lit("12"), lit(" ")),
        yes=text.truthy(lit("maybe")), no=text.truthy(lit(" N ")), blank=text.truthy(lit(" ")), split=text.bracket_split(lit("Farm (meat, eggs) (unconfirmed), Zoo,,")),
        ratio=text.token_set_ratio(F.array(lit("a"), lit("b")), F.array(lit("b"), lit("c"))), empty=text.token_set_ratio(F.array().cast("array<string>"), F.array(lit("c"))),
    )
    assert got["accents"] == "Ærøskøbing Zizkov ß fi" and got["null"] == "" and got["norm"] == "cafe bar s a no1_x" and got["name"] == "smithfield packaged meats"
    assert got["tokens"] == ["smithfield"] and got["id1"] == got["id2"] == got["id3"] == "S:M1234" and got["id4"] == "S:1234M" and got["id5"] == "S:1/31" and got["id6"] is None and got["id7"] == "E7"
    assert (got["pc"], got["house"], got["house0"], got["ak"], got["ak2"], got["ak3"]) == ("SW1A1AA", "12", "", "A1#12", "A1#", "")
    assert (got["yes"], got["no"], got["blank"]) == (True, False, None) and got["split"] == ["Farm (meat, eggs) (unconfirmed)", "Zoo"]
    assert math.isclose(got["ratio"], 1 / 3) and got["empty"] == 0


def test_mapped_and_matches(spark):
    from sitefold import vocabulary as V

    acts, unknown = text.mapped(text.bracket_split(lit("Farm (meat) (unconfirmed), Zoo, Moon base")), V.FTP_ACTIVITIES, True)
    got = values(spark, acts=acts, unknown=unknown, sif=text.matches(lit("ABATEDOURO - BOVINO"), V.SIF_SPECIES), act=text.contained(lit("ABATEDOURO FRIGORIFICO"), V.SIF_ACTIVITIES), look=text.lookup(lit("RM"), V.SECTION_SPECIES), miss=text.lookup(lit("ZZ"), V.SECTION_SPECIES))
    assert got["acts"] == ["farm_meat", "zoo"] and got["unknown"] == ["Moon base"] and got["sif"] == ["bovine"] and got["act"] == ["slaughter"] and got["look"].startswith("bovine") and got["miss"] is None


def test_headers():
    headers = ["Est_Number", "other_voluntary_livestock_slaughter", "Slaughter", "slaughter"]
    assert text.resolve_exact(headers, "slaughter") == "slaughter"
    assert text.resolve(headers, "est number") == "Est_Number" and text.resolve(headers, "livestock") == "other_voluntary_livestock_slaughter"
    assert text.resolve_exact(headers, "livestock") is None
    with pytest.raises(text.HeaderError):
        text.resolve(headers, "latitude", required=True)


def test_addresses_and_pasted_parts(spark):
    cities = {f"c{k}": address.split_food_city(lit(v))[0] for k, v in enumerate(("1234 AB Town", "SW1A 1AA London", "MRS1123 Marsa", "Plain Town", None))}
    codes = {f"p{k}": address.split_food_city(lit(v))[1] for k, v in enumerate(("1234 AB Town", "SW1A 1AA London", "MRS1123 Marsa", "Plain Town", None))}
    got = values(
        spark, **cities, **codes, clean=address.clean_part(lit("Road 1; 9194191 13/07/2026")), tail=address.clean_part(lit("Road 1 a@b.c Tel: 55")), admin=address.first_admin(lit("X Town, Y; Z")),
        key=address.query_key(lit("ES"), lit("ESP"), lit("C. Mayor 1"), lit(None), lit("Lugo, Galicia"), lit("27 001")), none=address.query_key(lit("ES"), lit("ESP"), lit(""), lit(""), lit(None), lit(None)),
        region=address.clean_region(lit("Luanda; 9194191 13/07/2026")), region2=address.clean_region(lit("Vastra Gotaland County; wA Wild game birds; 1 Offal excluded; Vastra Gotaland County")),
        species=address.recover_species(lit("X; B Bovinae; wA Wild game birds; Ll Leporidae")), group=address.group_for(lit(" United Kingdom (Northern Ireland) ")), other=address.group_for(lit("Brazil")),
        hc=address.split_health_city(lit("39649 Villacarriedo"))[0], hp=address.split_health_city(lit("39649 Villacarriedo"))[1], y=address.slaughter_letter(F.array(lit("SH")), lit("RM"), ["FFP"]), n=address.slaughter_letter(F.array(lit("CP")), lit("RM"), ["FFP"]), b=address.slaughter_letter(F.array(lit("PP")), lit("FFP"), ["FFP"]),
        roof=address.nominatim_precision(lit("5"), lit(None), lit(None), lit(None)), road=address.nominatim_precision(lit(None), lit("x"), lit(None), lit(None)), town=address.nominatim_precision(lit(None), lit(None), lit("place"), lit("town")), adm=address.photon_precision(lit(None), lit(None), lit("boundary"), lit("x"), lit("state")),
        bullets=address.bullets(lit("• a  b\t| c •")),
    )
    assert [got[f"c{k}"] for k in range(5)] == ["Town", "London", "Marsa", "Plain Town", ""] and [got[f"p{k}"] for k in range(5)] == ["1234 AB", "SW1A 1AA", "MRS1123", "", ""]
    assert (got["clean"], got["tail"], got["admin"]) == ("Road 1", "Road 1", "X Town") and got["key"] == "v2|es|c. mayor 1|lugo|27001" and got["none"] == ""
    assert got["region"] == "Luanda" and got["region2"] == "Vastra Gotaland County" and got["species"] == ["bovine", "wild_game", "lagomorph"]
    assert (got["group"], got["other"], got["hc"], got["hp"], got["y"], got["n"], got["b"]) == ("EU-EFTA", "third-country", "Villacarriedo", "39649", "Y", "N", "")
    assert (got["roof"], got["road"], got["town"], got["adm"]) == ("rooftop", "street", "locality", "admin") and got["bullets"] == ["a b", "c"]


def test_countries(spark):
    rows = ["Brazil", "BRA", "br", "巴西", "United Kingdom (Northern Ireland)", "Myanmar/Burma", "Côte d'Ivoire", "Atlantis", None, "The Gambia", "Antigua and Barbuda", "Kosovo"]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(rows)], "k int, country string")
    found = countries.with_iso3(df, "country", "iso3")
    got = {r.k: r.iso3 for r in found.collect()}
    assert [got[k] for k in range(12)] == ["BRA", "BRA", "BRA", "BRA", "GBR", "MMR", "CIV", None, None, "GMB", "ATG", "XKX"]
    assert [tuple(r) for r in countries.unresolved(found, "country", "iso3").collect()] == [("Atlantis", 1)]
    two = {r.k: (r.iso2, r.en) for r in countries.with_iso2(found, "iso3", "iso2", "en").collect()}
    assert two[0] == ("BR", "Brazil") and two[7] == (None, None)


def test_geometry(spark):
    x, y = geo.mercator(F.lit(0.0), F.lit(0.0))
    got = values(spark, m=geo.haversine_m(F.lit(34.2979), F.lit(-83.8241), F.lit(34.2981), F.lit(-83.8238)), x=x, y=y, low=geo.degrees(lit("91"), -90, 90), ok=geo.degrees(lit("0.0"), -90, 90), bad=geo.degrees(lit("x"), -90, 90), fixed=geo.fixed_point(F.lit(37.752805)))
    assert abs(got["m"] - 35.4) < 0.1 and (got["x"], got["y"]) == (0.5, 0.5) and (got["low"], got["ok"], got["bad"]) == (None, 0.0, None) and got["fixed"] in (3775280, 3775281)


def plain_country(outlines, lat, lon, near):
    """The rule for one position over all lines and corners."""
    for iso, rings in outlines:
        odd = False
        for ring in rings:
            for (x0, y0), (x1, y1) in zip([ring[-1], *ring], ring):
                if (y1 > lat) != (y0 > lat) and lon < (x0 - x1) * (lat - y1) / (y0 - y1) + x1:
                    odd = not odd
        if odd:
            return iso
    best, out = near * near, None
    for iso, rings in outlines:
        for ring in rings:
            for x, y in ring:
                if (x - lon) ** 2 + (y - lat) ** 2 < best:
                    best, out = (x - lon) ** 2 + (y - lat) ** 2, iso
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_country_of_a_position_equals_the_plain_rule(spark, broadcast, monkeypatch):
    r = random.Random(6)
    ring = lambda x, y, n: [[x + (2 + 5 * r.random()) * math.cos(2 * math.pi * k / n), y + (2 + 5 * r.random()) * math.sin(2 * math.pi * k / n)] for k in range(n)]
    shapes = [(f"C{k}", [ring(r.uniform(-30, 30), r.uniform(-20, 20), r.choice([3, 5, 9, 40])) for _ in range(r.randrange(1, 4))]) for k in range(8)]
    shapes += [("BOX", [[[0, 0], [10, 0], [10, 10], [0, 10]], [[2, 2], [3, 2], [3, 3], [2, 3]]])]
    points = [(r.uniform(-30, 30), r.uniform(-40, 40)) for _ in range(1500)] + [(float(a), float(b)) for a in range(-1, 12) for b in range(-1, 12)] + [(5.0, None), (None, None)]
    df = spark.createDataFrame([(k, *p, "NAMED" if k % 50 == 0 else None) for k, p in enumerate(points)], "k int, lat double, lon double, iso string")
    if not broadcast:
        monkeypatch.setattr(outlines, "MOST_BROADCAST", 0)
    for near in (1.0, 0.0, 0.4):
        got = {r.k: r.iso for r in outlines.with_country(df, shapes, F.col("lat"), F.col("lon"), "iso", near).collect()}
        assert len(got) == len(points)
        for k, (lat, lon) in enumerate(points):
            assert got[k] == ("NAMED" if k % 50 == 0 else None if lat is None or lon is None else plain_country(shapes, lat, lon, near)), (k, lat, lon, near)


def test_open_rings_leave_out_their_lines(spark):
    """A position on a slanted, level or upright line, or a corner, is not in that ring; one on a hole's line is not in the hole."""
    shapes = [("AAA", [[[0, 0], [60, 0], [60, 40], [0, 40]], [[20, 10], [30, 10], [30, 20], [20, 20]]]), ("BBB", [[[-90, -50], [-30, -50], [-30, -10]]])]
    points = [(-60.75, -30.5), (-60.5, -30.5), (0, 5), (5, 0), (60, 5), (5, 40), (0, 0), (60, 40), (20, 15), (25, 10), (25, 20), (30, 20), (25, 15), (-90, -50), (-30, -20), (-40, -50), (5, 5)]
    df = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(points)], "k int, x double, y double")
    got = {r.k: r.iso for r in outlines.with_country(df, shapes, F.col("y"), F.col("x"), "iso", 0.0, open_rings=True).collect()}
    assert [got[k] for k in range(len(points))] == [None, "BBB", *[None] * 6, *["AAA"] * 4, *[None] * 4, "AAA"]


def test_folding_sends_characters_and_equals_whole_texts(spark):
    """All characters, marks in any order, ligatures and wide texts; Python gets each text's different characters only."""
    r = random.Random(9)
    known = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(known[i : i + 4000]) for i in range(0, len(known), 4000)] + ["".join(r.choices(known[:0x3000], k=60)) + "ẹ́́ ﬃ ṩ 각" for _ in range(300)] + ["", "plain", None, "́", "é" * 50_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    plain = lambda x: "".join(c for c in unicodedata.normalize("NFKD", x or "") if not unicodedata.combining(c))
    got = {k: v for k, v in rows.select("k", text.strip_accents(F.col("t"))).collect()}
    assert all(got[k] == plain(t) for k, t in enumerate(texts))
    assert "array_distinct" in rows.select(text.strip_accents(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
