import gzip
import json

import pytest
from pyspark.sql import functions as F

from sitefold.functions.text import HeaderError
from sitefold.plans import publish
from sitefold.sources import pastes, registers
from sitefold.sources.files import load_table
from sitefold.streaming import landing


def put(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_directory_and_flags(spark, tmp_path):
    d = put(tmp_path / "d.csv", '﻿Establishment_Number,Establishment_Name,Street,City,State,Zip,Latitude,Longitude,Size,DBAs\nm1,"A ""B"" Meat",1 Rd,X,KS,1,37.5,-100.1,,\nM2,C,2 Rd,Y,KS,2,0,0,Small,D\n,Blank,,,,,,,,\n')
    g = put(tmp_path / "g.csv", "establishment_number,slaughter,meat_slaughter,other_voluntary_livestock_slaughter,beef_cow_slaughter,raw_intact,slaughter_volume_category\nM1,No,No,Yes,,,1\nM1,Yes,,Yes,Y,Y,2\nM2,,No,,,,\n")
    rows = {r.source_row_id: r for r in registers.fsis(spark, d, g, "2026-01-01").collect()}
    assert set(rows) == {"M1", "M2"} and rows["M1"].name == 'A "B" Meat'
    assert (rows["M1"].slaughter, rows["M1"].species, rows["M1"].activities, rows["M1"].size_class) == (True, ["bovine"], ["slaughter", "cutting"], "2")
    assert (rows["M2"].slaughter, rows["M2"].src_lat, rows["M2"].activities, rows["M2"].operator) == (False, None, ["unknown"], "D")


def test_lists_of_other_registers(spark, tmp_path):
    nz = put(tmp_path / "nz.csv", "MPI ID Number,Operator Trading Name,Operator Business Name,Primary,Secondary Process,Programme Type,Product/Material,Physical Address,Physical Town/City,Location Local Authority,Operator Local Authority\n7,A,B,Slaughter,Dressing,,Cattle and bobby calf,1 St,T,L,\n7,Later,B,Rendering,,,,,,,\n,No id,B,,,Stores,,,,,\n")
    rows = registers.nz_mpi(spark, nz).collect()
    assert sorted((r.name, r.slaughter, tuple(r.activities), tuple(r.species)) for r in rows) == [("A", True, ("slaughter", "cutting"), ("bovine",)), ("No id", False, ("cold_store",), ())]
    ca = put(tmp_path / "ca.csv", "EST_NUM1,NAME1,CODES_11,CODES_31,LOC_CITY1\n12,Plant,afz,x,Town\n13,,a,,\n")
    (r,) = registers.ca_cfia(spark, ca).collect()
    assert (r.species, r.activities, r.slaughter, r.country_iso3) == (["bovine", "poultry"], ["slaughter", "cutting"], True, "CAN")
    assert {x.letter for x in registers.unmapped_letters(spark, ca).collect()} == {"z"}
    br = put(tmp_path / "br.csv", "NR_SIF;CPF_CNPJ;RAZAO_SOCIAL;NOME_FANTASIA;CATEGORIA_CLASSE;MUNICIPIO;UF\n1;9;Op;Fant;ABATEDOURO FRIGORÍFICO - AB2 - BOVINO;M;GO\n1;9;Op;Other;ENTREPOSTO;M;GO\n;;x;y;z;;\n")
    (r,) = registers.br_sif(spark, br).collect()
    assert (r.source_row_id, r.name, r.species, r.activities, r.slaughter) == ("1|9", "Fant", ["bovine"], ["cold_store", "slaughter"], True)
    ied = put(tmp_path / "ied.csv", "IEDAnnexIMainActivity,Latitude,Longitude,installationName,InstallationInspireId,CountryName,City_of_Facility\n6.4(a),1.5,2.5,I,id1,Spain,C\n9.9,1,1,J,id2,Spain,C\n")
    (r,) = registers.eu_ied(spark, ied).collect()
    assert (r.country_iso3, r.slaughter, r.activities) == ("ESP", True, ["slaughter"])
    health = put(tmp_path / "h.csv", "approval_number,name,address,city,postcode,region,country,section,activity,species\nA1,N,,,,,France,AQUA-EST-DISEASE,Aquaculture establishment,\nA2,M,,,,,France,SEM-COL,Bovine semen,\n")
    rows = {r.source_row_id: r for r in registers.eu_health(spark, health).collect()}
    assert rows["A1"].slaughter is True and rows["A2"].slaughter is False and rows["A2"].species == ["bovine"] and rows["A2"].activities == ["germinal_products"]
    eu = put(tmp_path / "spain.csv", "approval_number,name,section,activity,slaughter,species\n1,A,SECTION I,CP,,\n,B,RM,SH CP,N,ovine\n3,C,,,,\n")
    rows = {r.name: r for r in registers.eu_list(spark, eu).collect()}
    assert rows["A"].species == ["bovine", "porcine", "ovine", "caprine", "equine"] and rows["A"].slaughter is False and rows["A"].country_iso3 == "ESP"
    assert rows["B"].slaughter is False and rows["B"].species == ["ovine"] and rows["C"].slaughter is None and rows["B"].source_row_id.startswith("row")
    with pytest.raises(HeaderError):
        registers.generic(spark, put(tmp_path / "x.csv", "a,b\n1,2\n"), "s", "S", "AUS")


def test_json_registers(spark, tmp_path):
    props = lambda **k: {"facility_id": None, "unique_id": None, "company": "C", "commodity": "BEEF", "inspection_level": "SIE", "inspection_num": "1", "lat": 1.0, "long": 2.0, "type_english": "Slaughterhouse", "type_portuguese": "", "municipality": "M", "state": "GO", "cnpj": "12345678901", **k}
    feats = [props(facility_id="a"), props(facility_id="a", commodity="PORK", inspection_level="SIF"), props(facility_id="b", municipality="N"), *[props(facility_id=f"c{k}", lat=5.0) for k in range(3)]]
    path = put(tmp_path / "t.json", json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [2, 1]}, "properties": p} for p in feats]}))
    rows = {r.source_row_id: r for r in registers.br_trase(spark, path).collect()}
    assert rows["a"].species == ["bovine", "porcine"] and rows["a"].slaughter and rows["a"].src_lat is None and rows["b"].src_lat is None
    assert rows["c1"].src_precision == "locality" and "***01" in rows["a"].raw and "12345678901" not in rows["a"].raw
    with pytest.raises(HeaderError):
        registers.br_trase(spark, put(tmp_path / "u.json", json.dumps({"features": [{"geometry": None, "properties": {"company": "x"}}]})))
    lines = [{"registerNo": "R1", "foreignRegisterNo": "M1", "enName": "A", "countryCode": "US", "productCategory": ["beef slaughter"]}, {"registerNo": "R2", "name": "乙", "_country_iso3": "CAN", "foreignRegisterNo": "9"}]
    rows = {r.source_row_id: r for r in registers.cifer(spark, put(tmp_path / "c.jsonl", "\n\n".join(map(json.dumps, lines)))).collect()}
    assert (rows["R1"].slaughter, rows["R1"].foreign_id_scheme, rows["R1"].species) == (True, "US-FSIS", ["bovine"]) and rows["R2"].slaughter is None and rows["R2"].foreign_id_scheme == "CA-SFC"
    osm = {"elements": [{"type": "node", "id": 1, "lat": 0.0, "lon": 3.0, "tags": {"name": "X", "addr:country": "DE"}}, {"type": "way", "id": 2, "center": {"lat": 1.0, "lon": 2.0}}, {"type": "node", "id": 3}]}
    rows = {r.source_row_id: r for r in registers.osm(spark, put(tmp_path / "o.json", json.dumps(osm))).collect()}
    assert set(rows) == {"node/1", "way/2"} and rows["node/1"].src_lat == 0.0 and rows["node/1"].country_iso3 == "DEU"
    kml = '<kml><Placemark id="placemark7"><name>Farm A (AU #a1f)</name><description>Categories:\nSpecies: Pigs\nAddress: 1 Rd</description><Point><coordinates>150.1,-33.2,0</coordinates></Point></Placemark><Placemark id="x"><name>n</name></Placemark></kml>'
    (r,) = registers.ftp_kml(spark, put(tmp_path / "f.kml", kml)).collect()
    assert (r.source_row_id, r.name, r.species, r.activities, r.address, r.src_lat, r.slaughter) == ("placemark7", "Farm A", ["porcine"], ["unknown"], "1 Rd", -33.2, None)
    ftp = put(tmp_path / "f.csv", "id,name,categories,species,lat,lng,country\n,Z,\"Farm (meat) (unconfirmed), Zoo\",Pigs,1.0,2.0,Australia\n")
    (r,) = registers.ftp_csv(spark, ftp).collect()
    assert (r.source_row_id, r.activities, r.country_iso3, r.slaughter) == ("1.0,2.0", ["farm_meat", "zoo"], "AUS", False)


def test_store_replaces_a_source(spark, tmp_path):
    store = str(tmp_path / "store")
    csv = put(tmp_path / "a.csv", "number,name\n1,A\n2,B\n")
    registers.load(spark, "generic", csv, store, source_id="s1", id_scheme="S", country="AUS")
    registers.load(spark, "generic", csv, store, source_id="s2", id_scheme="S", country="AUS")
    registers.load(spark, "generic", put(tmp_path / "b.csv", "number,name\n3,C\n"), store, source_id="s1", id_scheme="S", country="AUS")
    assert sorted((r.source_id, r.name) for r in load_table(spark, store).collect()) == [("s1", "C"), ("s2", "A"), ("s2", "B")]


def test_pasted_listings(spark, tmp_path):
    page = "junk\nSkip to Main Content\nList view ( Chile - Meat of domestic ungulates )\nCountry: Chile\nFood RM Meat of domestic ungulates\nApproval number\tName\tStreet\tCity\tRegion\nSKIP\nX1\tPlant A\tRoad 1\t1234 Santiago\nSantiago.\nSH - Slaughterhouse\nB Bovinae\n13/07/2026\nX2  Plant B  Road 2  Lima\nCP - Cutting plant\nContact\n"
    rows = {r.approval_number: r for r in pastes.food(spark, put(tmp_path / "chile.txt", page)).collect()}
    a, b = rows["X1"], rows["X2"]
    assert (a.name, a.city, a.postcode, a.region, a.country, a.section, a.activity, a.slaughter, a.species, a.date_of_approval, a.group) == ("Plant A", "Santiago", "1234", "Santiago.", "Chile", "RM", "SH", "Y", "bovine", "13/07/2026", "third-country")
    assert (b.slaughter, b.activity, b.city) == ("N", "CP", "Lima")
    upright = "Country: Peru\nFood PM Meat from poultry\n\nP1\nPlant P\nRoad 3\nLima\nSH - Slaughterhouse\nA Poultry\n\nP2\nPlant Q\nRoad 4\nCusco\n"
    rows = {r.approval_number: r for r in pastes.food(spark, put(tmp_path / "peru.txt", upright)).collect()}
    assert set(rows) == {"P1", "P2"} and rows["P1"].species == "poultry" and rows["P1"].city == "Lima" and rows["P2"].slaughter == ""
    health = "Country:\nSpain\nSection:\nAnimal ASC-UNG Assembly centres\nLast update:\n01/02/2026\nApproval number|Name|Street|City|Region|Activities|Remarks|\nE1|Centro|Calle 1|39649 Villacarriedo|Cantabria|• Assembly centre|B Bovinae|\n\tP Suidae\n"
    (r,) = pastes.health(spark, put(tmp_path / "h.txt", health)).collect()
    assert (r.approval_number, r.city, r.postcode, r.country, r.section, r.section_label, r.species, r.last_update) == ("E1", "Villacarriedo", "39649", "Spain", "ASC-UNG", "Assembly centres", "bovine porcine", "01/02/2026")


def test_pasted_pages_agree_with_their_table(spark, tmp_path):
    """A listing of several pages, and the table that it was made from."""
    rows = [(f"M{k}", f"Plant {k}", f"Quay {k}", "Valletta", ("SH", "CP", "CS")[k % 3]) for k in range(60)]
    head = "Skip to Main Content\nList view ( Malta - Meat of domestic ungulates )\nCountry: Malta\nApproval number\tName\tStreet\tCity\tRegion\n"
    body = ["\t".join(r[:4]) + f"\n{r[4]} - as approved\n" for r in rows]
    pages = "".join(["chrome\n"] + [head + "".join(body[k : k + 20]) + "Legal Notice\nCookies\n" for k in (0, 20, 40)])
    got = pastes.food(spark, put(tmp_path / "malta.txt", pages)).collect()
    assert sorted((r.approval_number, r.name, r.address, r.city, r.activity) for r in got) == sorted(rows)
    assert {(r.country, r.group, r.section) for r in got} == {("Malta", "EU-EFTA", "RM")}


def test_overlay_and_landing(spark, tmp_path):
    f = lambda name, period, cap: json.dumps({"type": "Feature", "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}, "properties": {"name": name, "x_period": period, "x_capacity": cap}})
    path = tmp_path / "cafo.json.gz"
    path.write_bytes(gzip.compress("\n".join([f("A_1", "2024-01", 1.0), f("A_2", "2025-01", 2.0), f("B_1", "2023-01", 3.0), "not json"]).encode()))
    assert sorted((r.stem, r.capacity) for r in publish.load_cafo(spark, str(path)).collect()) == [("A", 2.0), ("B", 3.0)]
    inbox = tmp_path / "in"
    inbox.mkdir()
    put(inbox / "1.jsonl", '{"registerNumber": "R1", "enName": "A"}\n{"regNo": "R2"}\n{"registerNo": "R1"}\n')
    for _ in range(2):
        landing.land(spark, str(inbox), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r.registerNo for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["R1", "R2"]
    # Later files are held against all that has landed, however long ago, and a lost checkpoint lands nothing twice.
    put(inbox / "2.jsonl", '{"regNo": "R2"}\n{"regNo": "R3"}\n{"enName": "without a number"}\n')
    for checkpoint in ("cp", "cp", "new"):
        landing.land(spark, str(inbox), str(tmp_path / "out"), str(tmp_path / checkpoint))
    found = [r.registerNo for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(x for x in found if x) == ["R1", "R2", "R3"]


def test_a_landed_row_is_parsed_twice_at_most(spark):
    """Values are as get_json_object writes them, name by name, in odd documents as well."""
    docs = [
        '{"registerNo":"R1","nameEn":"A"}', '{"REGNO":"X","RegNo":"Y"}', '{"regNo":null,"regNo":"2"}', '{"registerNo":"","registerNumber":"N"}', '{"productCategory":[ "a", {"b": 1.50} ],"country":{ "x" : 2 }}',
        '{"registerNo":12,"address":1.50,"addr":1E5,"validUntil":true}', "{'registerNo':'q'}", '{"registerNo":"a\\tb","address":"[x]","enName":"1.5 kg","name":"-2.x"}', '{"registerNo":"cut', '{"registerNo":"R"} more', "[1]", "7", "text", "{}", None,
    ]
    lines = spark.createDataFrame([(k, v) for k, v in enumerate(docs)], "k int, value string")
    get = lambda doc, names: [F.nullif(F.get_json_object(doc, f"$.{n}"), F.lit("")) for n in names]
    plain = lines.select(*[F.coalesce(*get(F.col("value"), names), *get(F.lower(F.col("value")), [n.lower() for n in names])).alias(c) for c, names in landing.ALIASES.items()], F.col("value").alias("_raw"))
    got = landing.normalised(lines)
    by_raw = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert by_raw(got) == by_raw(plain)
    assert got._jdf.queryExecution().executedPlan().toString().count("from_json(") == 2
