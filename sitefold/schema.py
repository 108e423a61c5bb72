"""The canonical rows. slaughter is tri-state everywhere: null is 'not stated', never 'no'."""

SOURCE_RECORD = (
    "source_id string, source_snapshot string, source_row_id string, name string, country_iso3 string, national_id string, id_scheme string, "
    "foreign_id string, foreign_id_scheme string, address string, locality string, admin1 string, postcode string, species array<string>, "
    "activities array<string>, slaughter boolean, size_class string, operator string, src_lat double, src_lon double, src_precision string, raw string"
)
FIELDS = [x.strip().split(" ")[0] for x in SOURCE_RECORD.split(", ")]
TYPES = {x.strip().split(" ")[0]: x.strip().split(" ", 1)[1] for x in SOURCE_RECORD.split(", ")}

GEO_CACHE = "qkey string, lat double, lon double, precision string, provider string, tries int"

REVIEW_PAIR = (
    "a_key string, a_source string, a_name string, a_address string, a_id string, b_key string, b_source string, b_name string, b_address string, "
    "b_id string, country string, name_score double, metres_apart int, reason string, decision string"
)
