"""Word lists, codes and maps of the registers that the engine integrates."""

from __future__ import annotations

# Corporate suffixes and words without discriminating power, compared after folding.
LEGAL_SUFFIXES = [
    "inc", "llc", "ltd", "limited", "corp", "corporation", "co", "company", "plc", "lp", "llp", "pty", "pte", "gmbh", "mbh", "ag", "kg", "ohg", "eg", "se",
    "sa", "sas", "sarl", "sprl", "nv", "bv", "cv", "vof", "spa", "srl", "snc", "ab", "as", "asa", "oy", "oyj", "aps", "a/s", "sl", "slu", "sau", "scl",
    "coop", "sccl", "ltda", "eireli", "me", "epp", "ao", "ooo", "zao", "pao", "spzoo", "sro", "kft", "zrt", "bt", "kk", "yk",
]
STOPWORDS = [
    "the", "and", "of", "de", "del", "la", "le", "les", "el", "los", "das", "dos", "da", "do", "der", "die", "und", "van", "von", "meat", "meats", "foods",
    "food", "packing", "packers", "abattoir", "slaughterhouse", "slaughter", "processing", "processors", "plant", "matadero", "frigorifico", "schlachthof",
    "abattoirs", "macello",
]

# The species, in the order in which one stands for a mixed site, and the activities.
SPECIES = [
    "bovine", "porcine", "poultry", "ovine", "caprine", "equine", "cervid", "lagomorph", "fish", "crustacean", "camelid", "canine", "mustelid", "reptile",
    "insect", "farmed_game", "wild_game", "other",
]
ACTIVITIES = [
    "slaughter", "farm_meat", "farm_dairy", "farm_eggs", "farm_wool", "farm_skins", "farm_honey", "hatchery", "saleyard", "live_market", "holding_yard",
    "farm_poultry", "transporter", "insect_rearing", "germinal_products", "quarantine", "experimentation", "zoo", "wildlife", "racing", "rodeo",
    "entertainment", "pet_breeder", "pet_shop", "agricultural_show", "aquaculture", "cutting", "processing", "minced_meat", "meat_preparations",
    "game_handling", "cold_store", "rendering", "casings", "egg_products", "unknown",
]
# Activities that alone do not put a site on the map, and species that tallies leave out.
EXCLUDED_ACTIVITIES = [
    "cutting", "processing", "minced_meat", "meat_preparations", "game_handling", "cold_store", "rendering", "casings", "egg_products", "experimentation",
    "zoo", "wildlife", "racing", "rodeo", "entertainment", "pet_breeder", "pet_shop", "agricultural_show", "farm_honey", "farm_wool", "farm_skins",
    "insect_rearing", "aquaculture",
]
EXCLUDED_SPECIES = ["fish", "crustacean"]

# Names of activities for readers.
ACTIVITY_LABELS = {
    "slaughter": "Slaughterhouse",
    "farm_meat": "Meat farm",
    "farm_dairy": "Dairy farm",
    "farm_eggs": "Egg farm",
    "farm_wool": "Wool farm",
    "farm_skins": "Skin and fur farm",
    "farm_poultry": "Poultry establishment",
    "transporter": "Authorised transporter",
    "insect_rearing": "Isolated bee rearing",
    "germinal_products": "Germinal products",
    "quarantine": "Quarantine establishment",
    "farm_honey": "Apiary",
    "hatchery": "Hatchery",
    "saleyard": "Saleyard",
    "live_market": "Live animal market",
    "holding_yard": "Holding yard",
    "aquaculture": "Aquaculture",
    "experimentation": "Laboratory",
    "zoo": "Zoo",
    "wildlife": "Wildlife facility",
    "racing": "Racing",
    "rodeo": "Rodeo",
    "entertainment": "Entertainment",
    "pet_breeder": "Pet breeder",
    "pet_shop": "Pet shop",
    "agricultural_show": "Agricultural show",
    "cutting": "Cutting plant",
    "processing": "Processing plant",
    "minced_meat": "Minced meat plant",
    "meat_preparations": "Meat preparations",
    "game_handling": "Game handling",
    "cold_store": "Cold store",
    "rendering": "Rendering plant",
    "casings": "Casings plant",
    "egg_products": "Egg products plant",
    "unknown": "Activity not stated",
    "_none": "Activity not stated",
}

# Precisions of the modelled-facility overlay that name a facility's own place.
OVERLAY_PRECISE = ["asset", "facility", "high", "exact", "point"]

# What becomes of animals at places of each activity: killed here, elsewhere, in part, not, handled dead, or not kept there.
ACTIVITY_FATES = {
    "slaughter": "here",
    "farm_meat": "elsewhere",
    "farm_dairy": "elsewhere",
    "farm_eggs": "elsewhere",
    "farm_wool": "elsewhere",
    "farm_skins": "elsewhere",
    "farm_honey": "no",
    "hatchery": "some",
    "saleyard": "elsewhere",
    "live_market": "here",
    "holding_yard": "elsewhere",
    "farm_poultry": "elsewhere",
    "transporter": "transit",
    "insect_rearing": "no",
    "germinal_products": "no",
    "quarantine": "elsewhere",
    "experimentation": "some",
    "zoo": "some",
    "wildlife": "some",
    "racing": "some",
    "rodeo": "some",
    "entertainment": "some",
    "pet_breeder": "some",
    "pet_shop": "some",
    "agricultural_show": "no",
    "aquaculture": "elsewhere",
    "cutting": "after",
    "processing": "after",
    "minced_meat": "after",
    "meat_preparations": "after",
    "game_handling": "after",
    "cold_store": "after",
    "rendering": "after",
    "casings": "after",
    "egg_products": "after",
}
# Precisions, best first, and those that may be matched on and drawn.
PRECISION_RANK = {"rooftop": 0, "street": 1, "locality": 2}
MAPPABLE = ["rooftop", "street"]

# Food sections to species, activity codes to activities, section names to codes.
SECTION_SPECIES = {
    "I": "bovine porcine ovine caprine equine", "II": "poultry lagomorph", "III": "farmed_game", "IV": "wild_game",
    "RM": "bovine porcine ovine caprine equine", "PM": "poultry lagomorph", "GM": "farmed_game", "WM": "wild_game",
}
ACTIVITY_CODES = {
    "SH": "slaughter", "CP": "cutting", "GHE": "game_handling", "PP": "processing", "MM": "minced_meat", "MP": "meat_preparations", "MSM": "processing", "CS": "cold_store",
}
SECTION_NAMES = {
    "meat of domestic ungulates": "RM", "meat from poultry and lagomorphs": "PM", "meat of farmed game": "GM", "wild game meat": "WM",
    "fishery products": "FFP", "fishery products - eu": "FFP", "slaughterhouses and fishery vessels": "ABP-SH", "meat products": "RPM",
}
SECTION_CODE = r"\b(ABP-[A-Z]+|RM|PM|GM|WM|RPM|MM|CAS|EEP|EPP|FFP|GEL|HON|LBM|MMP|FAT|FLS|SPR|COL|RCG|TCG|GEN)\b"
NO_ACTIVITY_SECTIONS = ["ABP-SH", "ABP-PROCP", "ABP-PET", "ABP-INTP", "FFP"]
LATIN_SPECIES = {"Bovinae": "bovine", "Suidae": "porcine", "Ovis aries": "ovine", "Capra hircus": "caprine", "Equidae": "equine"}
SPECIES_CODES = {
    "A": "poultry", "R": "poultry", "wA": "wild_game", "L": "lagomorph", "Ll": "lagomorph", "Lo": "lagomorph", "wL": "wild_game",
    "fG": "farmed_game", "wG": "wild_game", "wU": "wild_game", "lwG": "wild_game", "swG": "wild_game", "wbU": "wild_game", "Bbis": "bovine",
}
# The members of the EU and EFTA group.
EU_EFTA = [
    "austria", "belgium", "bulgaria", "croatia", "cyprus", "czechia", "denmark", "estonia", "finland", "france", "germany", "greece", "hungary", "ireland",
    "italy", "latvia", "lithuania", "luxembourg", "malta", "netherlands", "poland", "portugal", "romania", "slovakia", "slovenia", "spain", "sweden",
    "iceland", "liechtenstein", "norway", "switzerland", "united kingdom (northern ireland)",
]
# Lines of a pasted page that are not rows.
NOISE_LINES = [
    "Skip to Main Content", "Documentation", "European Commission", "IMSOC", "TRACES", "Establishment list", "Details", "Last update", "Establishments",
    "Approval number", "Legal Notice", "Terms of Use", "Cookies", "Privacy Statement", "Accessibility", "Credits", "Contact", "Top Page", "processed by",
    "Log in", "English (English)", "Section:",
]

# Animal-health sections and activity texts.
HEALTH_SECTIONS = {
    "ASC-UNG": "holding_yard", "ASC-POU": "holding_yard", "ASC-DCF": "holding_yard", "POU-EST-AP": "farm_poultry", "HATCH-AP": "hatchery",
    "AQUA-EST-AP": "aquaculture", "AQUA-EST-AP-GR": "aquaculture", "AQUA-EST-DISEASE": "slaughter", "CONF": "zoo", "QUR": "quarantine",
    "COP": "holding_yard", "SEM-COL": "germinal_products", "EMB-COL": "germinal_products", "EMB-PRO": "germinal_products",
    "GERM-PRO": "germinal_products", "GERM-STO": "germinal_products", "GERM-CONF": "germinal_products", "BBEEISO-EST": "insect_rearing",
    "REG-TRANS-AUTH-II": "transporter", "REG-TRANS-AUTH-I": "transporter", "DCF-SHEL": "pet_shop", "BIRD-EST": "pet_breeder",
}
HEALTH_TEXTS = {
    "assembly center": "holding_yard", "assembly centre": "holding_yard", "poultry establishment": "farm_poultry", "hatchery": "hatchery",
    "quarantine": "quarantine", "quarantine establishment": "quarantine", "control post": "holding_yard",
    "type ii authorised transporters": "transporter", "type i authorised transporters": "transporter",
}
HEALTH_SPECIES = ["bovine", "equine", "ovine", "caprine", "porcine"]

# Words in the names of directory flag columns.
FLAG_SPECIES = {
    "bovine": "beef|cow|steer|heifer|bull|dairy|veal|calf|bison|buffalo|yak|cattalo", "porcine": "swine|pork|sow|boar", "ovine": "sheep|lamb",
    "caprine": "goat", "cervid": "deer|reindeer|antelope|elk", "lagomorph": "rabbit",
    "poultry": "chicken|fowl|capon|turkey|duck|goose|pheasant|quail|ostrich|emu|rhea|guinea|squab|poultry|ratite",
}
FLAG_ACTIVITIES = {"raw_intact": "cutting", "raw_non_intact": "minced_meat", "rte": "processing", "nrte": "processing", "egg_products": "egg_products"}

# Industrial emission activities: activity, species, whether animals are killed.
IED = {
    "6.4(a)": ("slaughter", "", True), "6.5": ("rendering", "", None), "6.6(a)": ("farm_poultry", "poultry", None), "6.6(b)": ("farm_meat", "porcine", None),
    "6.6(c)": ("farm_meat", "porcine", None), "6.4(b)(i)": ("processing", "", None), "6.4(b)(ii)": ("processing", "", None),
    "6.4(b)(iii)": ("processing", "", None), "6.4(c)": ("processing", "", None), "6.3": ("processing", "", None),
}
# Columns of the Canadian list and letters of its first column.
CFIA_COLUMNS = {
    "CODES_11": "slaughter", "CODES_21": "processing", "CODES_31": "cutting", "CODE_41": "rendering", "CODE_51": "casings", "CODES_61": "processing",
    "CODE_71": "processing", "CODE_81": "rendering", "CODES_91": "cold_store", "CODES_101": "cold_store",
}
CFIA_SPECIES = {"a": "bovine", "b": "bovine", "c": "ovine", "d": "porcine", "e": "equine", "f": "poultry", "g": "lagomorph"}
# Process and programme words of the New Zealand register, and species patterns.
NZ_PROCESS = {
    "slaughter": "slaughter", "dual operator butcher": "cutting", "boning/cutting": "cutting", "dressing": "cutting", "refrigeration": "cold_store",
    "rendering": "rendering", "chicken producer": "farm_meat", "farm dairy": "farm_dairy", "candling": "egg_products", "grading": "egg_products",
    "filleting": "processing", "gutting": "processing", "shucking": "processing", "size reduction": "processing", "thermal": "processing",
    "smoking": "processing", "salting/curing/brining": "processing", "formulation": "processing", "packing": "processing",
}
NZ_PROGRAMME = {
    "micro abattoir": "slaughter", "dual operator butcher": "cutting", "stores": "cold_store", "transport and storage": "cold_store",
    "bee products": "farm_honey", "farm dairies": "farm_dairy", "chicken producers": "farm_meat", "eggs": "egg_products",
}
NZ_SPECIES = {
    "bovine": r"\bcattle|\bbovine|\bbobby calf", "porcine": r"\bfarmed pigs|\bpigs\b|\bporcine", "ovine": r"\bsheep|\blamb|\bovine\b",
    "caprine": r"\bgoats?\b|\bcaprine", "cervid": r"\bdeer\b|\bvenison", "poultry": r"\bpoultry|\bchicken|\bbroiler|\bduck|\bturkey",
    "equine": r"\bhorse|\bequine", "lagomorph": r"\brabbit|\bhare\b", "other": r"\bfish\b|\bseafood|\bshellfish|\bmollusc",
}
# Classes and species of the Brazilian federal register.
SIF_ACTIVITIES = {
    "ABATEDOURO": "slaughter", "ABATE": "slaughter", "UNIDADE DE BENEF. DE CARNE": "processing", "UNIDADE DE BENEFICIAMENTO DE CARNE": "processing",
    "UNIDADE DE BENEF. DE PESCADO": "processing", "UNIDADE DE BENEFICIAMENTO DE PESCADO": "processing", "PRODUTOS DE ABELHAS": "farm_honey",
    "ENTREPOSTO": "cold_store", "GRANJA": "farm_eggs", "UNIDADE DE BENEF. DE OVOS": "egg_products", "OVOS": "egg_products", "LEITE": "farm_dairy",
    "CHARQUE": "processing", "CONSERVAS": "processing",
}
SIF_SPECIES = {
    "bovine": r"\bBOVIN|\bBUBALIN|\bBUFAL", "porcine": r"\bSU[IÍ]N|\bSUID", "poultry": r"\bAVES?\b|\bFRANGO|\bPERU\b", "ovine": r"\bOVIN",
    "caprine": r"\bCAPRIN", "equine": r"\bEQU[IÍ]N|\bEQU[IÍ]D", "lagomorph": r"\bCOELH|\bLAGOMORF", "other": r"\bPESCADO|\bPEIXE|\bRÃ\b",
}
# Site types, commodities and species words of the Brazilian site compilation.
TRASE_ACTIVITIES = (
    ("slaughter", r"slaughter|abatedouro|matadouro|\babate\b"),
    ("processing", r"meat processing|meat products factory|benef\w*\.? de carne|beneficiamento de carnes?|produtos carneos|fabrica de produtos carneos|fabrica de conservas|canned|charque|agro-?industrial processing|agroindustria"),
    ("processing", r"fish and seafood processing|fish slaughter and processing|benef\w*\.? de pescado|beneficiamento de pescados?"),
    ("processing", r"milk and dairy processing|dairy factory|fabrica de laticinios|\blaticinios\b|benef\w*\.? de leite|beneficiamento de leite|queijaria"),
    ("farm_dairy", r"dairy farm|estabulo leiteiro|granja leiteira"),
    ("egg_products", r"egg processing|benef\w*\.? de ovos|beneficiamento de ovos"),
    ("farm_honey", r"bee products|prod\w*\.? de abelhas?|produtos (de|das) abelhas?"),
    ("cold_store", r"refrigeration facility|storage and distribution|warehouse|entreposto"),
    ("rendering", r"non-edible|nao comestiveis"),
)
TRASE_COMMODITIES = {
    "beef": "bovine", "pork": "porcine", "chicken": "poultry", "egg": "poultry", "lamb": "ovine", "goat": "caprine", "rabbit": "lagomorph",
    "equine": "equine", "fish": "fish", "honey": "insect",
}
TRASE_SPECIES = {
    "bovine": r"\bbovin|\bbubalin|\bbovideos|\bcattle\b|\bbeef\b", "porcine": r"\bsuin|\bsuideos|\bswine\b|\bpork\b", "poultry": r"\baves?\b|\bpoultry\b|\bgalinha|\bfrango",
    "ovine": r"\bovin", "caprine": r"\bcaprin", "equine": r"\bequin|\bequid", "lagomorph": r"\bcoelh|\brabbit", "crustacean": r"\bcrustace",
    "fish": r"\bpescado|\bfish\b|\bpeixe", "insect": r"\babelha|\bbee\b",
}
# Category and species wordings of the transparency project.
FTP_ACTIVITIES = {
    "slaughterhouse": "slaughter", "knackery": "slaughter", "farm (meat)": "farm_meat", "meat farm": "farm_meat", "farm (dairy)": "farm_dairy",
    "dairy farm": "farm_dairy", "farm (eggs)": "farm_eggs", "egg farm": "farm_eggs", "farm (wool)": "farm_wool", "wool farm": "farm_wool",
    "farm (skins/fur)": "farm_skins", "fur farm": "farm_skins", "honey farm": "farm_honey", "sheep farm": "farm_meat", "hatchery": "hatchery",
    "saleyard": "saleyard", "live market": "live_market", "depot / holding yard": "holding_yard", "experimentation": "experimentation", "zoo": "zoo",
    "wildlife": "wildlife", "race training/breeding": "racing", "race training/breeding facility": "racing", "racecourse": "racing", "rodeo": "rodeo",
    "other entertainment": "entertainment", "agricultural show": "agricultural_show", "pet breeder": "pet_breeder", "pet shop": "pet_shop",
    "rendering plant": "rendering", "meat processing (non-slaughter)": "processing", "aquaculture": "aquaculture", "farm (honey)": "farm_honey",
    "skin/fur farm": "farm_skins", "meat processing (non-slaughter) facility": "processing", "scientific experimentation facility": "experimentation",
    "other/misc entertainment facility": "entertainment", "egg processing and distribution factory": "processing", "dairy processing factory": "processing",
    "dairy processing": "processing", "egg processing and distribution": "processing", "circus": "entertainment", "live animal export facility": "holding_yard",
    "knackery / rendering": "slaughter",
}
FTP_SPECIES = {
    "cows/cattle": "bovine", "cattle": "bovine", "cows": "bovine", "pigs": "porcine", "chickens": "poultry", "turkeys": "poultry", "ducks": "poultry",
    "geese": "poultry", "quail": "poultry", "misc birds": "poultry", "pigeons": "poultry", "emus": "poultry", "ostriches": "poultry", "chicks": "poultry",
    "sheep": "ovine", "lambs": "ovine", "goats": "caprine", "horses": "equine", "donkeys": "equine", "greyhounds": "canine", "dogs": "canine",
    "cats": "other", "rabbits": "lagomorph", "minks": "mustelid", "ferrets": "mustelid", "foxes": "other", "deer": "cervid", "kangaroos": "wild_game",
    "camels": "other", "alpacas": "camelid", "llamas": "camelid", "buffalo": "bovine", "fish/sealife": "fish", "fish": "fish", "prawns": "crustacean",
    "crocodiles": "reptile", "alligators": "reptile", "bees": "insect",
}
# Countries whose own numbers the customs register quotes, with their schemes.
FOREIGN_SCHEMES = {"USA": "US-FSIS", "AUS": "AU-EXPORT", "NZL": "NZ-MPI", "BRA": "BR-SIF", "CAN": "CA-SFC"}
# Words for species in the customs register's categories.
CIFER_SPECIES = {"bovine": "beef|bovine|牛", "porcine": "pork|porcine|猪", "ovine": "mutton|sheep|羊", "poultry": "poultry|chicken|禽", "fish": "aquatic|fish|水产", "lagomorph": "rabbit|兔"}

# What the geocoders call a building.
ROOFTOP_CLASSES = [
    "building", "amenity", "shop", "man_made", "office", "craft", "industrial",
]
ROOFTOP_TYPES = [
    "building", "house", "industrial", "commercial", "retail", "amenity", "shop", "office", "craft", "warehouse", "man_made", "farm", "farmyard",
]
LOCALITY_TYPES = [
    "city", "town", "village", "hamlet", "suburb", "municipality", "locality", "postcode", "quarter", "neighbourhood",
]
