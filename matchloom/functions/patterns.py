"""Word lists and patterns that results depend on, in their given order.

Patterns are written once, without flags; Spark runs them as (?iU), DuckDB as 'gi'.
"""

# Legal forms and noise words, tried in this order.
LEGAL_WORDS = [
    r"private\s+limited", r"pvt\s+ltd", r"pvt\s+limited", r"public\s+limited", "ltd", "limited", "incorporated", "inc",
    "corporation", "corp", r"limited\s+liability\s+company", r"limited\s+liability\s+partnership", "llc", "llp", "company",
    "co", "group", "enterprises", "enterprise", "services", "service", "solutions", "solution", "holdings", "holding",
    "industries", "industry", "sas", "sarl", "sa", "snc", "sci", "eurl", "gmbh", "ag",
]
LEGAL = r"\b(?:" + "|".join(LEGAL_WORDS) + r")\b"
# Fixed value: web domains, reduced to the name before the ending.
DOMAIN = r"\b(?:www\.)?([a-z0-9\-]+)\.(?:com|org|net|in|co|io|fr|gov|edu)\b"
# Address abbreviations and their expansions.
ABBREVIATIONS = {
    "rd": "road", "st": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "bvd": "boulevard", "bd": "boulevard",
    "dr": "drive", "ln": "lane", "ct": "court", "pl": "place", "sq": "square", "hwy": "highway", "pkwy": "parkway",
    "terr?": "terrace", "aly": "alley", "way": "way", "flr?": "floor", "apt": "apartment", "ste": "suite", "bldg": "building",
    "opp": "opposite", "nr": "near", "b/h": "behind", "bh": "behind", "rte": "route", "all": "allee", "imp": "impasse",
    "chem": "chemin",
}
# Postal codes by country.
POSTAL = {"INDIA": r"\b([1-9]\d{5})\b", "US": r"\b(\d{5})(?:-\d{4})?\b", "FRANCE": r"\b((?:0[1-9]|[1-8]\d|9[0-8])\d{3})\b"}
# Fixed value: a marked unit, or a number followed by a word.
HOUSE = (
    r"(?:^|[,\s])(?:h\.?no\.?|house\s+no\.?|flat\s+no\.?|plot\s+no\.?|unit|suite|#)\s*([a-z0-9\-\/]+)"
    r"|(?:^|[,\s])([0-9]{1,6}[a-z]?(?:[\-\/][0-9]{1,6}[a-z]?)?)(?:\s+[a-z]+)"
)
# States of the US by code, and of India.
US_STATES = {
    "al": "alabama", "ak": "alaska", "az": "arizona", "ar": "arkansas", "ca": "california", "co": "colorado", "ct": "connecticut",
    "de": "delaware", "fl": "florida", "ga": "georgia", "hi": "hawaii", "id": "idaho", "il": "illinois", "in": "indiana",
    "ia": "iowa", "ks": "kansas", "ky": "kentucky", "la": "louisiana", "me": "maine", "md": "maryland", "ma": "massachusetts",
    "mi": "michigan", "mn": "minnesota", "ms": "mississippi", "mo": "missouri", "mt": "montana", "ne": "nebraska", "nv": "nevada",
    "nh": "new hampshire", "nj": "new jersey", "nm": "new mexico", "ny": "new york", "nc": "north carolina", "nd": "north dakota",
    "oh": "ohio", "ok": "oklahoma", "or": "oregon", "pa": "pennsylvania", "ri": "rhode island", "sc": "south carolina",
    "sd": "south dakota", "tn": "tennessee", "tx": "texas", "ut": "utah", "vt": "vermont", "va": "virginia", "wa": "washington",
    "wv": "west virginia", "wi": "wisconsin", "wy": "wyoming", "dc": "district of columbia",
}
INDIA_STATES = [
    "andhra pradesh", "arunachal pradesh", "assam", "bihar", "chhattisgarh", "goa", "gujarat", "haryana", "himachal pradesh",
    "jharkhand", "karnataka", "kerala", "madhya pradesh", "maharashtra", "manipur", "meghalaya", "mizoram", "nagaland", "odisha",
    "punjab", "rajasthan", "sikkim", "tamil nadu", "telangana", "tripura", "uttar pradesh", "uttarakhand", "west bengal", "delhi",
    "jammu and kashmir", "ladakh", "chandigarh", "puducherry",
]
US_STATE = r"\b(" + "|".join(US_STATES) + r")\b|\b(" + "|".join(US_STATES.values()) + r")\b"
INDIA_STATE = r"\b(" + "|".join(INDIA_STATES) + r")\b"
# Name words that identify nobody.
STOP_WORDS = [
    "the", "and", "for", "with", "from", "all", "new", "one", "two", "center", "centre", "group", "services", "service",
    "solutions", "solution", "enterprises", "enterprise", "trading", "consulting", "investments", "investment", "associates",
    "international", "global", "holdings", "holding", "management", "industries", "industry", "corporation", "company", "limited",
    "private", "systems", "system", "tech", "technologies", "technology", "care", "health", "store", "shop", "mart", "market",
    "hotel", "restaurant", "cafe", "agency",
]
