"""Text views of names and addresses, as column expressions.

Everything but accent removal is a built-in expression inside whole-stage code
generation. Missing text is '' everywhere, so comparisons are two-valued.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import patterns as P

_FLAGS = "(?iU)"
#: The white space of ASCII, with its four separators.
_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"


@F.pandas_udf(StringType())
def _unaccented(texts: pd.Series) -> pd.Series:
    def one(t):
        return None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not "̀" <= c <= "ͯ").lower().strip()

    return texts.map(one)


def normalize_unicode(text: Column) -> Column:
    """Compatibility decomposition without combining marks, lower case, trimmed; null is ''.

    Only texts with a character beyond ASCII go through Python; the others send a null there.
    """
    other = F.when(F.octet_length(text) != F.char_length(text), text)
    return F.coalesce(_unaccented(other), F.btrim(F.lower(text), F.lit(_BLANKS)), F.lit(""))


def replaced(text: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(text, _FLAGS + pattern, by)


def collapsed(text: Column) -> Column:
    """White space runs as one space, trimmed."""
    return F.trim(replaced(text, r"\s+", " "))


def clean_text(text: Column) -> Column:
    return collapsed(F.regexp_replace(F.replace(normalize_unicode(text), F.lit("&"), F.lit(" and ")), r"(?U)[^a-z0-9\s]", " "))


def name_basic(text: Column) -> Column:
    """Words of a name: no accents, & as and, domains reduced, punctuation gone."""
    joined = replaced(F.replace(normalize_unicode(text), F.lit("&"), F.lit(" and ")), P.DOMAIN, "$1")
    return collapsed(F.regexp_replace(joined, r"(?U)[^a-z0-9\s]", " "))


def name_legal(basic: Column) -> Column:
    """The name without legal forms and noise words; the whole name where nothing else is left."""
    left = collapsed(replaced(basic, P.LEGAL, " "))
    return F.when(left == "", basic).otherwise(left)


def compact(plain: Column) -> Column:
    """Letters and digits alone, of text that is unaccented already."""
    return F.regexp_replace(plain, "[^a-z0-9]", "")


def tokens(plain: Column) -> Column:
    return F.filter(F.split(plain, " "), lambda t: t != "")


def ngrams(packed: Column, n: int = 3) -> Column:
    """Distinct n-grams; a shorter text is its own, an empty one has none."""
    runs = F.transform(F.sequence(F.lit(1), F.length(packed) - (n - 1)), lambda i: F.substring(packed, i, F.lit(n)))
    return F.when(F.length(packed) >= n, F.array_distinct(runs)).when(packed != "", F.array(packed)).otherwise(F.array().cast("array<string>"))


def address_basic(text: Column) -> Column:
    out = normalize_unicode(text)
    for short, long in P.ABBREVIATIONS.items():
        out = replaced(out, rf"\b{short}\b", long)
    return collapsed(F.regexp_replace(out, r"(?U)[^a-z0-9\s]", " "))


def _first(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, _FLAGS + pattern, group), F.lit(""))


def _country(country: Column) -> Column:
    return F.upper(F.trim(F.coalesce(country, F.lit(""))))


def postal_code(address: Column, country: Column) -> Column:
    """By country's pattern; for other and blank countries the first of India's, the US's and France's that hits."""
    which = _country(country)
    known = [(c, _first(address, p)) for c, p in P.POSTAL.items()]
    out = F.when(which == known[0][0], known[0][1])
    for c, hit in known[1:]:
        out = out.when(which == c, hit)
    return out.otherwise(F.coalesce(*[hit for _, hit in known]))


def house_number(address: Column) -> Column:
    """The first marked unit or leading number, if it has a digit; later hits are not tried."""
    hit = F.lower(F.coalesce(_first(address, P.HOUSE, 1), _first(address, P.HOUSE, 2)))
    return F.when(hit.rlike("[0-9]"), hit)


def state(address: Column, country: Column) -> Column:
    text, which = normalize_unicode(address), _country(country)
    code, name = _first(text, P.US_STATE, 1), _first(text, P.US_STATE, 2)
    by_code = F.create_map(*[F.lit(x) for pair in P.US_STATES.items() for x in pair])
    us = F.coalesce(F.try_element_at(by_code, code), name)
    india = _first(text, P.INDIA_STATE, 1)
    return F.when(which == "US", us).when(which == "INDIA", india).when(which == "", F.coalesce(us, india))
