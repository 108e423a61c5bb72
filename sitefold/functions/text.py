"""Name, identifier and address normalisers as column expressions. Null and blank give ''."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from sitefold.vocabulary import LEGAL_SUFFIXES, STOPWORDS


def _folded(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


@F.pandas_udf(StringType())
def _changes(s: pd.Series) -> pd.Series:
    """Of different characters those that folding changes, each followed by what it becomes, NUL between them; null if none does."""
    changed = lambda x: "\0".join(c + f for c in x for f in [_folded(c)] if f != c) or None
    return s.map(changed, na_action="ignore")


def strip_accents(c: Column) -> Column:
    """Compatibility-decomposed without combining marks. The one Arrow UDF here: Spark has no such built-in. Folding goes
    character by character, as only combining marks change places, so Python sees a text's different characters beyond
    ASCII, not the text."""
    beyond = F.when(c.rlike("[^\\x00-\\x7F]"), F.array_join(F.array_distinct(F.split(F.regexp_replace(c, "[\\x00-\\x7F]+", ""), "")), ""))
    changes = F.split(_changes(beyond), "\u0000")
    replaced = F.aggregate(changes, c.cast("string"), lambda text, x: F.replace(text, F.substring(x, 1, 1), F.substring(x, 2, 99)))
    return F.coalesce(replaced, c, F.lit(""))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "\\s+", " "))


def folded_text(c: Column) -> Column:
    """norm_text of a column that strip_accents has already folded, for callers that fold once."""
    return squeeze(F.regexp_replace(F.lower(c), "[^\\p{L}\\p{N}_\\s]", " "))


def norm_text(c: Column) -> Column:
    return folded_text(strip_accents(c))


def _parts(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda x: x != "")


def folded_name(text: Column) -> Column:
    """norm_name of a norm_text."""
    return F.array_join(F.filter(_parts(text), lambda x: ~x.isin(*LEGAL_SUFFIXES)), " ")


def norm_name(c: Column) -> Column:
    """norm_text without legal suffixes."""
    return folded_name(norm_text(c))


def folded_tokens(name: Column) -> Column:
    """name_tokens of a norm_name."""
    return F.array_distinct(F.filter(_parts(name), lambda x: (F.length(x) > 1) & ~x.isin(*STOPWORDS)))


def name_tokens(c: Column) -> Column:
    """Distinct words of the normalised name that tell names apart."""
    return folded_tokens(norm_name(c))


def token_set_ratio(a: Column, b: Column) -> Column:
    """Jaccard of two token arrays; 0 if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def norm_id(scheme: Column, value: Column) -> Column:
    """SCHEME:VALUE with words for 'number' and marks removed; null if nothing is left. Without a scheme, the value."""
    v = F.upper(strip_accents(value))
    v = F.regexp_replace(v, "\\b(EST|ESTAB|ESTABLISHMENT|NO|N|NUM|NUMERO|APPROVAL)\\b\\.?", " ")
    v = F.regexp_replace(F.regexp_replace(v, "\\s*/\\s*", "/"), "[^A-Z0-9/]", "")
    v = F.btrim(v, F.lit("/"))
    return F.when(v != "", F.when(F.coalesce(scheme, F.lit("")) != "", F.concat_ws(":", scheme, v)).otherwise(v))


def norm_postcode(c: Column) -> Column:
    return F.regexp_replace(F.upper(strip_accents(c)), "[^A-Z0-9]", "")


def house_number(address: Column) -> Column:
    return F.regexp_extract(F.coalesce(address, F.lit("")), "(?U)\\b([0-9]{1,6})\\s*[a-zA-Z]?\\b", 1)


def addr_key(address: Column, postcode: Column) -> Column:
    """POSTCODE#NUMBER, POSTCODE# or ''."""
    p = norm_postcode(postcode)
    return F.when(p == "", F.lit("")).otherwise(F.concat(p, F.lit("#"), house_number(address)))


def same_name(a: Column, b: Column) -> Column:
    """Equal texts that aren't empty; both already normalised."""
    return (a == b) & (a != "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def truthy(c: Column) -> Column:
    """Blank is null; no words are false; yes words and anything else are true."""
    v = F.lower(F.trim(c))
    return F.when(v.isNull() | (v == ""), F.lit(None).cast("boolean")).otherwise(~v.isin("n", "no", "false", "0", "f"))


def lookup(c: Column, table: dict[str, str]) -> Column:
    """table[c] or null; for small fixed tables."""
    keys, values = F.array(*map(F.lit, table)), F.array(*map(F.lit, table.values()))
    return F.get(values, F.array_position(keys, c).cast("int") - 1)


def matches(c: Column, patterns) -> Column:
    """Names whose pattern is found in c, in order, once each. patterns: a dict or (name, pattern) pairs."""
    pairs = patterns.items() if isinstance(patterns, dict) else patterns
    return F.array_distinct(F.array_compact(F.array(*[F.when(c.rlike(p), F.lit(n)) for n, p in pairs])))


def contained(c: Column, table: dict[str, str]) -> Column:
    """Values whose key is a part of c, in order, once each."""
    return F.array_distinct(F.array_compact(F.array(*[F.when(c.contains(k), F.lit(v)) for k, v in table.items()])))


def bracket_split(c: Column) -> Column:
    """Split at commas outside brackets, trimmed, without blanks."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ",(?![^(]*\\))"), lambda x: F.trim(x)), lambda x: x != "")


def mapped(values: Column, table: dict[str, str], strip_unconfirmed: bool = False) -> tuple[Column, Column]:
    """(sorted distinct mapped values, values without a mapping)."""
    clean = (lambda x: F.trim(F.regexp_replace(F.lower(x), "\\(unconfirmed\\)", ""))) if strip_unconfirmed else (lambda x: F.trim(F.lower(x)))
    known = F.array_sort(F.array_distinct(F.array_compact(F.transform(values, lambda x: lookup(clean(x), table)))))
    return known, F.filter(values, lambda x: lookup(clean(x), table).isNull())


def ordered_distinct(c: Column) -> Column:
    return F.array_distinct(c)


def resolve_exact(headers: list[str], *candidates: str) -> str | None:
    """The header that equals a candidate, candidates in order, after folding; a later header wins a tie."""
    seen = {_plain(h): h for h in headers}
    return next((seen[_plain(c)] for c in candidates if _plain(c) in seen), None)


def resolve(headers: list[str], *candidates: str, required: bool = False) -> str | None:
    """resolve_exact, else the first header that contains a candidate. Raises HeaderError if required."""
    found = resolve_exact(headers, *candidates)
    if found is None:
        found = next((h for c in candidates for h in headers if _plain(c) in _plain(h)), None)
    if found is None and required:
        raise HeaderError(f"none of {candidates} among the headers {headers}")
    return found


def _plain(header: str) -> str:
    return "".join(x for x in header.lower() if x.isascii() and x.isalnum())


class HeaderError(ValueError):
    """The input lacks a column that the register's rows cannot do without."""
