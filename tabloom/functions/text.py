"""String expressions: cleaning, keys, phonetics, parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digit per letter A..Z for the 4-character phonetic code.
PHONETIC_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PHONETIC_DIGITS = "01230120022455012623010202"

# Suffix words removed from place names, as spelled.
PLACE_SUFFIXES = ("County", "Parish", "Borough", "city", "City", "COUNTY", "PARISH", "BOROUGH")
PLACE_WORDS_UPPER = (" COUNTY", " PARISH", " BOROUGH")

# Stop words of the rule-text tokeniser ("Isas" is one word).
RULE_STOP_WORDS = (
    "with", "therapies", "tried", "other", "equal", "to", "Does", "the", "a", "an", "of", "have",
    "or", "for", "is", "Isas", "in", "last", "malignant", "days", "less", "than", "total", "supply",
    "client", "agent", "hist", "dig", "other", "730", "30", "60", "5", "3", "Has", "(<)", "14",
    "received", "thp", "past", "(≤)", "365", "prescriber", "use", "higher", "strength",
    "requested", "Manual", "step", "–", "provided", ",",
)

# Number gate words and flag words of rule text.
RULE_NUMBER_GATES = {
    "age": "years of age",
    "no_of_days": "days",
    "mg_per_day": "dose",
    "units_per_day": "units/day",
}
RULE_FLAGS = {
    "contains_inj": "inj",
    "contains_nas": "nas",
    "dh": "hist",
    "disinfo": "dig",
    "theinfo": "thp",
    "manual_step": "Manual",
}

_PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def float_text(x: Column) -> Column:
    """A double as the shortest decimal text: ``7.0``, ``12345678.0``, ``1e-05``.

    Spark switches to ``E`` notation at 1e7 and below 1e-3; this keeps plain
    notation from 1e-4 up to 1e16 and a two-digit exponent outside.
    """
    raw = x.cast("string")
    parts = F.split(raw, "E")
    exponent = F.try_element_at(parts, F.lit(2)).try_cast("int")
    plain = F.regexp_replace(raw.try_cast("decimal(38,18)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    scientific = F.concat(
        F.regexp_replace(F.element_at(parts, 1), r"\.0$", ""),
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(exponent).cast("string"), 2, "0"),
    )
    size = F.abs(x)
    return (
        F.when(~raw.contains("E"), raw)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def clean_categorical(x: Column) -> Column:
    """Blank or null to ``NA``; leading zeros off; numeric text to float text."""
    t = F.regexp_replace(x.cast("string"), r"^\s+|\s+$", "")
    t = F.when(t.isNull() | t.isin("", "nan"), F.lit("NA")).otherwise(t)
    t = F.when((F.length(t) > 1) & ~t.contains("0."), F.regexp_replace(t, "^0+", "")).otherwise(t)
    number = F.when(t.rlike(_PLAIN_NUMBER), t).try_cast("double")
    t = F.coalesce(float_text(number), t)
    return F.when(t == "", F.lit("NA")).otherwise(t)


def phonetic_code(name: Column) -> Column:
    """First letter plus three digits; vowels do not separate equal codes and
    the first letter's own code is not compared."""
    rest = F.translate(F.upper(F.substr(name, F.lit(2))), PHONETIC_LETTERS, PHONETIC_DIGITS)
    digits = F.regexp_replace(F.regexp_replace(rest, "[^1-6]", ""), r"(.)\1+", "$1")
    code = F.concat(F.upper(F.substring(name, 1, 1)), F.rpad(F.substring(digits, 1, 3), 3, "0"))
    return F.when(F.length(name) > 0, code)


def title_case(x: Column) -> Column:
    """Capital after every non-letter, as in ``O'Neil`` and ``Mc-Donald``."""
    runs = F.regexp_extract_all(F.lower(x), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def standardize_place(name: Column) -> Column:
    """Trim, drop one trailing suffix word after another in order, title case."""
    t = F.regexp_replace(name, r"^\s+|\s+$", "")
    for suffix in PLACE_SUFFIXES:
        t = F.regexp_replace(t, rf"\s+{suffix}$", "")
    return title_case(F.trim(t))


def standardize_place_upper(name: Column) -> Column:
    t = F.upper(F.trim(name))
    for word in PLACE_WORDS_UPPER:
        t = F.replace(t, F.lit(word), F.lit(""))
    return t


def composite_key(*parts: Column, sep: str = "_") -> Column:
    """Joined key; null when any part is null, so unknowns never match."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(p.cast("string"))
    return F.concat(*pieces)


def canonical_key(x: Column) -> Column:
    return F.upper(F.trim(x.cast("string")))


def categorize(x: Column, rules: Sequence[tuple[Sequence[str], str]], default: str, missing: str) -> Column:
    """First rule with a contained keyword (upper-cased) wins."""
    up = F.upper(x)
    out = F.when(x.isNull(), F.lit(missing))
    for keywords, label in rules:
        hit = F.lit(False)
        for k in keywords:
            hit = hit | up.contains(k)
        out = out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def yes_no(x: Column) -> Column:
    return F.when(x == "Yes", F.lit(1)).when(x == "No", F.lit(0))


def tolerant_int(x: Column) -> Column:
    return F.trim(x).try_cast("int")


def normalize_title(x: Column, literal_dot: bool = False) -> Column:
    """Lower; cut at the first ``-``, then ``ii``, then ``/``; trim; senior."""
    t = F.lower(x)
    for mark in ("-", "ii", "/"):
        t = F.substring_index(t, mark, 1)
    t = F.regexp_replace(t, r"^\s+|\s+$", "")
    t = F.regexp_replace(t, r"sr\." if literal_dot else "sr.", "senior")
    return F.when(~t.isin("nan", "nat"), t)


def contains_flag(x: Column, keyword: str) -> Column:
    return F.contains(F.lower(x), F.lit(keyword)).cast("int")


def keyword_any(x: Column, lexicon: Sequence[str]) -> Column:
    """1.0 when any lexicon entry is a substring of the lower-cased text."""
    low = F.lower(x)
    hit = F.lit(False)
    for k in lexicon:
        hit = hit | F.contains(low, F.lit(k))
    return hit.cast("double")


def keyword_fraction(x: Column, lexicon: Sequence[str]) -> Column:
    """Share of lexicon entries found as substrings of the lower-cased text."""
    low = F.lower(x)
    hits = F.lit(0)
    for k in lexicon:
        hits = hits + F.contains(low, F.lit(k)).cast("int")
    return hits / F.lit(float(len(lexicon)))


def gated_number(x: Column, gate: str) -> Column:
    """First integer of the text, only where the gate words occur."""
    return F.when(x.contains(gate), F.nullif(F.regexp_extract(x, r"(\d+)", 1), F.lit("")))


def rule_tokens(x: Column, stop: Sequence[str] = RULE_STOP_WORDS) -> Column:
    words = F.filter(F.split(F.trim(x), r"\s+"), lambda t: t != "")
    return F.filter(words, lambda t: ~t.isin(*sorted(set(stop))))


def prefix(x: Column, n: int = 2000) -> Column:
    return F.substring(x, 1, n)


def pii_hash(x: Column, salt: str | None = None) -> Column:
    """base64 of the SHA-256 bytes; null becomes empty text."""
    body = x.cast("string") if salt is None else F.concat(F.lit(salt), x.cast("string"))
    return F.coalesce(F.base64(F.unhex(F.sha2(body, 256))), F.lit(""))


def person_title(name: Column, groups: Sequence[tuple[Sequence[str], str]]) -> Column:
    """Second part of a name split at commas and dots, with merged groups."""
    title = F.regexp_replace(F.try_element_at(F.split(name, "[,.]"), F.lit(2)), "^ ", "")
    out = None
    for members, label in groups:
        hit = title.isin(*members)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return title if out is None else out.otherwise(title)


def surname(name: Column) -> Column:
    return F.element_at(F.split(name, "[,.]"), 1)


def camel_key(name: str) -> str:
    """``copay_max`` -> ``copayMax``; other separators and underscores go."""
    head, *tail = [p for p in name.replace("-", "_").replace(" ", "_").split("_") if p] or [""]
    return head[:1].lower() + head[1:] + "".join(p[:1].upper() + p[1:] for p in tail)


def camel_key_col(x: Column) -> Column:
    parts = F.filter(F.split(x, "[-_ ]"), lambda p: p != "")
    head = F.element_at(parts, 1)
    cased = F.transform(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2))),
    )
    first = F.concat(F.lower(F.substring(head, 1, 1)), F.substr(head, F.lit(2)))
    return F.concat(first, F.array_join(cased, ""))
