"""Expressions for lists that are stored as text, such as
`city: Austin, subdivision_code: US-TX, country_code: US` or `name: A, name: B`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobgrain.functions.text import none_text_to_null


# What marks a name in a text list, and the signs around a text list.
NAME_MARK = r"name:\s*"
LIST_SIGNS = "[]{}"
_SPACES = " \t\n\r\x0b\f"


def value_of_key(c: Column, key: str) -> Column:
    """Text between `key:` and the next comma; of several, the last that is not
    empty. Text without such a value comes back unchanged. 'None' and blanks around
    are dropped."""
    pieces = F.split(c, f"{key}:")
    values = F.transform(F.slice(pieces, 2, F.size(pieces)), lambda x: F.substring_index(x, ",", 1))
    filled = F.filter(values, lambda x: x != "")
    last = F.ltrim(F.get(filled, F.size(filled) - 1), F.lit(_SPACES))
    return none_text_to_null(F.trim(F.coalesce(last, c)))


def value_of_first_key(guard: Column, c: Column, keys: list[str]) -> Column:
    """Value of the first of the keys that occurs (in any case) in `guard`;
    NULL when none does."""
    chain = None
    for key in keys:
        test, value = guard.ilike(f"%{key}:%"), value_of_key(c, key)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain


def place_of(guard: Column, c: Column) -> dict[str, Column]:
    """City, subdivision and country of one location text."""
    return {
        "city": value_of_first_key(guard, c, ["city"]),
        "subdivision_code": value_of_first_key(guard, c, ["subdivision_code", "state"]),
        "country_code": value_of_first_key(guard, c, ["country_code", "country"]),
    }


def location_parts(c: Column) -> Column:
    """The location text without brackets and braces, as an array of one: a text with
    several places stays whole."""
    return F.when(c.isNotNull(), F.array(F.translate(c, LIST_SIGNS, "")))


# One entry of a list: a brace, quoted texts (in which braces and commas are plain signs),
# other signs and entries inside of it, one deep, and the closing brace.
_QUOTED = r"""(?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")"""
ENTRY = rf"\{{\s*{_QUOTED}?(?:[:,\[]\s*{_QUOTED}|\{{[^{{}}]*\}}|[^{{}}])*\}}"


def key_pattern(key: str) -> str:
    """A key, bare or quoted, and its value: in single quotes, in double quotes, or up to the
    next comma, bracket or brace. One group for each kind of value."""
    value = r"""(?:'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)"|([^,{}\[\]]*))"""
    return rf"""(?:^|[\[{{,\s'"])(?i:{key})['"]?\s*:\s*{value}"""


def _value_in(entry: Column, keys: list[str]) -> Column:
    """Value of the first of the keys that has one; NULL for blanks and 'None'."""
    found = []
    for key in keys:
        for group in (1, 2, 3):
            value = F.trim(F.regexp_extract(entry, key_pattern(key), group))
            found.append(F.when(~value.isin("", "None"), value))
    return F.coalesce(*found)


def places_in(c: Column) -> Column:
    """The places of a text with any number of them, as an array: one for each entry in
    braces that has a city, or, without braces, one for the whole text. Unlike `place_of`,
    which takes the whole text as one place, this splits at the entries' braces, and neither
    braces nor commas inside quotes count."""
    inner = F.transform(
        F.regexp_extract_all(c, F.lit(ENTRY), F.lit(0)),
        # the outer braces are not the entry's own text
        lambda entry: F.substring(entry, F.lit(2), F.length(entry) - 2),
    )
    entries = F.when(F.size(inner) > 0, inner).otherwise(F.array(F.translate(c, LIST_SIGNS, "")))
    places = F.transform(
        entries,
        lambda entry: F.struct(
            _value_in(entry, ["city"]).alias("city"),
            _value_in(entry, ["subdivision_code", "state"]).alias("subdivision_code"),
            _value_in(entry, ["country_code", "country"]).alias("country_code"),
        ),
    )
    return F.filter(places, lambda place: place["city"].isNotNull())


def name_parts(c: Column) -> Column:
    """Array of the names in `name: A, name: B`, blanks trimmed, empty ones out.

    An entry of blanks only counts as filled before the trim and stays as ''.
    """
    parts = F.split(F.regexp_replace(c, NAME_MARK, ""), ",")
    return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.trim(x))
