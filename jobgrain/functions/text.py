"""Text, number and time expressions used by the cleaning rules.

All of them are built-in Spark functions, so they stay inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the cleaning rules count as white space
# (tab to carriage return, the four ASCII separators, next line, and every
# Unicode space, line and paragraph separator).
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same as a character class. Unicode mode (?U) makes \\s cover all but the four
# separators, and is several times faster than listing the ranges.
_SPACE = r"\s\x1c-\x1f"

# Fixed value: text that stands for a missing value in the raw layer.
NONE_TEXT = "None"


def strip(c: Column) -> Column:
    """Trim every kind of white space (not just blanks)."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def collapse_spaces(c: Column) -> Column:
    """Each run of white space becomes one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(c, f"(?U)[{_SPACE}]+", " "))


def drop_parenthesised(c: Column) -> Column:
    return F.regexp_replace(c, r"\([^)]*\)", "")


def keep_word_characters(c: Column) -> Column:
    """Remove everything but letters, digits, underscore and white space."""
    return F.regexp_replace(c, rf"(?U)[^\p{{L}}\p{{N}}_{_SPACE}]", "")


def normalize_title(c: Column) -> Column:
    """Lower case, no parenthesised part, `-`, `/` and `,` as blanks, single blanks.
    Separators and white space go in one pass, since both end as one blank."""
    return F.trim(
        F.regexp_replace(drop_parenthesised(F.lower(c)), f"(?U)[-/,{_SPACE}]+", " ")
    )


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def empty_to_null(c: Column) -> Column:
    """Empty array or map becomes NULL."""
    return F.when(F.size(c) > 0, c)


def none_text_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(NONE_TEXT))


def has_text(c: Column) -> Column:
    """True for a value that is present, not blank and not the text 'None'."""
    trimmed = F.trim(c)
    return c.isNotNull() & ~trimmed.isin("", NONE_TEXT)


def first_filled(*cs: Column) -> Column:
    """First value that is neither NULL nor the empty string; the last argument
    is returned as it is when nothing before it is filled."""
    return F.coalesce(*[blank_to_null(c) for c in cs[:-1]], cs[-1])


def parse_timestamp(c: Column) -> Column:
    """Timestamp in UTC, NULL when the text is no timestamp."""
    return F.try_to_timestamp(c)


def parse_number(c: Column) -> Column:
    """Double, NULL when the text is no number."""
    return c.try_cast("double")


def strict_id(c: Column) -> Column:
    """64-bit id. A missing or malformed id fails the job."""
    return F.when(c.isNull(), F.raise_error(F.lit("missing id")).cast("bigint")).otherwise(
        c.cast("bigint")
    )


def lenient_id(c: Column) -> Column:
    """64-bit id or NULL; for callers that set bad rows aside."""
    return c.try_cast("bigint")


def first_name(items: Column, strict: bool = False) -> Column:
    """`name` of the first element of an array of structs.

    Lenient: NULL when there is none. Strict: a missing or empty array fails.
    """
    if not strict:
        return F.get(items, F.lit(0))["name"]
    return F.when(
        F.coalesce(F.size(items), F.lit(-1)) < 1,
        F.raise_error(F.lit("no first element")).cast("string"),
    ).otherwise(F.get(items, F.lit(0))["name"])


def split_trimmed(c: Column, sep: str = ",") -> Column:
    """Parts between separators, each trimmed of white space."""
    return F.transform(F.split(c, sep, -1), strip)


def decode_list(c: Column, element: str) -> Column:
    """Array of structs from text that holds a list of records.

    The text may be JSON or the literal form with single quotes, `None` and
    `\\xNN` escapes. Blank or unreadable text gives an empty array.
    `element` is the struct type of one record, as DDL.
    """
    with_null = F.regexp_replace(c, r"(?<=': )None(?=[,}])", "null")
    with_escape = F.regexp_replace(
        with_null, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2"
    )
    schema = f"ARRAY<{element}>"
    parsed = F.from_json(
        with_escape,
        schema,
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"},
    )
    return F.coalesce(parsed, F.array().cast(schema))


def round_whole(c: Column) -> Column:
    """Round to a whole number, half away from zero, as an exact decimal."""
    return F.round(c.cast("decimal(38,6)"), 0)


def ilike_pattern(text: str) -> str:
    """Pattern for a substring match. `%` and `_` in the text stay wildcards; a
    backslash that escapes nothing is taken literally."""
    out, i = [], 0
    while i < len(text):
        ch = text[i]
        if ch == "\\":
            if text[i + 1 : i + 2] in ("%", "_", "\\") and text[i + 1 : i + 2]:
                out.append(text[i : i + 2])
                i += 2
                continue
            out.append("\\\\")
        else:
            out.append(ch)
        i += 1
    return "%" + "".join(out) + "%"
