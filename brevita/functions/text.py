"""Text normalisation as native column expressions.

Python's ``\\s`` and ``str.strip`` cover Unicode whitespace while Java's ``\\s`` covers six ASCII
characters, so every rule below names its whitespace class in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as whitespace, and the three clean-up patterns. The class is written so that
# Java tests a bit set first and looks at the rarer code points only from U+1680 on; a flat list of ranges
# takes three times as long per character.
WS = (
    r"[\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0"
    r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]"
)
NOT_WS = r"[^\s\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
HEADER = rf"(?isu)^{WS}*\p{{Nd}}+[a-z]{{2}}{WS}+CONGRESS.*?(?:Session|SESSION){WS}+{NOT_WS}+{WS}+"
PAGE_MARK = rf"\[Page{WS}+[A-Z0-9]+\]"

# How far the header may reach, and how the near-duplicate key is cut.
HEADER_WINDOW = 400
KEY_WINDOW = 800
KEY_LENGTH = 500


def strip(c: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.regexp_replace(c, rf"^{WS}+|{WS}+\z", "")


def clean(c: Column) -> Column:
    """Straighten TeX quotes, drop one leading session header and page marks, squeeze whitespace."""
    quoted = F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("``"), F.lit('"')), F.lit("''"), F.lit('"'))
    headless = F.concat(
        F.regexp_replace(F.substring(quoted, 1, HEADER_WINDOW), HEADER, ""),
        F.substring(quoted, HEADER_WINDOW + 1, 2_147_483_647),
    )
    squeezed = F.regexp_replace(F.regexp_replace(headless, PAGE_MARK, ""), f"{WS}+", " ")
    return F.trim(squeezed)


def near_dup_key(c: Column) -> Column:
    """Letters and digits of the opening of a cleaned text; equal keys mean near-duplicates."""
    opening = F.lower(F.substring(c, 1, KEY_WINDOW))
    return F.substring(F.regexp_replace(opening, "[^a-z0-9]+", ""), 1, KEY_LENGTH)


def key_digest(key: Column) -> Column:
    """32-byte digest of a key, so a shuffle moves 32 bytes instead of up to 500 characters."""
    return F.unhex(F.sha2(key, 256))


def with_cleaned(df: DataFrame, columns: tuple[str, ...] = ("text", "summary")) -> DataFrame:
    """Replace ``columns`` by their cleaned form, each computed exactly once per row.

    A plain projection would let Catalyst copy the regex chain into every later filter. Filters are
    not pushed below a generator, so a one-element ``inline`` keeps the chain in one place.
    """
    cleaned = F.array(F.struct(*[clean(F.col(c)).alias(c) for c in columns]))
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(cleaned)).select(*df.columns)
