"""Text keys and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------
# The characters Python counts as whitespace, for use inside a character class. Java's \s
# is ASCII only, so they are spelled out.
WHITESPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# The same characters one by one, for trimming.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# What a key is made of, and what it may not hold: all else but whitespace. A character that
# the JVM's Unicode version does not know (\p{Cn}) counts as part of a key, so that a name in a
# newer script keeps its key.
KEY_CHARACTER = r"[\p{L}\p{N}\p{Cn}_\-]"
ORDINARY = r"^[A-Za-z0-9 _\-]*\z"
NOT_KEY = r"[^\p{L}\p{N}\p{Cn}_\-" + WHITESPACE + "]"
LABEL_LIMIT = 28
# ---- end of fixed values ------------------------------------------------------------


def strip(text: Column) -> Column:
    """Remove whitespace of any Unicode kind at both ends (``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def has_key(name: Column) -> Column:
    """Whether the name's key is not empty; stops at the first key character."""
    return name.rlike(KEY_CHARACTER)


def canonical_key(name: Column) -> Column:
    """The join key of a display name; null gives the empty key.

    Ordinary names need neither of the two replacements, so both are guarded.
    """
    text = F.coalesce(name, F.lit(""))
    kept = F.when(text.rlike(ORDINARY), text).otherwise(F.regexp_replace(text, NOT_KEY, ""))
    joined = F.replace(strip(kept), F.lit(" "), F.lit("_"))
    return F.when(joined.contains("__"), F.regexp_replace(joined, "_{2,}", "_")).otherwise(joined)


def entity(park_name: Column, ride_key: Column) -> Column:
    """``site::unit``. Two sites may share a unit key, so the unit alone is no identity."""
    return F.concat(canonical_key(park_name), F.lit("::"), ride_key)


def entity_filename(entity_col: Column, suffix: str = ".json") -> Column:
    return F.concat(F.replace(entity_col, F.lit("::"), F.lit("__")), F.lit(suffix))


def shorten(label: Column, limit: int = LABEL_LIMIT) -> Column:
    """Labels over ``limit`` characters keep all but the last place, which holds an ellipsis."""
    cut = F.concat(F.substring(label, 1, limit - 1), F.lit("…"))
    return F.when(F.length(label) > limit, cut).otherwise(label)
