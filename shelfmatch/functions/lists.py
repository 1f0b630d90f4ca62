"""List-valued columns of the variant comparison: parsing the list text forms
and splitting comma lists (L1-L3), all as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmatch.functions.text import PY_WS, py_strip

#: A bare ``None`` between list marks that an even number of quotes follows, i.e. outside of quotes.
NONE_ELEMENT = r"""(?<=[\[,]\s{0,8})None(?=\s*[,\]](?:[^'"]*(?:'[^']*'|"[^"]*"))*[^'"]*$)"""

# --- fixed value: the colour prefix the reference strips from every colour ---
COLOUR_PREFIX = "Màu "


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_list_literal(c: Column | str) -> Column:
    """L1: Python list literal text -> array<string>; null, non-list or malformed -> [].

    Single-quoted Python strings are accepted by Spark's JSON reader
    (``allowSingleQuotes``); a bare ``None`` element becomes JSON ``null``.
    """
    text = F.regexp_replace(_c(c), NONE_ELEMENT, "null")
    parsed = F.from_json(text, "array<string>", {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})
    return F.coalesce(parsed, F.array().cast("array<string>"))


def split_capacities(c: Column | str) -> Column:
    """L2: null -> '', drop all whitespace, split on ',', drop empties."""
    compact = F.regexp_replace(F.coalesce(_c(c), F.lit("")), rf"(?U){PY_WS}+", "")
    return F.filter(F.split(compact, ","), lambda x: x != "")


def split_colours(c: Column | str) -> Column:
    """L3: split on ',', strip, drop blanks, remove every 'Màu '; null -> []."""
    parts = F.filter(F.transform(F.split(_c(c), ","), lambda x: py_strip(x)), lambda x: x != "")
    cleaned = F.transform(parts, lambda x: F.replace(x, F.lit(COLOUR_PREFIX), F.lit("")))
    return F.coalesce(cleaned, F.array().cast("array<string>"))
