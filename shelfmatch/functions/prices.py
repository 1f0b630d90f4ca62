"""Price and label text functions (C1-C6) as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmatch.functions.text import py_strip

# --- fixed values -------------------------------------------------------------
PRICE_MARKERS = r"đ|VND|\d+[.,]\d+"
SKU_PATTERN = r"(?i)sku[=/](\w+)"
CRAWL_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_price(c: Column | str) -> Column:
    """Remove '₫' and '.', strip, to integer; unparsable -> null."""
    return py_strip(F.regexp_replace(_c(c), "[₫.]", "")).try_cast("bigint")


def format_price(c: Column | str) -> Column:
    """Integer amount -> '29.990.000₫' (thousands dots, dong sign)."""
    return F.concat(F.replace(F.format_number(_c(c).cast("bigint"), 0), F.lit(","), F.lit(".")), F.lit("₫"))


def strip_label(c: Column | str, label: str) -> Column:
    """Remove a fixed label (every occurrence) and strip."""
    return py_strip(F.replace(_c(c), F.lit(label), F.lit("")))


def reward_points(c: Column | str) -> Column:
    """C3 (D7): the digits of the first number in the text, thousands dots removed."""
    return F.regexp_replace(F.regexp_extract(_c(c), r"([0-9.]+)", 1), "[.]", "").try_cast("bigint")


def pick_price_text(candidates: Column | str) -> Column:
    """C4: first candidate (in priority order) that looks like a price, stripped."""
    return py_strip(F.get(F.filter(_c(candidates), lambda x: x.rlike(PRICE_MARKERS)), 0))


def sku_from_url(c: Column | str) -> Column:
    """``sku=<word>`` or ``sku/<word>`` (case-insensitive), else null."""
    return F.nullif(F.regexp_extract(_c(c), SKU_PATTERN, 1), F.lit(""))


def crawl_time(ts: Column | str) -> Column:
    """UTC second-resolution text (session time zone is UTC)."""
    return F.date_format(_c(ts), CRAWL_TIME_FORMAT)
