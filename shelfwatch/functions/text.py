"""Text helpers: trimming, first regex group, prices, days, counts. All JVM-side columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the first character (a currency sign, as a rule) is skipped
PRICE_PATTERN = r".([0-9.]+\.?[0-9]*)"
COUNT_OF_PATTERN = r"(?i)[0-9]+ of ([0-9]+)"
COUNT_ITEMS_PATTERN = r"(?i)([0-9]+) item"

_BLANK = r"[\s\x{1c}-\x{1f}]"


def strip(col: Column) -> Column:
    """Cut all white space at both ends; ``trim`` cuts blanks only."""
    return F.regexp_replace(col, f"(?U)^{_BLANK}+|{_BLANK}+$", "")


def first_group(col: Column, pattern: str) -> Column:
    """First group of the first match, null if there is none."""
    return F.nullif(F.regexp_extract(col, pattern, 1), F.lit(""))


def split_plain(col: Column, sep: str, limit: int = -1) -> Column:
    """Split at a literal separator."""
    return F.split(col, re.escape(sep), limit)


def price_in_text(col: Column, thousands: bool = False) -> Column:
    """Price in a display text, as DOUBLE.

    The plain form skips one leading character and stops at a comma ("35.00" gives 5.0,
    "£1,299.00" gives 1.0); ``thousands`` reads such texts as a person would.
    """
    if thousands:
        found = first_group(F.replace(col, F.lit(","), F.lit("")), r"([0-9]+(?:\.[0-9]+)?)")
    else:
        found = first_group(col, PRICE_PATTERN)
    return found.try_cast("double")


def cut_first(col: Column) -> Column:
    """Text without its first character."""
    return F.substring(col, 2, 2147483647)


def min_price_text(prices: Column) -> Column:
    """Smallest of an array of display prices **as text** after cutting the currency sign.

    Text order: "10.00" is smaller than "9.00". Null entries are skipped.
    """
    texts = F.transform(F.filter(prices, lambda p: p.isNotNull()), cut_first)
    return F.array_min(texts)


def min_price_number(prices: Column, thousands: bool = False) -> Column:
    """Smallest of an array of display prices as a number."""
    return F.array_min(F.transform(prices, lambda p: price_in_text(p, thousands)))


def day_of(col: Column) -> Column:
    """Day of a ``yyyy-MM-dd hh:mm:ss`` text; one-digit months and days are fine, else null."""
    day = F.substring_index(col, " ", 1)
    shaped = F.when(day.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"), day)
    return F.try_to_date(shaped, "y-M-d")


def page_count(col: Column) -> Column:
    """N of "x of N"."""
    return first_group(col, COUNT_OF_PATTERN).try_cast("int")


def item_count(col: Column) -> Column:
    """N of the first "N item"."""
    return first_group(col, COUNT_ITEMS_PATTERN).try_cast("int")


def product_key(shop: Column, product_id: Column) -> Column:
    """Key of a product over all days; a missing id reads "nan", a missing shop gives null."""
    return F.concat(shop, F.lit("_"), F.coalesce(product_id.cast("string"), F.lit("nan")), F.lit("_"))
