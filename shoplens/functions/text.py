"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A maker's web domain is its lower-cased name without these, taken
# out one after another, at most 30 characters, under ".ru".
NOT_IN_DOMAIN = (" ", "«", "»", "ооо", "ао", "ип")
DOMAIN_MAX_CHARS = 30
DOMAIN_SUFFIX = ".ru"

# White space as str.strip() sees it: every Unicode white-space character and
# the four ASCII separators U+001C..U+001F ((?U)\s covers the former).
_WS = r"[\s\x{1c}-\x{1f}]"
STRIP = rf"(?U)^{_WS}+|{_WS}+$"
_SPACE, _OTHER = rf"(?U){_WS}", r"(?U)[^\s\x{1c}-\x{1f}]"


def maker_domain(name: Column) -> Column:
    """Web domain of a maker. ASSUMPTION: when nothing is left of the name,
    the first 12 hex digits of its md5 (a fixed choice instead of a random
    domain)."""
    left = F.lower(name)
    for x in NOT_IN_DOMAIN:
        left = F.replace(left, F.lit(x), F.lit(""))
    label = F.coalesce(F.nullif(F.substring(left, 1, DOMAIN_MAX_CHARS), F.lit("")),
                       F.substring(F.md5(F.coalesce(name, F.lit(""))), 1, 12))
    return F.concat(label, F.lit(DOMAIN_SUFFIX))


def maker_website(name: Column) -> Column:
    return F.concat(F.lit("https://"), maker_domain(name))


def strip(text: Column) -> Column:
    """``text`` without white space of any kind at its ends. Only texts that
    begin or end with something else than spaces to remove are searched."""
    some = F.trim(text)
    ends = F.concat(F.substring(some, 1, 1), F.substring(some, -1, 1))
    return F.when(ends.rlike(_SPACE), F.regexp_replace(some, STRIP, "")).otherwise(some)


def is_blank(text: Column) -> Column:
    """Whether nothing would be left of ``text``; NULL for NULL."""
    return ~text.rlike(_OTHER)
