"""Values of trip attributes, as Column expressions.

Each vocabulary maps exact spellings. A value outside it becomes null here and
is told from a missing one by `operators.quality.unmapped`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that the feeds use, and what they stand for.
GENDERS = {"0": "unknown", "1": "male", "2": "female", "Male": "male", "Female": "female", "M": "male", "F": "female", "O": "other", "?": "unknown", "m": "male", "f": "female"}
MEMBERS = {"Subscriber": True, "Customer": False, "member": True, "casual": False, "Member": True, "Casual": False, "Annual Member": True, "Casual Member": False}
BIKE_TYPES = {
    "classic_bike": "classic", "electric_bike": "electric", "docked_bike": "classic", "electric_scooter": None, "standard": "classic", "electric": "electric",
    "smart": "classic", "classic": "classic", "CLASSIC": "classic", "PBSC_EBIKE": "electric", "一般車": "classic", "電輔車": "electric", "일반자전거": "classic",
    "BIK_002": "classic", "새싹자전거": "classic", "BIK_003": "classic", "ICONIC": "classic", "EFIT": "electric", "EFIT G5": "electric", "ASTRO": "electric",
}
NULL_TOKENS = ("", "NULL", "\\N")


def clean(raw: Column) -> Column:
    """Trimmed text; null tokens are null."""
    text = F.trim(raw)
    return F.when(~text.isin(*NULL_TOKENS), text)


def mapped(raw: Column, table: dict) -> Column:
    """The table's value for the exact cleaned text, else null."""
    pairs = [x for k, v in table.items() if v is not None for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), clean(raw))


def gender(raw: Column) -> Column:
    return mapped(raw, GENDERS)


def is_member(raw: Column) -> Column:
    return mapped(raw, MEMBERS)


def bike_type(raw: Column) -> Column:
    """classic, electric, or null for a known kind that is neither."""
    return mapped(raw, BIKE_TYPES)


def is_known(raw: Column, table: dict) -> Column:
    """Whether a cleaned text is missing or in the table."""
    text = clean(raw)
    return text.isNull() | text.isin(*table)


def birth_year(raw: Column, missing: tuple[str, ...] = ("", "NA", "NULL", "\\N"), least: int = 1900, strict: bool = True) -> Column:
    """Markers to null, `1994.0` to 1994, years below `least` to null; other text raises under ANSI, or is null if not `strict`."""
    text = F.regexp_replace(F.trim(raw), r"\.0$", "")
    told = F.when(~text.isin(*missing), text)
    year = told.cast("int") if strict else told.try_cast("int")
    return F.when(year >= least, year)


def is_year(raw: Column, missing: tuple[str, ...] = ("", "NA", "NULL", "\\N")) -> Column:
    """Whether a birth year is missing, a marker or a number."""
    text = F.regexp_replace(F.trim(raw), r"\.0$", "")
    return raw.isNull() | text.isin(*missing) | text.try_cast("int").isNotNull()


def station_id(raw: Column) -> Column:
    """Trimmed; leading zeros go from ids of digits only."""
    text = F.trim(raw)
    return F.when(text.rlike(r"^\d+$"), F.regexp_replace(text, r"^0+(\d)", "$1")).otherwise(text)


def sentinels_to_null(value: Column, sentinels: tuple[str, ...]) -> Column:
    return F.when(~value.isin(*sentinels), value)


def degrees(raw: Column) -> Column:
    return raw.try_cast("double")


def wkt_point(raw: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of `POINT (lng lat)`; null where it does not match."""
    pattern = r"^\s*POINT\s*\(\s*(-?[0-9.]+)\s+(-?[0-9.]+)\s*\)\s*$"
    return F.regexp_extract(raw, pattern, 2).try_cast("double"), F.regexp_extract(raw, pattern, 1).try_cast("double")
