"""Typing of cleaned text (C09–C17, C19–C20) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The words the typed layer accepts as booleans.
TRUE_WORDS = ("1", "t", "true", "yes", "y")
FALSE_WORDS = ("0", "f", "false", "no", "n")
KEY_MAX_LEN = 50


def blank_null(c: Column) -> Column:
    """``NULLIF(TRIM(c), '')`` (SQL TRIM: spaces only)."""
    return F.nullif(F.trim(c), F.lit(""))


def to_bool(c: Column) -> Column:
    """True / false words → boolean, anything else → NULL."""
    low = F.lower(blank_null(c))
    return F.when(low.isin(*TRUE_WORDS), F.lit(True)).when(low.isin(*FALSE_WORDS), F.lit(False))


def to_date(c: Column, strict: bool = True) -> Column:
    """C11: strict (a bad value fails the job, ANSI) or lenient (NULL)."""
    v = blank_null(c)
    return v.cast("date") if strict else v.try_cast("date")


def to_timestamp_ntz(c: Column, strict: bool = True) -> Column:
    """Wall-clock timestamp without zone."""
    v = blank_null(c)
    return v.cast("timestamp_ntz") if strict else v.try_cast("timestamp_ntz")


def to_instant(c: Column, strict: bool = True) -> Column:
    """Text read as a UTC instant (session zone UTC; an explicit offset
    in the text wins)."""
    v = blank_null(c)
    return v.cast("timestamp") if strict else v.try_cast("timestamp")


def to_int(c: Column, strict: bool = True, kind: str = "int") -> Column:
    """C14: integer / long."""
    v = blank_null(c)
    return v.cast(kind) if strict else v.try_cast(kind)


def to_decimal(c: Column, strict: bool = True, kind: str = "decimal(38,10)") -> Column:
    """Unbounded numeric → decimal(38,10); ``kind='double'`` for the
    graph form."""
    v = blank_null(c)
    return v.cast(kind) if strict else v.try_cast(kind)


def composite_key(a: Column, b: Column, max_len: int | None = KEY_MAX_LEN) -> Column:
    """``a|b`` (a NULL part is skipped like SQL CONCAT), cut to
    ``max_len`` characters."""
    k = F.concat(F.coalesce(a, F.lit("")), F.lit("|"), F.coalesce(b, F.lit("")))
    return F.substring(k, 1, max_len) if max_len else k


def search_text(code: Column, brand: Column) -> Column:
    """lower(code + ' ' + brand) over the non-null parts; NULL if both
    are missing."""
    return F.nullif(F.lower(F.concat_ws(" ", code, brand)), F.lit(""))


def nest(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Move the listed columns into struct columns (one per group)."""
    moved = {c for cols in groups.values() for c in cols}
    keep = [c for c in df.columns if c not in moved]
    return df.select(*keep, *[F.struct(*cols).alias(g) for g, cols in groups.items()])


def unnest(df: DataFrame, groups: list[str]) -> DataFrame:
    """Inverse of :func:`nest`: dotted-path reads (C20) back to flat columns."""
    keep = [c for c in df.columns if c not in groups]
    return df.select(*keep, *[F.col(f"{g}.*") for g in groups])
