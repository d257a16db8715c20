"""Locale-aware numbers and zone-aware local times as native expressions, with a reason for each failure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for a missing value, after trimming and in small letters (fixed values).
MISSING = ("", "-", "—", "n/a", "na", "null")
#: Shapes of numbers by locale (fixed values).
SHAPES = {"de": r"\A[+-]?(?:\d+|\d{1,3}(?:\.\d{3})+)(?:,\d+)?\z", "en": r"\A[+-]?(?:\d+|\d{1,3}(?:,\d{3})+)(?:\.\d+)?\z"}
_OUTER = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def trimmed(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, _OUTER, "")


def parse_number(text: Column, locale: str = "de") -> Column:
    """struct(value double, error string): error is null, ``missing`` or ``invalid_number``."""
    if locale not in SHAPES:
        raise ValueError(f"locale must be one of {sorted(SHAPES)}")
    outer = trimmed(text)
    bare = F.translate(outer, "\u00a0 ", "")
    plain = F.translate(F.translate(bare, ".", ""), ",", ".") if locale == "de" else F.translate(bare, ",", "")
    value = F.when(bare.rlike(SHAPES[locale]), plain.try_cast("double"))
    finite = F.abs(value) < F.lit(float("inf"))
    missing = text.isNull() | F.lower(outer).isin(*MISSING)
    return F.struct(
        F.when(~missing & finite, value).alias("value"),
        F.when(missing, "missing").when(F.coalesce(finite, F.lit(False)), F.lit(None)).otherwise("invalid_number").alias("error"),
    )


def parse_time(text: Column, pattern: str, zone: str = "Europe/Berlin", fold: Column | None = None, shift_seconds: int = 3600) -> Column:
    """struct(epoch long, error string) of a local time in ``zone``, under session time zone UTC.

    ``pattern`` is Spark's. A pattern with an offset (X) gives the instant itself. A local time that does not exist or that
    occurs twice has no epoch, unless ``fold`` (0 or 1) says which. ``shift_seconds``: how far clocks move.
    """
    outer = trimmed(text)
    wall = F.try_to_timestamp(outer, F.lit(pattern))
    missing = text.isNull() | (outer == "")
    seconds = F.unix_seconds(wall)
    if "X" in pattern:
        return F.struct(F.when(~missing, seconds).alias("epoch"), F.when(missing, "missing_timestamp").when(wall.isNull(), "invalid_timestamp").alias("error"))
    early = F.to_utc_timestamp(wall, zone)
    late = early + F.make_dt_interval(secs=F.lit(shift_seconds))
    exists = F.from_utc_timestamp(early, zone) == wall
    twice = F.from_utc_timestamp(late, zone) == wall
    chosen = fold.isin(0, 1) if fold is not None else F.lit(False)
    second = F.when(twice & (fold == 1), late).otherwise(early) if fold is not None else early
    error = (
        F.when(missing, "missing_timestamp").when(wall.isNull(), "invalid_timestamp").when(~exists, "nonexistent_local_time")
        .when(twice & ~F.coalesce(chosen, F.lit(False)), "ambiguous_local_time")
    )
    return F.struct(F.when(error.isNull(), F.unix_seconds(second)).alias("epoch"), error.alias("error"))


def negative_text(text: Column) -> Column:
    """Whether a number with comma groups is below zero; null where it's no number."""
    return F.regexp_replace(text, ",", "").try_cast("double") < 0


def safe_name(text: Column) -> Column:
    """``contract.safe_header`` of a column: small letters and digits, other runs as one underscore, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))
