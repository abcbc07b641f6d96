"""Checks of parameters and of columns: what passes is unchanged, anything else raises and says what it was."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schema import MAX_STAMP_NS


def whole_number(value: object, name: str, least: int = 0, most: int = MAX_STAMP_NS) -> int:
    """A parameter that is a whole number of a range; truth values and fractions are none."""
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{name} must be a whole number, got {value!r}")
    if not least <= value <= most:
        raise ValueError(f"{name} must be from {least} to {most}, got {value}")
    return value


def proportion(value: object, name: str) -> float:
    """A parameter from 0 to 1."""
    if isinstance(value, bool) or not isinstance(value, int | float) or not 0 <= value <= 1:
        raise ValueError(f"{name} must be from 0 to 1, got {value!r}")
    return float(value)


def _raised(name: str, why: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"{name} {why}, got "), F.coalesce(value.cast("string"), F.lit("null"))))


def member(token: Column, known: list[str], name: str) -> Column:
    """A token that is one of the ``known`` ones; null and unknown tokens raise, none is guessed."""
    return F.when(token.isin(known), token).otherwise(_raised(name, f"must be one of {', '.join(known)}", token))


def count(value: Column, name: str) -> Column:
    """A count, 0 or more; null raises."""
    return F.when(value >= 0, value).otherwise(_raised(name, "must be 0 or more", value))


def offset(value: Column, name: str) -> Column:
    """A signed offset whose absolute value is a BIGINT too, or null for none."""
    return F.when(value.isNull() | (value >= -MAX_STAMP_NS), value).otherwise(_raised(name, f"must be {-MAX_STAMP_NS} or more", value))


def ratio(value: Column, name: str) -> Column:
    """A number from 0 to 1; null and NaN raise."""
    return F.when(value.between(0.0, 1.0) & ~F.isnan(value), value).otherwise(_raised(name, "must be from 0 to 1", value))
