"""Text lines of joint states for terminals."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 40


def bar(angle: Column, width: int = WIDTH) -> Column:
    """A bar over minus to plus pi: ``#`` at the angle, which is clamped, ``|`` at zero."""
    share = (F.least(F.lit(math.pi), F.greatest(F.lit(-math.pi), angle)) + math.pi) / (2 * math.pi)
    at = F.rint(share * (width - 1)).cast("int")
    centre = round((width - 1) / 2)
    empty = F.overlay(F.lit("-" * width), F.lit("|"), F.lit(centre + 1))
    return F.overlay(empty, F.lit("#"), at + 1)


def _padded(text: Column, width: int, pad: str = " ") -> Column:
    """``text`` at the right of ``width`` characters; a longer one stays whole."""
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit(pad))


def degrees(millideg: Column) -> Column:
    """Degrees with sign and two places, eight wide, rounded as the binary fraction is.

    Java rounds the decimal digits of a fraction; at ``...5`` millidegrees that may differ.  There the error of the
    quotient decides: ``q * 1000`` is computed exactly as a sum of two doubles.
    """
    size = F.abs(millideg).cast("double")
    q = size / 1000.0
    high = 134217729.0 * q - (134217729.0 * q - q)
    error = (high * 1000.0 - size) + (q - high) * 1000.0
    whole = F.floor(size / 10.0)
    up = F.when(size % 10 != 5, size % 10 > 5).when(error != 0, error > 0).otherwise(whole % 2 == 1)
    cents = (whole + up.cast("int")).cast("long")
    sign = F.when(millideg < 0, "-").otherwise("+")
    text = F.concat(sign, F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    return _padded(text, 8)


def pod_line(node: Column, chain: Column, millideg: Column, angle: Column, flags: Column, valid: Column) -> Column:
    """One line of a pod: node and chain, degrees, bar, flags, and a mark for a wrong checksum."""
    state = F.when(flags == 0, F.lit("ok")).otherwise(F.concat(F.lit("0x"), _padded(F.hex(flags.cast("long")), 2, "0")))
    return F.concat(
        F.lit("pod "), _padded(node.cast("string"), 2), F.lit(":"), F.rpad(chain.cast("string"), F.greatest(F.lit(2), F.length(chain.cast("string"))), F.lit(" ")), F.lit(" "), degrees(millideg), F.lit(" deg  ["), bar(angle), F.lit("] "), state, F.when(valid, F.lit("")).otherwise(F.lit(" CK!"))
    )


def display(states: DataFrame, rows: int = 1000) -> list[str]:
    """Lines for a terminal, in order of chain and node: a screen of at most ``rows`` joints."""
    line = pod_line(F.col("node_id"), F.col("chain_index"), F.col("millideg"), F.col("angle_rad"), F.col("status_flags"), F.col("valid"))
    return [r["line"] for r in states.orderBy("chain_index", "node_id").limit(rows).select(line.alias("line")).collect()]
