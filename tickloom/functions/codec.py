"""Codec of the 8-byte state and calibration frames, as column expressions over hex strings.

Layout: raw u16 and millidegrees i16, both little-endian, then node, chain and flags, then the XOR of the first seven
bytes.  A wrong checksum still decodes and is reported as ``valid = false``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schema import PVT_SCHEMA_VERSION

STATE_BASE, CALIB_BASE = 0x100, 0x300
#: Radians of a millidegree, folded in this order.
RAD_PER_MILLIDEG = math.pi / 180.0 / 1000.0


def byte_at(data: Column, k: int) -> Column:
    """The ``k``-th byte of a hex string as an integer."""
    return F.conv(F.substring(data, 2 * k + 1, 2), 16, 10).cast("int")


def checksum(data: Column) -> Column:
    """XOR of the first seven bytes."""
    out = byte_at(data, 0)
    for k in range(1, 7):
        out = out.bitwiseXOR(byte_at(data, k))
    return out


def _signed16(x: Column) -> Column:
    return F.when(x >= 32768, x - 65536).otherwise(x)


def decode(data: Column) -> Column:
    """``raw_adc, millideg, node_id, chain_index, status_flags, valid`` of a frame; raises if it has not 8 bytes."""
    whole = F.when(F.length(data) == 16, data).otherwise(F.raise_error(F.concat(F.lit("a frame has 8 bytes, got "), F.coalesce(data, F.lit("null")))))
    return F.struct(
        (byte_at(whole, 0) + byte_at(whole, 1) * 256).alias("raw_adc"),
        _signed16(byte_at(whole, 2) + byte_at(whole, 3) * 256).alias("millideg"),
        byte_at(whole, 4).alias("node_id"),
        byte_at(whole, 5).alias("chain_index"),
        byte_at(whole, 6).alias("status_flags"),
        (checksum(whole) == byte_at(whole, 7)).alias("valid"),
    )


def _hex(x: Column) -> Column:
    return F.lpad(F.lower(F.hex(x.cast("long"))), 2, "0")


def encode(raw: Column, millideg: Column, node: Column, chain: Column, flags: Column) -> Column:
    """Hex string of a state frame; values are masked to their widths."""
    raw, deg = raw.bitwiseAND(0xFFFF), F.pmod(millideg, F.lit(65536))
    parts = [raw.bitwiseAND(0xFF), F.shiftright(raw, 8), deg.bitwiseAND(0xFF), F.shiftright(deg, 8), *(x.bitwiseAND(0xFF) for x in (node, chain, flags))]
    last = parts[0]
    for p in parts[1:]:
        last = last.bitwiseXOR(p)
    return F.concat(*[_hex(p) for p in [*parts, last]])


def encode_calib(raw: Column, millideg: Column, node: Column, chain: Column, flags: Column) -> Column:
    """Like ``encode`` for calibration frames, which refuse values out of range instead of masking them."""
    fits = raw.between(0, 4095) & millideg.between(-32768, 32767) & node.between(0, 255) & chain.between(0, 255) & flags.between(0, 255)
    return F.when(fits, encode(raw, millideg, node, chain, flags)).otherwise(F.raise_error(F.lit("calibration value out of range")))


def decode_calib(data: Column) -> Column:
    """``raw_adc, calibrated_millideg, node_id, chain_index, status_flags, valid`` of a calibration frame, which is laid
    out as a state frame; raises if it has not 8 bytes."""
    s = decode(data)
    return F.struct(s["raw_adc"].alias("raw_adc"), s["millideg"].alias("calibrated_millideg"), *[s[c].alias(c) for c in ("node_id", "chain_index", "status_flags", "valid")])


def can_id(node: Column) -> Column:
    return node + STATE_BASE


def calib_can_id(node: Column) -> Column:
    return node + CALIB_BASE


def angle_rad(millideg: Column) -> Column:
    return millideg * F.lit(RAD_PER_MILLIDEG)


def reject_reason(valid: Column, angle: Column) -> Column:
    """Why a decoded frame is dropped, checksum first; null for one that is kept."""
    return F.when(~valid, F.lit("checksum_invalid")).when(~is_finite(angle), F.concat(F.lit("non_finite_angle_rad:"), F.lower(angle.cast("string"))))


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def status_bit(flags: Column, k: int) -> Column:
    return F.shiftright(flags, k).bitwiseAND(1)


def stamp_parts(ns: Column) -> Column:
    """Seconds and nanoseconds of a stamp."""
    return F.struct(((ns - F.pmod(ns, F.lit(1_000_000_000))) / 1_000_000_000).cast("long").alias("sec"), F.pmod(ns, F.lit(1_000_000_000)).alias("nanosec"))


def message(data: Column, t_ns: Column, frame_id: str = "joint_pod") -> Column:
    """The message of a received state frame: header with stamp and frame, and all fields; raises if it has not 8 bytes."""
    s = decode(data)
    header = F.struct(stamp_parts(t_ns).alias("stamp"), F.lit(frame_id).alias("frame_id"))
    return F.struct(
        header.alias("header"), *[s[c].alias(c) for c in ("node_id", "chain_index")], s["raw_adc"].alias("angle_raw_adc"), s["millideg"].alias("angle_millideg"), angle_rad(s["millideg"]).alias("angle_rad"),
        s["status_flags"].alias("status_flags"), s["valid"].alias("checksum_valid"), F.lit(PVT_SCHEMA_VERSION).alias("schema_version"),
    )
