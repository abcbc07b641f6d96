"""Putting raw stamps on one timeline: flag, never repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators import segmented
from tickloom.schema import MAX_STAMP_NS, MIN_STAMP_NS


def normalize(stamps: DataFrame, domain: str = "monotonic", offset_ns: int | None = None, by: tuple[str, ...] = ("episode_id",), long: bool = False) -> DataFrame:
    """``stamps`` with ``normalized_ns, skew_ns, flags``; rows keep their order of arrival ``seq``.

    A stamp that is not above all earlier ones of its stream is ``backwards_in_source``.  Monotonic stamps pass
    unchanged; source stamps need a known offset, and one that leaves the range of stamps is ``skew_out_of_range``.
    Any flag leaves ``normalized_ns`` null.  With ``long`` an episode is spread over many tasks.
    """
    if domain not in ("monotonic", "source"):
        raise ValueError(f"stamps of domain {domain!r} cannot be normalized")
    raw, columns = F.col("timestamp_ns"), stamps.columns
    if long:
        stamps = segmented.running_max_before(stamps, list(by), "seq", "timestamp_ns", "__before")
    else:
        stamps = stamps.withColumn("__before", F.max("timestamp_ns").over(Window.partitionBy(*by).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)))
    backwards = raw <= F.col("__before")
    if domain == "monotonic":
        value, skew, flag = raw, F.lit(None).cast("long"), F.lit(None).cast("string")
    elif offset_ns is None:
        value, skew, flag = F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit("unknown_skew")
    else:
        value = F.try_add(raw, F.lit(offset_ns).cast("long"))
        skew = F.lit(offset_ns).cast("long")
        flag = F.when(value.isNull() | ~value.between(MIN_STAMP_NS, MAX_STAMP_NS), "skew_out_of_range")
    flags = F.array_compact(F.array(F.when(backwards, "backwards_in_source"), flag))
    out = stamps.withColumn("flags", flags).withColumn("skew_ns", skew).withColumn("normalized_ns", F.when(F.size("flags") == 0, value))
    return out.select(*[F.col(f"`{c}`") for c in [*columns, "flags", "skew_ns", "normalized_ns"]])


def split(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean and flagged records."""
    return records.where("normalized_ns is not null"), records.where("normalized_ns is null")


def disorder(timeline: DataFrame, by: tuple[str, ...] = ("episode_id",)) -> DataFrame:
    """Rows that break a strictly increasing timeline; empty for a valid one."""
    order = Window.partitionBy(*by).orderBy("seq")
    return timeline.withColumn("before", F.lag("timestamp_ns").over(order)).where("timestamp_ns <= before")
