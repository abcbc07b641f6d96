"""Alignment of target stamps with reference stamps: nearest, exact and within a window.

Nearest alignment sorts references and targets of an episode together once and looks left and right with running
values, instead of pairing them.  Window association joins on a bucket of the window's width, so each reference meets the
targets of three buckets only.  Reference and target tables have ``episode_id``, ``modality`` (targets) and ``ns``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.checks import whole_number
from tickloom.operators import segmented
from tickloom.schema import MAX_STAMP_NS, MIN_STAMP_NS

def _result(ref: Column, matched: Column, method: Column, in_budget: Column, any_target: Column, tie: Column) -> list[Column]:
    """Columns of a result; a miss shows neither stamp nor offset."""
    hit = matched.isNotNull() & in_budget
    return [
        ref.alias("ref_ns"),
        F.when(hit, matched).alias("matched_ns"),
        F.when(hit, matched - ref).alias("offset_ns"),
        method.alias("method"),
        hit.alias("within_budget"),
        F.when(hit, "matched").when(any_target, "out_of_budget").otherwise("no_target").alias("quality"),
        F.coalesce(hit & tie, F.lit(False)).alias("tie"),
    ]


#: A recording has a few modalities; more than this is taken for an error.
MOST_MODALITIES = 1000


def modalities_of(targets: DataFrame) -> list[str]:
    """Names of the modalities that occur."""
    found = [r["modality"] for r in targets.select("modality").distinct().limit(MOST_MODALITIES + 1).collect()]
    if len(found) > MOST_MODALITIES:
        raise ValueError(f"more than {MOST_MODALITIES} modalities")
    return sorted(m for m in found if m is not None)


def ordered_timeline(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``rows`` whose ``ns`` raises, when it is read, where it is no stamp, repeats the one before in order of ``seq`` or is
    earlier: such a timeline is normalised first, never sorted or thinned out here."""
    before = F.lag("ns").over(Window.partitionBy(*by).orderBy("seq"))
    at = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in (*by, "seq")])
    bad = lambda why: F.raise_error(F.concat(F.lit(f"{why} at "), at, F.lit(": "), F.coalesce(F.col("ns").cast("string"), F.lit("null"))))
    fine = F.when(F.col("ns").isNull() | ~F.col("ns").between(MIN_STAMP_NS, MAX_STAMP_NS), bad("no stamp")).when(F.col("ns") == F.col("__before"), bad("repeated stamp")).when(F.col("ns") < F.col("__before"), bad("stamp out of order")).otherwise(F.col("ns"))
    return rows.withColumn("__before", before).withColumn("ns", fine).drop("__before")


def both_ways(*by: str) -> tuple[WindowSpec, WindowSpec]:
    """The rows of a group at or before a stamp, and those at or after it.

    Both frames begin with the first row of their order: one that ends with the last row is computed anew for every row.
    """
    return tuple(Window.partitionBy(*by).orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in (F.asc("ns"), F.desc("ns")))


def _for_each(refs: DataFrame, modalities: list[str]) -> DataFrame:
    """Every reference once for each modality."""
    names = F.array(*[F.lit(m) for m in modalities]) if modalities else F.expr("cast(array() as array<string>)")
    return refs.select("episode_id", "ns", F.explode(names).alias("modality"))


def align_nearest(refs: DataFrame, targets: DataFrame, max_skew_ns: int, modalities: list[str] | None = None, long: bool = False, strict: bool = False) -> DataFrame:
    """One row for each reference and modality: the closer neighbour, the earlier of two equally close ones.

    ``modalities`` (default: those that occur) names what every reference is aligned with, so an episode without
    targets of one gives ``no_target``.  With ``long`` an episode is spread over many tasks.  With ``strict`` references and
    targets must be timelines in order of ``seq``, see ``ordered_timeline``.
    """
    whole_number(max_skew_ns, "max_skew_ns")
    if strict:
        refs, targets = ordered_timeline(refs, ("episode_id",)), ordered_timeline(targets, ("episode_id", "modality"))
    kinds = modalities if modalities is not None else modalities_of(targets)
    asked = _for_each(refs, kinds).select("episode_id", "modality", "ns")
    both = asked.withColumn("is_ref", F.lit(True)).unionByName(targets.select("episode_id", "modality", "ns", F.lit(False).alias("is_ref")))
    target = F.when(~F.col("is_ref"), F.col("ns"))
    if long:
        seen = segmented.last_and_next(both, ["episode_id", "modality"], "ns", {"target": (target, target)}).where("is_ref").withColumnsRenamed({"back_target": "before", "ahead_target": "after"})
    else:
        upto, onward = both_ways("episode_id", "modality")
        seen = both.withColumn("before", F.max(target).over(upto)).withColumn("after", F.min(target).over(onward)).where("is_ref")
    ref, before, after = F.col("ns"), F.col("before"), F.col("after")
    back, ahead = ref - before, after - ref
    matched = F.when(after.isNull() | (back <= ahead), before).otherwise(after)
    tie = (before != after) & (back == ahead)
    method = F.when(matched == ref, "exact").otherwise("nearest")
    near = F.abs(matched - ref) <= max_skew_ns
    method = F.when(matched.isNotNull() & near, method).otherwise("nearest")
    return seen.select("episode_id", "modality", *_result(ref, matched, method, near, matched.isNotNull(), tie))


def align_exact(refs: DataFrame, targets: DataFrame, modalities: list[str] | None = None, strict: bool = False) -> DataFrame:
    """One row for each reference and modality: the target at the same instant, if there is one.  ``strict`` as in
    ``align_nearest``."""
    if strict:
        refs, targets = ordered_timeline(refs, ("episode_id",)), ordered_timeline(targets, ("episode_id", "modality"))
    kinds = modalities if modalities is not None else modalities_of(targets)
    there = targets.groupBy("episode_id", "modality").agg(F.lit(True).alias("any"))
    asked = _for_each(refs, kinds).join(there, ["episode_id", "modality"], "left")
    hits = targets.select("episode_id", "modality", "ns", F.col("ns").alias("hit")).distinct()
    joined = asked.join(hits, ["episode_id", "modality", "ns"], "left")
    return joined.select("episode_id", "modality", *_result(F.col("ns"), F.col("hit"), F.lit("exact"), F.col("hit").isNotNull(), F.coalesce("any", F.lit(False)), F.lit(False)))


def align_window(refs: DataFrame, targets: DataFrame, window_ns: int, modalities: list[str] | None = None, strict: bool = False) -> DataFrame:
    """A row for each reference and target at most ``window_ns`` apart, both ends included; references without any give
    one ``no_target`` row.  ``strict`` as in ``align_nearest``."""
    if strict:
        refs, targets = ordered_timeline(refs, ("episode_id",)), ordered_timeline(targets, ("episode_id", "modality"))
    whole_number(window_ns, "window_ns", 1)
    kinds = modalities if modalities is not None else modalities_of(targets)
    # Exact whole numbers: the bucket below zero is one less than what division towards zero gives.
    bucket = F.expr(f"(ns - pmod(ns, {int(window_ns)}L)) div {int(window_ns)}L")
    asked = _for_each(refs, kinds).withColumn("bucket", bucket)
    near = asked.select("episode_id", "modality", F.col("ns").alias("ref"), F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)).alias("bucket")).distinct()
    found = near.join(targets.select("episode_id", "modality", F.col("ns").alias("target"), bucket.alias("bucket")), ["episode_id", "modality", "bucket"]).where(F.abs(F.col("target") - F.col("ref")) <= window_ns)
    joined = asked.select("episode_id", "modality", F.col("ns").alias("ref")).join(found.drop("bucket"), ["episode_id", "modality", "ref"], "left")
    return joined.select("episode_id", "modality", *_result(F.col("ref"), F.col("target"), F.lit("window"), F.col("target").isNotNull(), F.lit(False), F.lit(False)))


def bracket(refs: DataFrame, samples: DataFrame, value: str) -> DataFrame:
    """Every reference with the last sample at or before and the first at or after it: ``t0, v0, t1, v1``."""
    both = refs.select("episode_id", "ns", F.lit(True).alias("is_ref"), F.lit(None).cast("double").alias("v")).unionByName(samples.select("episode_id", "ns", F.lit(False).alias("is_ref"), F.col(value).alias("v")))
    upto, onward = both_ways("episode_id")
    sample = F.when(~F.col("is_ref"), F.struct("ns", "v"))
    seen = both.withColumn("a", F.max(sample).over(upto)).withColumn("b", F.min(sample).over(onward))
    return seen.where("is_ref").select("episode_id", "ns", F.col("a.ns").alias("t0"), F.col("a.v").alias("v0"), F.col("b.ns").alias("t1"), F.col("b.v").alias("v1"))
