"""Interval statistics and the gates that accept or refuse an episode.

Statistics are exact.  The intervals of an episode are counted by value before anything is gathered, and the median and
the 99th percentile are read from running counts, so no task holds the intervals of an episode as one list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.codec import is_finite
from tickloom.schema import FLOATS


@dataclass(frozen=True)
class JitterBudget:
    """Largest 99th percentile of the jitter, gap factor that makes a dropout, least number of samples."""

    p99_ns: int = 2_000_000
    gap_factor: float = 2.5
    min_samples: int = 2


def distinct_instants(samples: DataFrame) -> DataFrame:
    """Each instant of an episode once, in the order of first appearance."""
    return samples.groupBy("episode_id", "timestamp_ns").agg(F.min("seq").alias("seq"))


def intervals(samples: DataFrame) -> DataFrame:
    """``episode_id, seq, dt`` between consecutive samples in order of arrival; null for the first."""
    order = Window.partitionBy("episode_id").orderBy("seq")
    return samples.select("episode_id", "seq", "timestamp_ns", (F.col("timestamp_ns") - F.lag("timestamp_ns").over(order)).alias("dt"))


def at_rank(counted: DataFrame, value: str, ranks: dict[str, Column], by: tuple[str, ...] = ("episode_id",)) -> DataFrame:
    """For each group the values at 1-based ranks, which may depend on ``n``, from counts (``times``) by value."""
    order = Window.partitionBy(*by).orderBy(value)
    running = counted.withColumn("upto", F.sum("times").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.sum("times").over(Window.partitionBy(*by)))
    return running.groupBy(*by).agg(*[F.min(F.when(F.col("upto") >= r, F.col(value))).alias(name) for name, r in ranks.items()])


def nearest_rank_percentiles(rows: DataFrame, value: str, by: tuple[str, ...], percents: dict[str, float]) -> DataFrame:
    """Observed values at the rank ``ceil(percent / 100 * n)``."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("times"))
    return at_rank(counted, value, {k: nearest_rank(F.col("n"), p) for k, p in percents.items()}, by)


def percentile_rank(n: Column, share: float = 99.0) -> Column:
    """Rank by rounding half to even, between 1 and n."""
    return F.least(F.greatest(F.rint(F.lit(share / 100.0) * n), F.lit(1.0)), n.cast("double")).cast("long")


def nearest_rank(n: Column, percent: float) -> Column:
    """Rank by rounding up: the other percentile rule, used for published offsets."""
    return F.ceil(F.lit(percent / 100.0) * n).cast("long")


def jitter(samples: DataFrame, budget: JitterBudget | None = None) -> DataFrame:
    """``n_samples, period_ns, max_jitter_ns, p99_jitter_ns, backwards, dropouts, n_intervals`` of every episode.

    The period is the median interval (mean of the middle two, rounded down); jitter is the distance from it; intervals
    of 0 or less are backwards; longer than ``gap_factor`` periods are dropouts.  One sample has no intervals: all 0.
    """
    budget = budget or JitterBudget()
    dt, off, times, period = (F.col(c) for c in ("dt", "off", "times", "period_ns"))
    # One chain of windows: a join of the medians, or of the percentiles, would make the counts again for each side.  The
    # row whose ``dt`` is null counts samples without an interval.
    counted = intervals(samples).groupBy("episode_id", "dt").agg(F.count("*").alias("times")).withColumn("there", F.when(dt.isNotNull(), times))
    whole = Window.partitionBy("episode_id")
    upto = lambda c: F.sum("there").over(whole.orderBy(c).rowsBetween(Window.unboundedPreceding, 0))
    at = lambda value, run, rank: F.min(F.when(F.col(run) >= rank, value))
    n = F.col("n")
    ranked = counted.withColumn("upto", upto("dt")).withColumn("n", F.sum("there").over(whole))
    middle = ranked.withColumn("low", at(dt, "upto", F.floor((n + 1) / 2)).over(whole)).withColumn("high", at(dt, "upto", F.floor(n / 2) + 1).over(whole))
    spread = middle.withColumn("period_ns", F.shiftright(F.col("low") + F.col("high"), 1)).withColumn("off", F.abs(dt - period)).withColumn("upto_off", upto("off"))
    gap = (period > 0) & (dt > period * F.lit(budget.gap_factor))
    out = spread.groupBy("episode_id").agg(
        F.sum("times").alias("n_samples"), F.max("period_ns").alias("period_ns"), F.max("off").alias("max_jitter_ns"), at(off, "upto_off", percentile_rank(n)).alias("p99_jitter_ns"),
        F.sum(F.when(dt <= 0, times)).alias("backwards"), F.sum(F.when(gap, times)).alias("dropouts"), F.sum("there").alias("n_intervals"),
    )
    names = ["period_ns", "max_jitter_ns", "p99_jitter_ns", "backwards", "dropouts", "n_intervals"]
    return out.select("episode_id", "n_samples", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names])


def budget_reasons(budget: JitterBudget | None = None) -> Column:
    """Why statistics break the budget, in fixed order; an empty array for none."""
    b = budget or JitterBudget()
    return F.array_compact(
        F.array(
            F.when(F.col("n_samples") < b.min_samples, F.concat(F.lit("too_few_samples:"), F.col("n_samples"))),
            F.when(F.col("backwards") > 0, F.concat(F.lit("backwards:"), F.col("backwards"))),
            F.when(F.col("dropouts") > 0, F.concat(F.lit("dropouts:"), F.col("dropouts"))),
            F.when(F.col("p99_jitter_ns") > b.p99_ns, F.concat(F.lit("p99_jitter_ns:"), F.col("p99_jitter_ns"))),
        )
    )


def recorder_gate(samples: DataFrame, budget: JitterBudget | None = None) -> DataFrame:
    """Statistics over every sample with ``ok`` and ``reasons``: all four checks."""
    return jitter(samples, budget).withColumn("reasons", budget_reasons(budget)).withColumn("ok", F.size("reasons") == 0)


def finite_row() -> Column:
    """Whether all four floats are finite."""
    out = F.lit(True)
    for c in FLOATS:
        out = out & is_finite(F.col(c))
    return out


def export_gate(samples: DataFrame, budget: JitterBudget | None = None) -> DataFrame:
    """``episode_id, ok, reason``: rows with non-finite floats go first; an episode left empty, backwards or with
    dropouts is refused; the percentile is not looked at."""
    kept = jitter(distinct_instants(samples.where(finite_row())), budget)
    every = samples.select("episode_id").distinct().join(kept, "episode_id", "left")
    reason = F.when(F.col("n_samples").isNull(), "empty").when(F.col("backwards") > 0, "backwards").when(F.col("dropouts") > 0, "dropouts")
    return every.select("episode_id", reason.isNull().alias("ok"), reason.alias("reason"))


def frame_gate(samples: DataFrame, budget: JitterBudget | None = None) -> DataFrame:
    """``episode_id, exported, quality_failed, reason`` over distinct instants: backwards and dropouts refuse, a high
    percentile only flags."""
    return judged_frames(jitter(distinct_instants(samples), budget), budget)


def judged_frames(stats: DataFrame, budget: JitterBudget | None = None) -> DataFrame:
    """``frame_gate`` from statistics over distinct instants."""
    b = budget or JitterBudget()
    reason = F.when(F.col("backwards") > 0, "backwards").when(F.col("dropouts") > 0, "dropouts")
    return stats.select("episode_id", reason.isNull().alias("exported"), (reason.isNull() & (F.col("p99_jitter_ns") > b.p99_ns)).alias("quality_failed"), reason.alias("reason"))
