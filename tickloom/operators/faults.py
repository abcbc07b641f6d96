"""Reproducible timing faults.

``stamps`` has ``episode_id, idx, timestamp_ns``; ``idx`` counts from 0 within an episode.  Faults that draw random
numbers take them from the generator of Python's ``random`` module, seeded by stream name, as recorded fixtures do.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.schema import MAX_STAMP_NS, MIN_STAMP_NS


def in_range(t: Column) -> Column:
    """The stamp; raises outside the range of stamps (sums beyond 64 bits raise by themselves)."""
    return F.when(t.between(MIN_STAMP_NS, MAX_STAMP_NS), t).otherwise(F.raise_error(F.concat(F.lit("stamp out of range: "), t.cast("string"))))


def fixed_delay(stamps: DataFrame, delay_ns: int) -> DataFrame:
    return stamps.withColumn("timestamp_ns", in_range(F.col("timestamp_ns") + delay_ns))


def burst_delay(stamps: DataFrame, start: int, length: int, delay_ns: int) -> DataFrame:
    late = F.col("idx").between(start, start + length - 1)
    return stamps.withColumn("timestamp_ns", F.when(late, in_range(F.col("timestamp_ns") + delay_ns)).otherwise(F.col("timestamp_ns")))


def drop_every(stamps: DataFrame, k: int) -> DataFrame:
    if k < 2:
        raise ValueError("k must be 2 or more")
    return stamps.where((F.col("idx") + 1) % k != 0)


def duplicate(stamps: DataFrame, at: int) -> DataFrame:
    """The stamp at index ``at`` twice; later ones move up."""
    twice = stamps.withColumn("idx", F.explode(F.when(F.col("idx") == at, F.array(F.col("idx"), F.col("idx") + 1)).when(F.col("idx") > at, F.array(F.col("idx") + 1)).otherwise(F.array("idx"))))
    return twice


def swap(stamps: DataFrame, j: int) -> DataFrame:
    """The stamps at ``j`` and ``j + 1`` in each other's place."""
    return stamps.withColumn("idx", F.when(F.col("idx") == j, j + 1).when(F.col("idx") == j + 1, j).otherwise(F.col("idx")).cast("long"))


def skewed_clock(stamps: DataFrame, offset_ns: int, drift_ppm: float) -> DataFrame:
    """A constant offset and a drift since the first stamp, rounded half to even."""
    t0 = F.first("timestamp_ns").over(Window.partitionBy("episode_id").orderBy("idx"))
    drift = F.rint(F.lit(float(drift_ppm)) * (F.col("timestamp_ns") - F.col("t0")).cast("double") / 1e6).cast("long")
    return stamps.withColumn("t0", t0).withColumn("timestamp_ns", in_range(F.col("timestamp_ns") + offset_ns + drift)).drop("t0")


def stream_seed(seed: int, label: str) -> int:
    """Seed of the named stream of a seed: 32-bit FNV-1a of the name, by exclusive or."""
    h = 0x811C9DC5
    for b in label.encode():
        h = (h ^ b) * 0x01000193 % (1 << 32)
    return seed ^ h


def drawn(stamps: DataFrame, seed: int, label: str, draw: str, a: float, b: float) -> DataFrame:
    """``stamps`` with ``draw``: for each index the draw of that number of the stream (``uniform`` or ``randint``).

    A generator of this kind cannot jump ahead, so the draws of a stream are made in order, in one task, for the longest
    episode (not for the table), and joined by index.
    """
    longest = stamps.agg(F.coalesce(F.max("idx"), F.lit(-1)).alias("last"))

    def draws(batches):
        import pandas as pd

        for some in batches:
            for last in some["last"]:
                r = random.Random(stream_seed(seed, label))
                for at in range(0, last + 1, 10_000):
                    m = min(10_000, last + 1 - at)
                    yield pd.DataFrame({"idx": range(at, at + m), "draw": [float(getattr(r, draw)(a, b)) for _ in range(m)]})

    return stamps.join(longest.mapInPandas(draws, "idx long, draw double"), "idx")


def jitter(stamps: DataFrame, magnitude_ns: int, seed: int, label: str = "fault[0]:jitter") -> DataFrame:
    """Each stamp moved by up to ``magnitude_ns``, but not past the middle to its neighbours."""
    order = Window.partitionBy("episode_id").orderBy("idx")
    t, half = F.col("timestamp_ns"), lambda x, y: F.shiftright(x + y, 1)
    moved = drawn(stamps, seed, label, "randint", -magnitude_ns, magnitude_ns).withColumn("p", F.lag("timestamp_ns").over(order)).withColumn("n", F.lead("timestamp_ns").over(order))
    low = F.when(F.col("p").isNull(), F.greatest(F.lit(MIN_STAMP_NS).cast("long"), t - magnitude_ns)).otherwise(half(F.col("p"), t) + 1)
    high = F.when(F.col("n").isNull(), t + magnitude_ns).otherwise(half(t, F.col("n")))
    return moved.withColumn("timestamp_ns", in_range(F.greatest(low, F.least(high, t + F.col("draw").cast("long"))))).drop("p", "n", "draw")


def variable_frame_time(stamps: DataFrame, wobble: float, seed: int, label: str = "fault[0]:variable_frame_time") -> DataFrame:
    """Each interval scaled by its draw, 1 ns at least; the changes add up."""
    order = Window.partitionBy("episode_id").orderBy("idx")
    # The first stamp draws nothing, so interval i uses draw i - 1.
    back = stamps.withColumn("dt", F.col("timestamp_ns") - F.lag("timestamp_ns").over(order)).withColumn("first", F.first("timestamp_ns").over(order)).withColumn("own", F.col("idx")).withColumn("idx", F.greatest(F.col("idx") - 1, F.lit(0)))
    scaled = drawn(back, seed, label, "uniform", 1.0 - wobble, 1.0 + wobble).withColumn("idx", F.col("own"))
    step = F.when(F.col("dt").isNull(), 0).otherwise(F.greatest(F.lit(1).cast("long"), F.rint(F.col("dt") * F.col("draw")).cast("long")))
    return scaled.withColumn("timestamp_ns", in_range(F.col("first") + F.sum(step).over(order.rowsBetween(Window.unboundedPreceding, 0)))).drop("dt", "first", "own", "draw")


def drop_randomly(stamps: DataFrame, probability: float, seed: int, label: str = "fault[0]:drop") -> DataFrame:
    return drawn(stamps, seed, label, "uniform", 0.0, 1.0).where(F.col("draw") >= probability).drop("draw")


def reorder(stamps: DataFrame, start: int, length: int, seed: int, label: str = "fault[0]:reorder") -> DataFrame:
    """One adjacent pair within the window in the other order; which one is drawn."""
    return swap(stamps, start + random.Random(stream_seed(seed, label)).randint(0, length - 2))


#: Parameters of each kind of fault (fixed values); ``drop`` takes one of its two.
PARAMETERS = {
    "jitter": {"magnitude_ns"}, "fixed_delay": {"delay_ns"}, "burst_delay": {"delay_ns", "window_start", "window_len"}, "drop": {"every_k", "probability"}, "duplicate": {"at_index"},
    "reorder": {"window_start", "window_len"}, "skewed_clock": {"offset_ns", "drift_ppm"}, "variable_frame_time": {"wobble"},
}
_LEAST = {"magnitude_ns": 1, "delay_ns": 1, "window_start": 0, "window_len": 1, "every_k": 2, "at_index": 0, "offset_ns": None}


def check_fault(fault: dict) -> dict:
    """The fault, a ``kind`` with its parameters; raises for one that is unknown, incomplete or would change nothing."""
    kind, given = fault.get("kind"), {k: v for k, v in fault.items() if k != "kind" and v is not None}
    if kind not in PARAMETERS:
        raise ValueError(f"unknown kind of fault {kind!r}; there are {', '.join(PARAMETERS)}")
    wanted = PARAMETERS[kind]
    if set(given) - wanted:
        raise ValueError(f"{kind} does not use {', '.join(sorted(set(given) - wanted))}")
    if len(given) != (1 if kind == "drop" else len(wanted)):
        raise ValueError(f"{kind} needs {'one of ' if kind == 'drop' else ''}{', '.join(sorted(wanted))}")
    for name, value in given.items():
        if isinstance(value, bool) or not isinstance(value, int if name in _LEAST else (int, float)) or value != value or abs(value) == float("inf"):
            raise ValueError(f"{name} is no number of its kind: {value!r}")
        if name in _LEAST and _LEAST[name] is not None and value < _LEAST[name]:
            raise ValueError(f"{name} must be {_LEAST[name]} at least, got {value}")
        if name in ("probability", "wobble") and not 0 < value < 1:
            raise ValueError(f"{name} must lie between 0 and 1, got {value}")
    if kind == "reorder" and given["window_len"] < 2:
        raise ValueError("a window to reorder has two stamps at least")
    if kind == "skewed_clock" and not given["offset_ns"] and not given["drift_ppm"]:
        raise ValueError("a clock without offset and drift is not skewed")
    return {"kind": kind, **given}


def _numbered(stamps: DataFrame) -> DataFrame:
    """``idx`` counted anew from 0, after stamps went."""
    return stamps.withColumn("idx", (F.row_number().over(Window.partitionBy("episode_id").orderBy("idx")) - 1).cast("long"))


def _reaching(stamps: DataFrame, last: int, what: str) -> DataFrame:
    """``stamps``; raises for an episode without an index ``last``."""
    there = F.max("idx").over(Window.partitionBy("episode_id")) >= last
    return stamps.withColumn("timestamp_ns", F.when(there, F.col("timestamp_ns")).otherwise(F.raise_error(F.lit(f"{what} is past the end of an episode"))))


def _increasing(stamps: DataFrame, kind: str) -> DataFrame:
    """``stamps``; raises where one is not above the one before."""
    before = F.lag("timestamp_ns").over(Window.partitionBy("episode_id").orderBy("idx"))
    rises = before.isNull() | (F.col("timestamp_ns") > before)
    return stamps.withColumn("timestamp_ns", F.when(rises, F.col("timestamp_ns")).otherwise(F.raise_error(F.lit(f"{kind} needs increasing stamps: apply what breaks their order later"))))


def chain(stamps: DataFrame, faults: list[dict], seed: int) -> DataFrame:
    """The faults one after the other, each with a stream of draws of its own, named by place and kind.

    So a fault's draws depend on the seed, its place and its kind only, and longer chains do not change earlier faults.
    No faults leave the stamps as they are.
    """
    for i, fault in enumerate(map(check_fault, faults)):
        kind, label = fault["kind"], f"fault[{i}]:{fault['kind']}"
        if kind == "jitter":
            stamps = jitter(_increasing(stamps, kind), fault["magnitude_ns"], seed, label)
        elif kind == "fixed_delay":
            stamps = fixed_delay(stamps, fault["delay_ns"])
        elif kind == "burst_delay":
            stamps = burst_delay(_reaching(stamps, fault["window_start"], "the start of a burst"), fault["window_start"], fault["window_len"], fault["delay_ns"])
        elif kind == "drop":
            stamps = _numbered(drop_every(stamps, fault["every_k"]) if "every_k" in fault else drop_randomly(stamps, fault["probability"], seed, label))
        elif kind == "duplicate":
            stamps = duplicate(_reaching(stamps, fault["at_index"], "the stamp to repeat"), fault["at_index"])
        elif kind == "reorder":
            stamps = reorder(_reaching(stamps, fault["window_start"] + fault["window_len"] - 1, "a window to reorder"), fault["window_start"], fault["window_len"], seed, label)
        elif kind == "skewed_clock":
            stamps = skewed_clock(stamps, fault["offset_ns"], fault["drift_ppm"])
        else:
            stamps = variable_frame_time(_increasing(stamps, kind), fault["wobble"], seed, label)
    return stamps


#: The recorded disturbances: stamps, period and faults of each (fixed values).
FIXTURE_SEED, FIXTURE_START_NS = 104, 1_000_000_000
FIXTURES = {
    "can_jitter_mild": (200, 10_000_000, [{"kind": "jitter", "magnitude_ns": 200_000}]),
    "camera_variable_33ms": (90, 33_333_333, [{"kind": "variable_frame_time", "wobble": 0.04}]),
    "burst_stall_200ms": (200, 10_000_000, [{"kind": "burst_delay", "delay_ns": 200_000_000, "window_start": 100, "window_len": 20}]),
    "skewed_source_clock": (200, 10_000_000, [{"kind": "skewed_clock", "offset_ns": 5_000_000, "drift_ppm": 500.0}]),
}
