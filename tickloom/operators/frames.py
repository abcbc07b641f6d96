"""Frame datasets: rows of one instant as arrays, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.ordered import running

ARRAYS = {"observation.state": "joint_angle", "observation.velocity": "joint_velocity", "observation.current": "motor_current", "observation.torque": "estimated_torque"}


def unanimous(column: str) -> Column:
    """The value that all rows have, null included as a value; null if they differ."""
    c = F.col(column)
    return F.when((F.count(c) == F.count("*")) & (F.min(c) == F.max(c)), F.min(c))


def pivot(samples: DataFrame) -> DataFrame:
    """One row for each episode and instant; arrays in order of chain, then arrival.

    An instant of an episode has a row for each joint, so its arrays are short.
    """
    parts = F.array_sort(F.collect_list(F.struct("chain_index", "seq", *ARRAYS.values())))
    out = samples.groupBy("episode_id", "timestamp_ns").agg(parts.alias("parts"), unanimous("camera_frame_id").alias("camera_frame_id"), unanimous("tactile_event").alias("tactile_event"))
    arrays = [F.col(f"parts.{c}").alias(name) for name, c in ARRAYS.items()]
    return out.select("episode_id", "timestamp_ns", F.transform("parts.chain_index", lambda x: x.cast("long")).alias("observation.chain_index"), *arrays, "camera_frame_id", "tactile_event")


def unnest(frames: DataFrame) -> DataFrame:
    """Rows of a frame dataset; a missing chain array counts joints by position."""
    chains = F.coalesce(F.col("`observation.chain_index`"), F.transform(F.col("`observation.state`"), lambda _, i: i.cast("long")))
    zipped = F.arrays_zip(chains.alias("chain_index"), *[F.col(f"`{name}`").alias(c) for name, c in ARRAYS.items()])
    out = frames.select("episode_id", "timestamp_ns", "camera_frame_id", "tactile_event", F.posexplode(zipped).alias("pos", "p"))
    return out.select("episode_id", "timestamp_ns", "pos", F.col("p.chain_index").alias("chain_index"), *[F.col(f"p.{c}").alias(c) for c in ARRAYS.values()], "camera_frame_id", "tactile_event")


def dense_index(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """``frames`` with ``episode_index, frame_index, index``, all from 0 without gaps.

    ``episodes``: ``episode_id`` and ``order`` of the episodes exported.  The index over all frames is the frame's index
    in its episode after the frames of earlier episodes, so no global sort is needed; only the counts of episodes are
    summed in order.
    """
    per = running(frames.groupBy("episode_id").agg(F.count("*").alias("n")).join(episodes, "episode_id"), ["order"], {"before": F.col("n")})
    per = per.select("episode_id", F.col("number").alias("episode_index"), "before")
    inside = Window.partitionBy("episode_id").orderBy("timestamp_ns")
    out = frames.join(per, "episode_id").withColumn("frame_index", (F.row_number().over(inside) - 1).cast("long"))
    return out.withColumn("index", F.col("before") + F.col("frame_index")).drop("before")


def task_index(episodes: DataFrame) -> DataFrame:
    """``episode_id, task_index``: tasks numbered by first appearance (``order``); null and empty tasks are -1."""
    named = episodes.where("task_label is not null and task_label <> ''")
    tasks = named.groupBy("task_label").agg(F.min("order").alias("first"))
    tasks = running(tasks, ["first"], {}).select("task_label", F.col("number").alias("task_index"))
    return episodes.join(tasks, "task_label", "left").select("episode_id", F.coalesce("task_index", F.lit(-1)).cast("long").alias("task_index"))


def infer_timing(stats: DataFrame) -> DataFrame:
    """``fps, max_jitter_ns`` of a dataset from statistics over distinct instants: the upper median of the episodes'
    rates, rounded to six places, and the largest jitter; 0.0 and null where no episode has a rate."""
    rates = stats.where("n_samples >= 2 and period_ns > 0").select(F.bround(F.lit(1e9) / F.col("period_ns"), 6).alias("fps"), "max_jitter_ns")
    counted = rates.groupBy("fps").agg(F.count("*").alias("times"), F.max("max_jitter_ns").alias("jitter"))
    counted = running(counted, ["fps"], {"before": F.col("times")}).withColumn("upto", F.col("before") + F.col("times"))
    n = counted.agg(F.sum("times").alias("n"))
    half = counted.join(F.broadcast(n)).where(F.col("upto") >= F.floor(F.col("n") / 2) + 1)  # n is one row
    return counted.agg(F.max("jitter").alias("max_jitter_ns")).join(half.agg(F.coalesce(F.min("fps"), F.lit(0.0)).alias("fps"))).select("fps", "max_jitter_ns")


def differences(a: DataFrame, b: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Rows in which two sets of samples differ, position by position within an episode in order of time and chain.

    Ids, chains, stamps and tasks must be equal, the floats within ``tolerance``; frame ids and tokens are not compared.
    Rows of one time, chain and angle stand in order of arrival (``seq``) if both sets have it, else in order of what is
    compared; a position is that of one row, whatever the partitioning.
    """
    arrival = ["seq"] if "seq" in a.columns and "seq" in b.columns else ["task_label", *[c for c in ARRAYS.values() if c != "joint_angle"]]
    order = Window.partitionBy("episode_id").orderBy("timestamp_ns", "chain_index", "joint_angle", *arrival)
    put = lambda df: df.withColumn("row", F.row_number().over(order))
    x, y = put(a).alias("x"), put(b).alias("y")
    same = F.col("x.timestamp_ns").eqNullSafe(F.col("y.timestamp_ns")) & F.col("x.chain_index").eqNullSafe(F.col("y.chain_index")) & F.col("x.task_label").eqNullSafe(F.col("y.task_label"))
    for c in ARRAYS.values():
        same = same & F.coalesce(F.abs(F.col(f"x.{c}") - F.col(f"y.{c}")) <= tolerance, F.lit(False))
    joined = x.join(y, (F.col("x.episode_id") == F.col("y.episode_id")) & (F.col("x.row") == F.col("y.row")), "full_outer")
    return joined.where(~F.coalesce(same, F.lit(False))).select(F.coalesce("x.episode_id", "y.episode_id").alias("episode_id"), F.coalesce("x.row", "y.row").alias("row"))
