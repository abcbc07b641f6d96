"""Whether what is written into a dataset comes back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import bench, quality
from tickloom.schema import FLOATS
from tickloom.session import written
from tickloom.sources import episodes

COMPARED = ["episode_id", "timestamp_ns", "chain_index", *FLOATS]


def same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables have the same rows, whatever their order."""
    return tuple(bench.digest(a).first()) == tuple(bench.digest(b.select(*a.columns)).first())


def round_trips(samples: DataFrame, timing: DataFrame, folder: str, budget: quality.JitterBudget | None = None, export: dict[str, Callable] | None = None, load: dict[str, Callable[[SparkSession, str], DataFrame]] | None = None) -> DataFrame:
    """``kind, episodes, samples_survive, timing_survives`` for the row and the frame dataset of ``samples``.

    Both are written below ``folder`` and read back; the samples of accepted episodes and their timing must be there,
    each as often as before, and nothing else.  ``export`` and ``load`` replace the writers and readers.
    """
    spark, out = samples.sparkSession, []
    samples, timing = written(samples), written(timing)
    writers = {"rows": episodes.export_rows, "frames": episodes.export_frames} | (export or {})
    readers = {"rows": episodes.read_rows, "frames": episodes.read_frames} | (load or {})
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in timing.schema)
    for kind, write in writers.items():
        place = f"{folder}/{kind}"
        gate = write(samples, place, timing, budget)
        accepted = gate.where("ok" if "ok" in gate.columns else "exported").select("episode_id")
        own = samples.where(quality.finite_row()).join(accepted, "episode_id", "left_semi").select(*[F.col(c).cast("long").alias(c) if c == "chain_index" else F.col(c) for c in COMPARED])
        back = readers[kind](spark, place).withColumn("chain_index", F.col("chain_index").cast("long"))
        timed = episodes.read_timing(spark, place, schema)
        out.append((kind, accepted.count(), same(own, back), timed is not None and same(timing.join(accepted, "episode_id", "left_semi"), timed)))
    return spark.createDataFrame(out, "kind string, episodes long, samples_survive boolean, timing_survives boolean")
