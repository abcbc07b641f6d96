"""Streams with state: normalisation, detectors, latest rows.

Late rows are data here: they are flagged, never dropped, so no watermark is used.  Each key's state is a few numbers.
Rows of a key must reach a batch in order of ``seq``; within a batch they are sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.codec import is_finite

#: State stores that these operators need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class HighWater(StatefulProcessor):
    """Flags stamps that are not above all earlier ones of their stream."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getValueState("top", "top long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        top = self.top.get()[0] if self.top.exists() else None
        df = pd.concat(list(rows)).sort_values("seq")
        flags = []
        for t in df["timestamp_ns"]:
            late = top is not None and t <= top
            flags.append("backwards_in_source" if late else "")
            top = t if top is None else max(top, t)
        self.top.update((int(top),))
        yield pd.DataFrame({"episode_id": key[0], "seq": df["seq"], "timestamp_ns": df["timestamp_ns"], "flags": flags})

    def close(self) -> None:
        pass


class Contact(StatefulProcessor):
    """A Schmitt trigger; the state is whether the episode is in contact."""

    onset, release = 0.5, 0.5

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "held int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        held = self.held.get()[0] if self.held.exists() else 0
        df = pd.concat(list(rows)).sort_values("seq")
        out = []
        for s, t, x in zip(df["seq"], df["timestamp_ns"], df["level"], strict=True):
            if x is None or x != x:
                continue
            if not held and x >= self.onset:
                held = 1
                out.append((key[0], s, t, "contact_start"))
            elif held and x <= self.release:
                held = 0
                out.append((key[0], s, t, "contact_release"))
        self.held.update((held,))
        yield pd.DataFrame(out, columns=["episode_id", "seq", "t_ns", "kind"])

    def close(self) -> None:
        pass


class Impact(StatefulProcessor):
    """Jumps between successive values of a chain, with a refractory time after one that fired."""

    jerk, refractory_ns = 1.0, 0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "value double, fired long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        value, fired = self.last.get() if self.last.exists() else (None, None)
        df = pd.concat(list(rows)).sort_values("seq")
        out = []
        for s, t, x in zip(df["seq"], df["timestamp_ns"], df["value"], strict=True):
            if value is not None and abs(x - value) >= self.jerk and abs(x - value) != float("inf") and (self.refractory_ns <= 0 or fired is None or t - fired >= self.refractory_ns):
                fired = int(t)
                out.append((key[0], key[1], s, t, abs(x - value)))
            value = float(x)
        self.last.update((value, fired))
        yield pd.DataFrame(out, columns=["episode_id", "chain_index", "seq", "t_ns", "delta"])

    def close(self) -> None:
        pass


def _run(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str) -> DataFrame:
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return df.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "None")


def normalize(stamps: DataFrame) -> DataFrame:
    """``episode_id, seq, timestamp_ns, flags`` of a stream of stamps."""
    return _run(stamps.select("episode_id", "seq", "timestamp_ns"), ["episode_id"], HighWater(), "episode_id long, seq long, timestamp_ns long, flags string")


def contacts(readings: DataFrame, onset: float, release: float) -> DataFrame:
    """Contact events of a stream of readings (``episode_id, seq, timestamp_ns, level``); ``release < onset``."""
    p = Contact()
    p.onset, p.release = onset, release
    return _run(readings, ["episode_id"], p, "episode_id long, seq long, t_ns long, kind string")


def impacts(samples: DataFrame, jerk: float, refractory_ns: int = 0) -> DataFrame:
    """Impacts of a stream of values (``episode_id, chain_index, seq, timestamp_ns, value``)."""
    p = Impact()
    p.jerk, p.refractory_ns = jerk, refractory_ns
    return _run(samples, ["episode_id", "chain_index"], p, "episode_id long, chain_index int, seq long, t_ns long, delta double")


def latest(samples: DataFrame, keys: list[str]) -> DataFrame:
    """The last row of each key, for ``complete`` or ``update`` output."""
    rest = [c for c in samples.columns if c not in keys and c != "seq"]
    return samples.groupBy(*keys).agg(F.max(F.struct("seq", *rest)).alias("l")).select(*keys, "l.*")


def latest_available(samples: DataFrame, keys: list[str], folder: str) -> DataFrame:
    """The last row of each key of what a stream has now, for any number of keys.

    Every batch writes the keys that it changed below ``folder``, a folder that all executors share, in a folder of its own,
    so a repeated batch replaces itself; of a key's rows the last one counts.
    """
    spark, newest = samples.sparkSession, latest(samples, keys)

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    each(spark.createDataFrame([], newest.schema), -1)
    newest.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return latest(spark.read.schema(newest.schema).parquet(f"{folder}/rows"), keys).select(*newest.columns)


def collect_available(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Everything that the stream's source has now, as a table; bounded reading of an unbounded source."""
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def collect_finite(samples: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Like ``collect_available``, without rows whose angle is not finite."""
    return collect_available(samples.where(is_finite(F.col("joint_angle"))), name, checkpoint)


def run_available(df: DataFrame, folder: str) -> DataFrame:
    """Like ``collect_available`` for any amount of rows: they are written as Parquet below ``folder``, a folder that
    all executors share, and read from there."""
    q = df.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")


def record_batches(samples: DataFrame, folder: str, checkpoint: str, budget=None):
    """A running query that sends every batch of closed episodes through the recorder's gate: accepted ones are written,
    others are quarantined, each batch in a folder of its own, so a repeated batch replaces itself."""
    from tickloom.sources import episodes

    def each(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            episodes.record(batch, f"{folder}/batch={number}", budget, mode="overwrite")

    return samples.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
