"""Whole episodes out of a stream of samples.

A recorder says when an episode ends; until then its rows may come in any number of batches.  They wait in a list state,
kept by the state store on disk, and are handed on together in the batch that has the end mark.  An episode that goes quiet
for too long is handed on by a timer, as one that did not end.  Rows that come after the end belong to no episode any more;
they are handed on as such and never lost in silence.

``record_closed`` sends whole episodes through the recorder's gate: each batch is one commit, repeated batches change
nothing, and readers see finished commits only.

``record_ended`` does the same without a timer, for recordings whose episodes are many, or long: a batch is a table, open
episodes wait as rows of a table, and no Python process, and no task, handles an episode on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators import quality
from tickloom.operators.segmented import attach
from tickloom.sources import commits
from tickloom.streaming.stateful import ROCKSDB

#: Why rows are handed on (fixed values of this module).
ENDED, QUIET, LATE = "ended", "not_ended", "after_end"
#: The ``closing`` of rows whose episode is open, in the tables of ``record_ended``.
OPEN = "open"
#: Rows that are taken out of the state at once.
CHUNK = 5_000
#: Micro-seconds of times are kept in the text form of a row.
_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


class Episode(StatefulProcessor):
    """The rows of an open episode, whether it was closed, and the timer that runs since its last row."""

    quiet_ms: int | None = None
    remember_ms: int | None = None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "row string")
        self.closed = handle.getValueState("closed", "why string", self.remember_ms)
        self.alarm = handle.getValueState("alarm", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        late, ends = self.closed.exists(), False
        for some in rows:
            texts = [x for x in some["row"] if x is not None]
            ends = ends or bool(some["ends"].any())
            if late:
                yield self._out(key, texts, LATE)
            elif texts:
                self.rows.appendList([(x,) for x in texts])
        if late:
            return
        if ends:
            yield from self._close(key, ENDED)
        elif self.quiet_ms is not None:
            self._forget_alarm()
            at = timers.getCurrentProcessingTimeInMs() + self.quiet_ms
            self.handle.registerTimer(at)
            self.alarm.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.closed.exists():
            yield from self._close(key, QUIET)

    def _forget_alarm(self) -> None:
        if self.alarm.exists():
            self.handle.deleteTimer(self.alarm.get()[0])
            self.alarm.clear()

    def _close(self, key, why: str) -> Iterator[pd.DataFrame]:
        self._forget_alarm()
        some: list[str] = []
        for (row,) in self.rows.get() if self.rows.exists() else ():
            some.append(row)
            if len(some) == CHUNK:
                yield self._out(key, some, why)
                some = []
        if some:
            yield self._out(key, some, why)
        self.rows.clear()
        self.closed.update((why,))

    @staticmethod
    def _out(key, texts: list[str], why: str) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]] * len(texts), "row": texts, "closing": [why] * len(texts)}, dtype=object)

    def close(self) -> None:
        pass


def closed_episodes(rows: DataFrame, quiet_ms: int | None = None, remember_ms: int | None = None, ends: str = "ends", mark_only: str = "timestamp_ns") -> DataFrame:
    """The columns of ``rows``, a stream, but for ``ends``, with ``closing``: the rows of every episode that has ended, all
    in one batch, as ``ended``; those of an episode that was quiet for ``quiet_ms`` as ``not_ended``; and rows that come
    in a later batch than an episode's end as ``after_end``.

    A row whose boolean ``ends`` is true ends its ``episode_id``, wherever it stands in its batch; if its ``mark_only`` is
    null it is nothing but the mark.  Rows without an episode are those of one episode.  That an episode is closed is
    remembered for ``remember_ms`` (default: for good, a few bytes for each episode).
    """
    processor = Episode()
    processor.quiet_ms, processor.remember_ms = quiet_ms, remember_ms
    columns = [c for c in rows.columns if c != ends]
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    whole = F.when(F.col(mark_only).isNotNull() | ~F.coalesce(ends, F.lit(False)), F.to_json(F.struct(*columns), _TEXT))
    packed = rows.select(F.coalesce(F.col("episode_id").cast("string"), F.lit("")).alias("key"), F.coalesce(ends, F.lit(False)).alias("ends"), whole.alias("row"))
    out = packed.groupBy("key").transformWithStateInPandas(processor, "key string, row string, closing string", "Append", "ProcessingTime")
    return out.select(F.from_json("row", rows.select(*columns).schema, _TEXT).alias("r"), "closing").select("r.*", "closing")


def commit_closed(batch: DataFrame, name: str, folder: str, budget: quality.JitterBudget | None = None, kept: bool = False) -> None:
    """One batch of ``closed_episodes`` as one commit: accepted episodes in ``data``, verdicts of the others in
    ``quarantine`` and rows of episodes that were not ended, or came after the end, in ``stray``.

    Nothing is written for a batch that is committed already, or that closes nothing.  A batch that is ``kept`` as a table is
    read from there each time.
    """
    spark = batch.sparkSession
    if commits.finished(spark, folder, name):
        return
    batch = batch if kept else batch.persist()
    try:
        if batch.isEmpty():
            return
        ended = batch.where(F.col("closing") == ENDED).drop("closing")
        finite = ended.where(quality.is_finite(F.col("joint_angle")))
        verdicts = quality.recorder_gate(finite, budget).select("episode_id", "ok", "reasons")
        empty = ended.select("episode_id").distinct().join(verdicts, "episode_id", "left_anti").select("episode_id", F.lit(False).alias("ok"), F.array(F.lit("too_few_samples:0")).alias("reasons"))
        verdicts = verdicts.unionByName(empty).persist()
        with commits.commit(spark, folder, name) as c:
            c.write("data", finite.join(verdicts.where("ok").select("episode_id"), "episode_id", "left_semi"))
            c.write("quarantine", verdicts.where("not ok"), "json")
            c.write("stray", batch.where(F.col("closing") != ENDED))
        verdicts.unpersist()
    finally:
        if not kept:
            batch.unpersist()


def record_closed(closed: DataFrame, folder: str, checkpoint: str, budget: quality.JitterBudget | None = None, every: str | None = None):
    """A running query that commits every batch of a stream of closed episodes (``closed_episodes``) below ``folder``.

    With ``every`` ("30 seconds", say) it runs on, and quiet episodes are found whether or not others have rows.  Without,
    it ends when all rows that are there have been read; timers that have run out fire with the next rows.
    """

    def each(batch: DataFrame, number: int) -> None:
        commit_closed(batch, f"batch-{number:012d}", folder, budget)

    writer = closed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if every is not None:
        return writer.trigger(processingTime=every).start()
    # Batches without rows, which timers call for again and again, would keep a bounded read from ending.
    with bounded(closed.sparkSession):
        return writer.trigger(availableNow=True).start()


def record_ended(rows: DataFrame, folder: str, checkpoint: str, budget: quality.JitterBudget | None = None, ends: str = "ends", mark_only: str = "timestamp_ns"):
    """A running query that commits, as ``record_closed``, the episodes of ``rows``, a stream, that have ended; it ends when all
    rows that are there have been read.

    ``ends`` and ``mark_only`` as in ``closed_episodes``; no episode is given up for being quiet.  Every batch reads the rows
    of open episodes and writes those that stay open, below ``checkpoint``: cheap where batches are few and large.  A
    batch reads only what earlier ones wrote, so one that is repeated replaces itself; the tables of a batch stay until
    that folder is cleared.
    """
    columns = [c for c in rows.columns if c != ends]
    waiting, ended = f"{checkpoint}/waiting", f"{checkpoint}/ended"

    def each(batch: DataFrame, number: int) -> None:
        spark, name = batch.sparkSession, f"batch-{number:012d}"
        mark = F.coalesce(ends, F.lit(False))
        batch.where(mark).select("episode_id").distinct().write.mode("overwrite").parquet(f"{ended}/batch={number}")
        known = spark.read.schema(batch.select("episode_id").schema.add("batch", "long")).parquet(ended).where(F.col("batch") <= number)
        known = known.groupBy("episode_id").agg(F.min("batch").alias("__closed"))
        fresh = batch.where(F.col(mark_only).isNotNull() | ~mark).select(*columns)
        before = spark.read.schema(batch.select(*columns).schema.add("closing", "string")).parquet(f"{waiting}/batch={number - 1}").where(F.col("closing") == OPEN).select(*columns) if number else fresh.limit(0)
        closed = F.col("__closed")
        closing = F.when(closed.isNull(), OPEN).when(closed == number, ENDED).otherwise(LATE)
        marked = attach(before.unionByName(fresh), known, ["episode_id"]).withColumn("closing", closing).drop("__closed")
        place = f"{waiting}/batch={number}"
        marked.write.mode("overwrite").partitionBy("closing").parquet(place)
        done = spark.read.schema(marked.select(*columns, "closing").schema).parquet(place).where(F.col("closing") != OPEN)
        commit_closed(done, name, folder, budget, kept=True)

    with bounded(rows.sparkSession):
        return rows.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint}/log").trigger(availableNow=True).start()


@contextmanager
def bounded(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside make no batches without rows."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)
