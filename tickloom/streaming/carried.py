"""Streams of which one key may hold most rows: what a key carries from batch to batch is a row.

A batch is a table.  The state of its keys is put before its rows as rows of their own (the largest stamp so far, a reading
that holds the trigger, the last value and the impact that fired last), and the batch operators run over both, with an
episode spread over many tasks.  So no task holds the rows of a key, and stream and batch have one set of operators.

Every batch writes its results and the states that it changed, each in a folder of its own below ``folder``, which all
executors share; every ``FULL_EVERY`` batches the states of all keys are written.  A batch reads only states of earlier
batches, so a batch that is repeated after a failure replaces itself.  ``seq`` grows from batch to batch for each key and is
above ``FIRST + 2``; within a batch rows come in any order.  A null key is a key like others; an empty batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators import events, timeline
from tickloom.operators.segmented import attach

#: ``seq`` of the first row that stands for a state, and how often all states are written.
FIRST, FULL_EVERY = -(1 << 63), 16
AT = "__batch"


def _latest(states: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in states.columns if c not in keys]
    return states.groupBy(*keys).agg(F.max_by(F.struct(*rest), AT).alias("__s")).select(*keys, "__s.*")


def known_states(batch: DataFrame, folder: str, keys: list[str], schema: str, number: int) -> DataFrame:
    """The states of all keys before batch ``number``, with the batch ``AT`` that each is of."""
    spark, whole = batch.sparkSession, f"{schema}, {AT} long"
    if number == 0:
        return spark.createDataFrame([], whole)
    since = (number - 1) // FULL_EVERY * FULL_EVERY
    return _latest(spark.read.schema(whole).parquet(*[f"{folder}/states/batch={k}" for k in range(since, number)]), keys)


def _run(stream: DataFrame, folder: str, keys: list[str], schema: str, find: Callable, carry: Callable) -> DataFrame:
    """What the batches of the stream found, once its source has no more.

    ``find(batch, states)`` gives a batch's results, ``carry(batch, results, states)`` the states of its keys after it;
    ``states`` has the keys of the batch only.
    """

    def each(batch: DataFrame, number: int) -> None:
        rows = f"{folder}/rows/batch={number}"
        known = known_states(batch, folder, keys, schema, number)
        here = attach(known, batch.select(*keys).distinct().withColumn("__here", F.lit(True)), keys).where("__here").drop("__here", AT)
        found = find(batch, here)
        found.write.mode("overwrite").parquet(rows)
        after = carry(batch, batch.sparkSession.read.schema(found.schema).parquet(rows), here).withColumn(AT, F.lit(number).cast("long"))
        if number % FULL_EVERY == 0:
            after = _latest(known.unionByName(after), keys)
        after.write.mode("overwrite").parquet(f"{folder}/states/batch={number}")

    none = stream.sparkSession.createDataFrame([], stream.schema)
    empty = find(none, stream.sparkSession.createDataFrame([], schema)).limit(0)
    stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
    empty.write.mode("overwrite").parquet(f"{folder}/rows/batch=-1")
    return stream.sparkSession.read.schema(empty.schema).parquet(f"{folder}/rows").select(*empty.columns)


def normalize(stamps: DataFrame, folder: str, domain: str = "monotonic", offset_ns: int | None = None) -> DataFrame:
    """``episode_id, seq, timestamp_ns, flags, skew_ns, normalized_ns`` of a stream of stamps, as ``timeline.normalize`` gives
    them for the whole of it."""
    stamps = stamps.select("episode_id", "seq", "timestamp_ns")

    def find(batch, states):
        before = states.select("episode_id", F.lit(FIRST).alias("seq"), F.col("top").alias("timestamp_ns"))
        return timeline.normalize(batch.unionByName(before), domain, offset_ns, long=True).where(F.col("seq") > FIRST)

    def carry(batch, found, states):
        tops = batch.select("episode_id", F.col("timestamp_ns").alias("top")).unionByName(states)
        return tops.groupBy("episode_id").agg(F.max("top").alias("top"))

    kind = stamps.schema["episode_id"].dataType.simpleString()
    return _run(stamps, folder, ["episode_id"], f"episode_id {kind}, top long", find, carry)


def contacts(readings: DataFrame, folder: str, onset: float, release: float) -> DataFrame:
    """``episode_id, seq, t_ns, kind, level`` of the events of a stream of readings (``episode_id, seq, timestamp_ns, level``),
    as ``events.detect_contact`` finds them in the whole of it; ``onset`` is finite."""
    readings = readings.select("episode_id", "seq", "timestamp_ns", F.col("level").cast("double").alias("level"))

    def find(batch, states):
        # A reading above every release holds the trigger.
        held = states.where("held").select("episode_id", F.lit(FIRST).alias("seq"), F.lit(0).cast("long").alias("timestamp_ns"), F.lit(float("inf")).alias("level"))
        return events.detect_contact(batch.unionByName(held), F.col("level"), onset, release, long=True).where(F.col("seq") > FIRST)

    def carry(batch, found, states):
        turned = found.groupBy("episode_id").agg((F.max_by("kind", "seq") == "contact_start").alias("held"))
        return turned.withColumn("new", F.lit(True)).unionByName(states.withColumn("new", F.lit(False))).groupBy("episode_id").agg(F.max_by("held", "new").alias("held"))

    kind = readings.schema["episode_id"].dataType.simpleString()
    return _run(readings, folder, ["episode_id"], f"episode_id {kind}, held boolean", find, carry)


def impacts(samples: DataFrame, folder: str, jerk: float, refractory_ns: int = 0) -> DataFrame:
    """``episode_id, chain_index, seq, t_ns, kind, delta`` of the impacts of a stream of values (``episode_id, chain_index, seq,
    timestamp_ns, value``), as ``events.detect_impact`` finds them in the whole of it."""
    keys = ["episode_id", "chain_index"]
    samples = samples.select(*keys, "seq", "timestamp_ns", F.col("value").cast("double").alias("value"))

    def find(batch, states):
        # Two rows that make the impact that fired last fire again, and the last value, too early to fire itself.
        fired = F.when(F.col("fired").isNotNull() & F.lit(refractory_ns > 0), F.array(_row(0, "fired", F.lit(0.0)), _row(1, "fired", F.lit(float(jerk)))))
        rows = F.concat(F.coalesce(fired, F.array().cast("array<struct<seq:bigint,timestamp_ns:bigint,value:double>>")), F.array(_row(2, "fired", F.col("value"))))
        before = states.select(*keys, F.inline(rows))
        return events.detect_impact(batch.unionByName(before), "value", jerk, refractory_ns, long=True).where(F.col("seq") > FIRST + 2)

    def carry(batch, found, states):
        last = batch.select(*keys, "seq", "value", F.lit(None).cast("long").alias("fired"))
        hits = found.select(*keys, F.lit(None).cast("long").alias("seq"), F.lit(None).cast("double").alias("value"), F.col("t_ns").alias("fired"))
        rows = last.unionByName(hits).unionByName(states.select(*keys, F.lit(FIRST).alias("seq"), "value", "fired"))
        return rows.groupBy(*keys).agg(F.max(F.when(F.col("seq").isNotNull(), F.struct("seq", "value"))).alias("l"), F.max("fired").alias("fired")).select(*keys, F.col("l.value").alias("value"), "fired")

    kind = samples.schema["episode_id"].dataType.simpleString()
    chain = samples.schema["chain_index"].dataType.simpleString()
    return _run(samples, folder, keys, f"episode_id {kind}, chain_index {chain}, value double, fired long", find, carry)


def _row(k: int, stamp: str, value: Column) -> Column:
    return F.struct(F.lit(FIRST + k).alias("seq"), F.col(stamp).alias("timestamp_ns"), value.alias("value"))
