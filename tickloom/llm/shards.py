"""Search layout that exact and approximate search share.

Index rows are dealt to shards by hash, so that a shard has about ``per_shard`` rows whatever the size of the index, and
queries to blocks; blocks form groups.  Every group meets every shard once, by equality on (shard, group), in a task
that holds one shard and the blocks of one group: the work of a task is bounded, and there are as many tasks as shards
times groups.  Shards and blocks travel as one array each, sorted, so that results do not depend on the order of arrival.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tasks of a search that are aimed at, on a cluster of fewer cores, and allowed; blocks of a group at most.
TASKS, MOST_TASKS, BLOCKS = 8, 4096, 32


def rank_least(df: DataFrame, key: str, value: str, n: int, salts: int = 32) -> DataFrame:
    """``key, least``: the ``n`` least ``value`` of every key, in order.

    Two steps, so that a key with a large part of all rows is split: the least of each salted group, then of those.
    """
    from pyspark.sql import Window

    salted = df.select(key, value).withColumn("__salt", F.pmod(F.xxhash64(value), F.lit(salts)))
    some = salted.withColumn("__n", F.row_number().over(Window.partitionBy(key, "__salt").orderBy(value))).where(F.col("__n") <= n)
    return some.groupBy(key).agg(F.slice(F.array_sort(F.collect_list(value)), 1, n).alias("least"))


def number_of_shards(rows: int, per_shard: int) -> int:
    return max(1, -(-rows // per_shard))


def number_of_groups(shards: int, blocks: int, cores: int = TASKS) -> int:
    """As many groups as give every core a task, ``TASKS`` at least, if there are blocks for them, and at most ``BLOCKS``
    blocks in a group."""
    return max(-(-blocks // BLOCKS), min(blocks, -(-max(TASKS, cores) // shards)))


def meet(index: DataFrame, queries: DataFrame, shards: int, blocks: int, index_row: Column, query_row: Column, index_hash: Column, query_hash: Column, search: Callable[[pa.Array, list[pa.Array]], Iterator[pa.RecordBatch]], schema: str, columns: pa.Schema) -> DataFrame:
    """What ``search`` finds for every shard's rows and every group's blocks, given as arrays of structs.

    ``schema`` and ``columns`` describe the result.
    """
    groups = number_of_groups(shards, blocks, index.sparkSession.sparkContext.defaultParallelism)
    points = index.groupBy(F.pmod(index_hash, F.lit(shards)).cast("int").alias("shard")).agg(F.array_sort(F.collect_list(index_row)).alias("points")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = queries.groupBy(F.pmod(query_hash, F.lit(blocks)).cast("int").alias("block")).agg(F.array_sort(F.collect_list(query_row)).alias("asked")).withColumn("group", F.pmod("block", F.lit(groups))).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    tasks = min(shards * groups, MOST_TASKS)
    left, right = (x.repartition(tasks, "shard", "group").groupBy("shard", "group") for x in (points.select("shard", "group", "points"), asked.select("shard", "group", "asked")))

    def run(points: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if points.num_rows and asked.num_rows:
            found = list(search(points.column("points")[0].values, [x.values for x in asked.column("asked")]))
        return pa.Table.from_batches(found, columns)

    return left.cogroup(right).applyInArrow(run, schema)
