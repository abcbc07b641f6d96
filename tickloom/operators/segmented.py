"""Scans over episodes of any length: running values without an episode in one task.

Rows are dealt by ranges of episode and order.  Each range is scanned on its own, and is summed up as one row for each
episode in it: its largest stamp, its last and next stamps, or what it makes of a trigger's state.  Summaries are carried
from range to range, a table of as many rows as there are ranges and episodes, and joined to the rows of each range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import cut_lineage

RANGE = "__range"


def dealt(df: DataFrame, by: list[str], order: list[str], n: int | None = None) -> DataFrame:
    """``df`` with the number of the range of ``by`` and ``order`` that a row lies in; rows that are equal in these lie in one
    range.  Written once, so that every use sees the same ranges; ``n`` of them (default: as many as shuffles have)."""
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(n, *by, *order).withColumn(RANGE, F.spark_partition_id()))


def attach(rows: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the further columns of ``carried``, which has one row for each value of ``keys``; nulls are equal."""
    right = carried.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[c for c in carried.columns if c not in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    return rows.join(right, same, "left").drop(*[f"__k{i}" for i in range(len(keys))])


def _earlier(by: list[str]):
    return Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)


def _later(by: list[str]):
    return Window.partitionBy(*by).orderBy(F.desc(RANGE)).rowsBetween(Window.unboundedPreceding, -1)


def running_max_before(df: DataFrame, by: list[str], order: str, value: str, name: str) -> DataFrame:
    """``df`` with the largest ``value`` of the rows before in ``order``; null for the first."""
    rows = dealt(df, by, [order])
    tops = rows.groupBy(*by, RANGE).agg(F.max(value).alias("__top"))
    carried = tops.select(*by, RANGE, F.max("__top").over(_earlier(by)).alias("__carried"))
    inside = Window.partitionBy(*by, RANGE).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = attach(rows, carried, [*by, RANGE])
    return out.withColumn(name, F.greatest(F.max(value).over(inside), F.col("__carried"))).drop("__carried", RANGE)


def value_before(df: DataFrame, by: list[str], order: str, value: str, name: str) -> DataFrame:
    """``df`` with the ``value`` of the row before in ``order``, null values included; null for the first."""
    rows = dealt(df, by, [order])
    ends = rows.groupBy(*by, RANGE).agg(F.max_by(F.struct(F.col(value).alias("v")), order).alias("__end"))
    carried = ends.select(*by, RANGE, F.lag("__end").over(Window.partitionBy(*by).orderBy(RANGE)).alias("__carried"))
    inside = Window.partitionBy(*by, RANGE).orderBy(order)
    out = attach(rows, carried, [*by, RANGE])
    return out.withColumn(name, F.when(F.row_number().over(inside) == 1, F.col("__carried.v")).otherwise(F.lag(value).over(inside))).drop("__carried", RANGE)


def last_and_next(df: DataFrame, by: list[str], order: str, values: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``df`` with ``back_<name>`` and ``ahead_<name>`` for each of ``values``: the largest of its first column at or before a
    row in ``order``, and the least of its second at or after it; rows at one place see each other.

    The columns are null on rows that are no value; they must grow with ``order`` (a stamp, or a struct that begins with
    one).  What lies ahead is read backwards: a frame that ends with the last row is computed anew for every row.
    """
    given = {f"__{k}{i}": c for k, pair in values.items() for i, c in enumerate(pair)}
    rows = dealt(df.withColumns(given), by, [order])
    ends = rows.groupBy(*by, RANGE).agg(*[x for k in values for x in (F.max(f"__{k}0").alias(f"__high_{k}"), F.min(f"__{k}1").alias(f"__low_{k}"))])
    carried = ends.select(*by, RANGE, *[x for k in values for x in (F.max(f"__high_{k}").over(_earlier(by)).alias(f"__before_{k}"), F.min(f"__low_{k}").over(_later(by)).alias(f"__after_{k}"))])
    inside = Window.partitionBy(*by, RANGE)
    upto, onward = (inside.orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in (F.asc(order), F.desc(order)))
    out, seen = attach(rows, carried, [*by, RANGE]), {}
    for k in values:
        seen[f"back_{k}"] = F.coalesce(F.max(f"__{k}0").over(upto), f"__before_{k}")
        seen[f"ahead_{k}"] = F.coalesce(F.min(f"__{k}1").over(onward), f"__after_{k}")
    return out.withColumns(seen).drop(*given, *[f"__{x}_{k}" for k in values for x in ("before", "after")], RANGE)


def trigger_states(coded: DataFrame, by: list[str], order: str, code: str) -> DataFrame:
    """``coded`` with ``state`` after a row and ``was`` before it, 0 at first.

    Codes 0 and 1 set the state, 2 turns it over.  What a range makes of a state is either a value, if it sets one, or the
    number of its turns.
    """
    rows = dealt(coded, by, [order])
    upto = Window.partitionBy(*by, RANGE).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__set", F.last(F.when(F.col(code) < 2, F.col(code)), True).over(upto)).withColumn("__span", F.count(F.when(F.col(code) < 2, 1)).over(upto))
    since = Window.partitionBy(*by, RANGE, "__span").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__turns", F.count(F.when(F.col(code) == 2, 1)).over(since))
    maps = rows.groupBy(*by, RANGE).agg(F.max_by(F.struct("__set", "__turns"), order).alias("m")).select(*by, RANGE, "m.*")
    over = Window.partitionBy(*by).orderBy(RANGE)
    known = over.rowsBetween(Window.unboundedPreceding, 0)
    maps = maps.withColumn("__run", F.count("__set").over(known)).withColumn("__last", F.coalesce(F.last("__set", True).over(known), F.lit(0)))
    in_run = Window.partitionBy(*by, "__run").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, 0)
    maps = maps.withColumn("__end", (F.col("__last") + F.sum("__turns").over(in_run)) % 2)
    carried = maps.select(*by, RANGE, F.coalesce(F.lag("__end").over(over), F.lit(0)).alias("__carried"))
    out = attach(rows, carried, [*by, RANGE]).withColumn("state", (F.coalesce("__set", "__carried") + F.col("__turns")) % 2)
    inside = Window.partitionBy(*by, RANGE).orderBy(order)
    return out.withColumn("was", F.coalesce(F.lag("state").over(inside), "__carried")).drop("__set", "__span", "__turns", "__carried", RANGE)
