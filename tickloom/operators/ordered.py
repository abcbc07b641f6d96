"""Numbers and running totals over a whole table, without a sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import cut_lineage


def running(df: DataFrame, order: list[str], totals: dict[str, Column]) -> DataFrame:
    """``df`` with ``number``, the row's place from 0 in ``order``, and for each of ``totals`` the sum over the rows before.

    Rows are dealt by ranges of ``order`` and totalled within each range; only one row for each range is summed over all
    ranges.  Rows that are equal in ``order`` lie in one range.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = df.withColumns({f"__{k}": c for k, c in totals.items()}).repartitionByRange(n, *order)
    dealt = cut_lineage(marked.withColumn("__range", F.spark_partition_id()))
    sums = {"number": F.lit(1).cast("long")} | {k: F.col(f"__{k}") for k in totals}
    ranges = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = dealt.groupBy("__range").agg(*[F.sum(c).alias(f"__all_{k}") for k, c in sums.items()])
    earlier = whole.select("__range", *[F.coalesce(F.sum(f"__all_{k}").over(ranges), F.lit(0)).alias(f"__from_{k}") for k in sums])
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.withColumns({f"__in_{k}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for k, c in sums.items()}).join(earlier, "__range")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[(F.col(f"__from_{k}") + F.col(f"__in_{k}")).alias(k) for k in sums])
