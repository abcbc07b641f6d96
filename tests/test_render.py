from pyspark.sql import functions as F

from tickloom.functions import render


def test_pod_lines_are_padded_and_never_cut(spark):
    rows = [(3, 1, 22500), (99, 10, -5), (100, 0, 1234567), (255, 255, -30_000_000), (254, 100, 2_000_000_000)]
    f = spark.createDataFrame(rows, "node int, chain int, deg int")
    got = f.select(render.pod_line(F.col("node"), F.col("chain"), F.col("deg"), F.lit(0.0), F.lit(0), F.lit(True)).alias("x")).collect()
    assert [r["x"].split("  [")[0] for r in got] == [f"pod {n:>2}:{c:<2} {d / 1000.0:+8.2f} deg" for n, c, d in rows]


def test_screens_are_in_order_of_chain_and_node(spark):
    rows = [(3, 1), (1, 2), (2, 1)]
    f = spark.createDataFrame(rows, "node_id int, chain_index int").selectExpr("*", "0 as millideg", "0.0D as angle_rad", "0 as status_flags", "true as valid")
    assert [x[:8] for x in render.display(f)] == ["pod  2:1", "pod  3:1", "pod  1:2"]
