"""Robot descriptions (XML) as tables of joints and links, checked and ordered by queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.session import written

#: Kinds of joints, and those that move along one axis (fixed values).
KINDS = ["revolute", "continuous", "prismatic", "fixed", "floating", "planar"]
ACTUATED = ["revolute", "continuous", "prismatic"]
_JOINT = "_name string, _type string, parent struct<_link: string>, child struct<_link: string>, axis struct<_xyz: string>, limit struct<_lower: string, _upper: string>"


def _elements(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).option("mode", "FAILFAST").schema(schema).load(path)


def joints(spark: SparkSession, path: str) -> DataFrame:
    """``name, kind, parent, child, axis, lower, upper`` of every joint of the description.

    ``axis`` is an array of numbers, along x where none is given; text that is no number becomes null and is found by
    ``faults``.
    """
    number = lambda c: F.expr(f"try_cast({c} as double)")
    axis = F.transform(F.split(F.trim("axis._xyz"), r"\s+"), lambda x: x.try_cast("double"))
    return _elements(spark, path, "joint", _JOINT).where("parent is not null or child is not null").select(
        F.col("_name").alias("name"), F.col("_type").alias("kind"), F.col("parent._link").alias("parent"), F.col("child._link").alias("child"), F.coalesce(axis, F.array(*map(F.lit, (1.0, 0.0, 0.0)))).alias("axis"),
        number("limit._lower").alias("lower"), number("limit._upper").alias("upper"),
    )


def links(spark: SparkSession, path: str) -> DataFrame:
    return _elements(spark, path, "link", "_name string").select(F.col("_name").alias("name")).where("name is not null")


def write(joints: DataFrame, links: DataFrame, folder: str) -> None:
    """A description as elements below ``folder/joints`` and ``folder/links``, each in as many files as it has partitions."""
    text = lambda c: F.col(c).cast("string")
    elements = joints.select(
        F.col("name").alias("_name"), F.col("kind").alias("_type"), F.struct(F.col("parent").alias("_link")).alias("parent"), F.struct(F.col("child").alias("_link")).alias("child"),
        F.struct(F.array_join(F.transform("axis", lambda x: x.cast("string")), " ").alias("_xyz")).alias("axis"), F.when(F.col("lower").isNotNull() | F.col("upper").isNotNull(), F.struct(text("lower").alias("_lower"), text("upper").alias("_upper"))).alias("limit"),
    )
    elements.write.format("xml").option("rootTag", "robot").option("rowTag", "joint").save(f"{folder}/joints")
    links.select(F.col("name").alias("_name")).write.format("xml").option("rootTag", "robot").option("rowTag", "link").save(f"{folder}/links")


def depths(joints: DataFrame) -> DataFrame:
    """``joints`` with ``depth``, the number of joints between a joint and the base; null on a circle.

    Every joint knows the joint before it; reach doubles in each round, so n joints in a row take log n rounds.
    """
    before = joints.select(F.col("child").alias("parent"), F.col("name").alias("up"))
    reach = joints.select("name", "parent").join(before, "parent", "left").select("name", "up", F.when(F.col("up").isNull(), 0).otherwise(1).alias("depth"))
    n = joints.count()
    for _ in range(max(n, 1).bit_length() + 1):
        # Every round reads its table twice; written, the plan does not double with it.
        reach = written(reach)
        if reach.where("up is not null").isEmpty():
            break
        ahead = reach.select(F.col("name").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"))
        reach = reach.join(ahead, "up", "left").select("name", F.col("further").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
    return joints.join(reach.select("name", F.when(F.col("up").isNull(), F.col("depth")).alias("depth")), "name")


def faults(joints: DataFrame, links: DataFrame) -> DataFrame:
    """``name, fault`` of everything that keeps a description from being one chain of joints over all links; empty for
    a good one."""
    note = lambda df, fault, name="name": df.select(F.col(name).alias("name"), F.lit(fault).alias("fault"))
    twice = lambda df, key: df.groupBy(key).count().where("count > 1")
    ends = joints.select(F.explode(F.array("parent", "child")).alias("name")).where("name is not null").distinct()
    roots = links.join(joints.select(F.col("child").alias("name")), "name", "left_anti")
    finite = F.forall("axis", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    length = F.aggregate("axis", F.lit(0.0), lambda a, x: a + F.abs(F.coalesce(x, F.lit(0.0))))
    moves = F.col("kind").isin("revolute", "prismatic")
    limited = F.col("lower").isNotNull() & F.col("upper").isNotNull()
    found = [
        note(joints.where(F.col("name").isNull() | (F.col("name") == "") | F.col("parent").isNull() | F.col("child").isNull()), "incomplete"),
        note(twice(joints, "name"), "name_twice"),
        note(twice(links, "name"), "link_twice"),
        note(joints.where(~F.coalesce(F.col("kind").isin(KINDS), F.lit(False))), "unknown_kind"),
        note(ends.join(links, "name", "left_anti"), "no_such_link"),
        note(twice(joints.where("parent is not null"), "parent"), "branches", "parent"),
        note(twice(joints.where("child is not null"), "child"), "two_parents", "child"),
        note(joints.where(F.col("kind").isin(ACTUATED) & ~((F.size("axis") == 3) & finite & (length > 0))), "bad_axis"),
        note(joints.where(moves & ~limited), "no_limits"),
        note(joints.where(limited & (F.col("lower") > F.col("upper"))), "limits_crossed"),
        note(roots.agg(F.count("*").alias("n"), F.min("name").alias("name")).where("n <> 1"), "not_one_base"),
        note(depths(joints).where("depth is null"), "circle"),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def arm(joints: DataFrame, links: DataFrame) -> DataFrame:
    """``chain_index, name, kind, lower, upper`` of the joints that move, counted from the base; raises for a bad
    description."""
    bad = faults(joints, links).limit(10).collect()
    if bad:
        raise ValueError("bad description: " + ", ".join(f"{r['fault']} ({r['name']})" for r in bad))
    moving = depths(joints).where(F.col("kind").isin(ACTUATED))
    return moving.select((F.row_number().over(Window.orderBy("depth")) - 1).alias("chain_index"), "name", "kind", "lower", "upper")


def write_arm(arm: DataFrame, folder: str) -> None:
    arm.orderBy("chain_index").coalesce(1).write.mode("overwrite").json(folder)


def read_arm(spark: SparkSession, folder: str) -> DataFrame:
    """What ``write_arm`` wrote; raises unless the chain indices count from 0 without gaps."""
    out = spark.read.schema("chain_index int, name string, kind string, lower double, upper double").json(folder)
    n = out.agg(F.count("*").alias("n"), F.count_distinct("chain_index").alias("d"), F.min("chain_index").alias("a"), F.max("chain_index").alias("z")).first()
    if n["n"] and (n["a"], n["z"], n["d"]) != (0, n["n"] - 1, n["n"]):
        raise ValueError("chain indices must count from 0 without gaps")
    return out
