"""Guards and small scalar rules: stamps, clock domains, tokens, interpolation, calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.codec import is_finite

#: Event token of each tactile token (fixed values).
EVENT_OF_TOKEN = {"contact_start": "contact_start", "slip": "slip", "impact": "impact", "release": "contact_release"}


def checked_stamp(ns: Column, name: str = "stamp") -> Column:
    """The stamp itself; raises for stamps below 1 ns.  Larger than 64 bits cannot occur in a BIGINT."""
    return F.when(ns.isNull() | (ns >= 1), ns).otherwise(F.raise_error(F.concat(F.lit(f"{name} must be at least 1 ns, got "), ns.cast("string"))))


def require_monotonic(domain: Column, ns: Column) -> Column:
    return F.when(domain == "monotonic", ns).otherwise(F.raise_error(F.concat(F.lit("monotonic stamp needed, got domain "), F.coalesce(domain, F.lit("null")))))


def event_token(token: Column) -> Column:
    """Event kind of a tactile token; raises for unknown tokens."""
    out = F.when(token.isNull(), F.lit(None).cast("string"))
    for k, v in EVENT_OF_TOKEN.items():
        out = out.when(token == k, F.lit(v))
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown tactile token "), token)))


def interpolate(t: Column, t0: Column, v0: Column, t1: Column, v1: Column) -> Column:
    """Linear between two samples; exact at the ends; null outside them or where a value is not finite."""
    inside = (t1 > t0) & t.between(t0, t1) & is_finite(v0) & is_finite(v1)
    share = (t - t0).cast("double") / (t1 - t0).cast("double")
    return F.when(inside & (t == t0), v0).when(inside & (t == t1), v1).when(inside, v0 + (v1 - v0) * share)


def adc_to_millideg(raw: Column, slope: Column | float, intercept: Column | float) -> Column:
    """Single-precision product and sum, cut towards zero: what the device computes."""
    slope, intercept = (x if isinstance(x, Column) else F.lit(float(x)) for x in (slope, intercept))
    product = (raw.cast("float") * slope.cast("float")).cast("float")
    return (product + intercept.cast("float")).cast("float").cast("int")


def fit_line(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """``slope, intercept, n_points`` for each group, from exact integer sums; null without spread or second point.

    Products are summed as 38-digit decimals, so that stamps and large codes do not overflow.
    """
    big = lambda c: F.col(c).cast("decimal(19,0)")
    s = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n_points"), F.sum(big(x)).alias("sx"), F.sum(big(y)).alias("sy"), F.sum((big(x) * big(x)).cast("decimal(38,0)")).alias("sxx"), F.sum((big(x) * big(y)).cast("decimal(38,0)")).alias("sxy")
    )
    f = {k: F.col(k).cast("double") for k in ("n_points", "sx", "sy", "sxx", "sxy")}
    spread = f["n_points"] * f["sxx"] - f["sx"] * f["sx"]
    slope = F.when((F.col("n_points") >= 2) & (spread != 0), (f["n_points"] * f["sxy"] - f["sx"] * f["sy"]) / spread)
    return s.select(*by, "n_points", slope.alias("slope"), ((f["sy"] - slope * f["sx"]) / f["n_points"]).alias("intercept"))


def with_line(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """``df`` with ``fit_line`` of its groups.  The lines, a row for each device, are broadcast: the rows of a group stay
    where they are."""
    return df.join(F.broadcast(fit_line(df, x, y, by)), by)


def r_squared(df: DataFrame, x: str, y: str, slope: str, intercept: str, by: list[str]) -> DataFrame:
    """``r2`` for each group of whole numbers with single-precision, truncated predictions; below two points 0, without
    spread 1.

    Rows of one ``x`` have one prediction: their number, sum and sum of squares, added up before anything is shuffled, give
    both sums of squares exactly.
    """
    big = lambda c: c.cast("decimal(19,0)")
    product = lambda a, b: (big(a) * big(b)).cast("decimal(38,0)")
    own = df.groupBy(*by, x, slope, intercept).agg(F.count("*").alias("__n"), F.count(y).alias("__k"), F.sum(big(F.col(y))).alias("__s"), F.sum(product(F.col(y), F.col(y))).alias("__q"))
    p, s = adc_to_millideg(F.col(x), F.col(slope), F.col(intercept)).cast("decimal(10,0)"), F.col("__s")
    res = F.col("__q") - (2 * p * s.cast("decimal(26,0)")).cast("decimal(38,0)") + (p * p * F.col("__k")).cast("decimal(38,0)")
    parts = own.withColumn("__res", res).groupBy(*by).agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("__n", "__k", "__s", "__q", "__res")])
    n, k, s = (F.col(c).cast("double") for c in ("__n", "__k", "__s"))
    exact = (F.col("__n") * F.col("__q")).cast("decimal(38,0)") - (F.col("__s") * F.col("__s")).cast("decimal(38,0)")
    tot = exact.cast("double") / n + (k - n) * s * s / (n * n)
    return parts.select(*by, F.when(n < 2, F.lit(0.0)).when(tot == 0, F.lit(1.0)).otherwise(1 - F.col("__res").cast("double") / tot).alias("r2"))


def json_round_trip(df: DataFrame, columns: list[str], schema: str) -> DataFrame:
    """``ok`` of every row: whether its JSON form reads back to the same values and has no unknown keys."""
    packed = df.withColumn("__j", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    read = packed.withColumn("__r", F.from_json("__j", schema, {"mode": "FAILFAST"}))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"__r.{c}"))
    known = F.array(*[F.lit(c) for c in columns])
    strict = F.size(F.array_except(F.json_object_keys("__j"), known)) == 0
    return read.select(*df.columns, (same & strict).alias("ok"))
