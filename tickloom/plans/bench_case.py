"""A whole timing case over the given events: gate, normalise, align, summarise, judge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import bench, faults, quality
from tickloom.plans import base, sql
from tickloom.plans.base import HOUR

BUDGET = quality.JitterBudget(p99_ns=48 * HOUR, gap_factor=6.0, min_samples=3)
SKEW = 2 * HOUR


def bench_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report row for each user: its events against a copy with a stall, as one modality."""
    clean = base.stamps(spark, sf_dir).select("episode_id", "seq", "idx", "timestamp_ns")
    late = faults.burst_delay(clean, 10, 5, 120 * HOUR).select("episode_id", "seq", "idx", "timestamp_ns")
    return bench.report(clean, {"disturbed": late}, SKEW, BUDGET)


def bench_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of the report rows against thresholds."""
    return bench.gate(bench_rows(spark, sf_dir), {"max_flagged": 3, "max_non_matched": 10, "max_p95_abs_offset_ns": HOUR, "verdicts": ["aligned_within_budget", "degraded"]})


def bench_determinism(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of three cases over all users compared; the third shakes its stamps by a generator without a seed."""
    clean = base.stamps(spark, sf_dir).select("episode_id", "seq", "idx", "timestamp_ns")
    late = lambda df: lambda: bench.report(clean, {"disturbed": df().select("episode_id", "seq", "idx", "timestamp_ns")}, SKEW, BUDGET)
    shaken = lambda: clean.withColumn("timestamp_ns", F.col("timestamp_ns") + (F.rand() * HOUR).cast("long"))
    return bench.run_digests({"clean": late(lambda: clean), "burst": late(lambda: faults.burst_delay(clean, 10, 5, 120 * HOUR)), "shaken": late(shaken)})


def bench_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three cases over all users, run twice, read back from text and gated by thresholds; one case has none, and one
    threshold has no case."""
    clean = base.stamps(spark, sf_dir).select("episode_id", "seq", "idx", "timestamp_ns")

    def case(*chain):
        late = faults.chain(clean, list(chain), 1).select("episode_id", "seq", "idx", "timestamp_ns")
        return lambda: bench.report(clean, {"disturbed": late}, SKEW, BUDGET)

    burst = {"kind": "burst_delay", "window_start": 0, "window_len": 5, "delay_ns": 120 * HOUR}
    skewed = {"kind": "skewed_clock", "offset_ns": HOUR, "drift_ppm": 100.0}
    cases = {"clean": case(), "burst": case(burst), "skewed": case(skewed), "both": case(skewed, burst)}
    reports = bench.suite(cases)
    bounds = spark.createDataFrame(LIMITS, bench.THRESHOLDS)
    return bench.gate_cases(reports, bounds).groupBy("name", "verdict", "deterministic", "round_trips", "failures").agg(F.count("*").alias("episodes"))


#: Thresholds of the cases of ``bench_suite``.
LIMITS = [("clean", ["aligned_within_budget"], 0, 0, 0, 0, None), ("burst", ["degraded"], 3, 4, HOUR, HOUR, None), ("skewed", ["aligned_within_budget", "degraded"], 0, 0, SKEW, SKEW - 1, None), ("absent", ["degraded"], 0, 0, 0, 0, None)]


def _rows(source: str) -> str:
    """The report rows of the stamps in ``source``, as SQL that ends in ``rows_``."""
    return f"""{source}, {sql.jitter('bu', 6.0)},
rec AS (SELECT episode_id, 'disturbed' AS modality, seq, CASE WHEN coalesce(timestamp_ns <= max(timestamp_ns) OVER (PARTITION BY episode_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN NULL ELSE timestamp_ns END AS norm FROM bu),
ref AS (SELECT episode_id, timestamp_ns AS ns FROM st), clean AS (SELECT episode_id, modality, norm AS ns FROM rec WHERE norm IS NOT NULL), {sql.nearest('ref', 'clean', SKEW)},
r AS (SELECT episode_id, count(*) AS total_results, count(*) FILTER (quality <> 'matched') AS non_matched, max(abs(offset_ns)) AS max_abs_offset_ns, sum(abs(offset_ns))::DOUBLE / count(offset_ns) AS mean_abs_offset_ns FROM al GROUP BY 1),
o AS (SELECT episode_id, abs(offset_ns) AS off, row_number() OVER (PARTITION BY episode_id ORDER BY abs(offset_ns)) AS r, count(*) OVER (PARTITION BY episode_id) AS n FROM al WHERE offset_ns IS NOT NULL),
p AS (SELECT episode_id, min(off) FILTER (r >= ceil(0.95 * n)) AS p95_abs_offset_ns, min(off) FILTER (r >= ceil(0.99 * n)) AS p99_abs_offset_ns FROM o GROUP BY 1),
f AS (SELECT episode_id, count(*) AS n_stamps, count(*) - count(norm) AS flagged FROM rec GROUP BY 1),
g AS (SELECT episode_id, NOT (n_samples < 3 OR backwards > 0 OR dropouts > 0 OR p99_jitter_ns > {48 * HOUR}) AS gate_passed FROM jit),
rows_ AS (SELECT f.episode_id, 2 * n_stamps AS total_records, flagged AS violations, flagged, total_results, non_matched, max_abs_offset_ns, mean_abs_offset_ns, p95_abs_offset_ns, p99_abs_offset_ns, gate_passed,
    CASE WHEN NOT gate_passed OR n_stamps = flagged OR non_matched = total_results THEN 'quarantined' WHEN flagged > 0 OR non_matched > 0 THEN 'degraded' ELSE 'aligned_within_budget' END AS verdict
    FROM f JOIN g ON f.episode_id = g.episode_id JOIN r ON r.episode_id = f.episode_id LEFT JOIN p ON p.episode_id = f.episode_id)"""


_ROWS = _rows(base.BURST)
_SKEWED = "SELECT * REPLACE (timestamp_ns + 3600000000000 + CAST(round_even(100.0::DOUBLE * (timestamp_ns - first_value(timestamp_ns) OVER (PARTITION BY episode_id ORDER BY idx))::DOUBLE / 1e6, 0) AS BIGINT) AS timestamp_ns) FROM st"
_LATE = "CASE WHEN idx BETWEEN 0 AND 4 THEN timestamp_ns + 432000000000000 ELSE timestamp_ns END AS timestamp_ns"
_SOURCES = {"clean": "SELECT * FROM st", "burst": f"SELECT * REPLACE ({_LATE}) FROM st", "skewed": _SKEWED, "both": f"SELECT * REPLACE ({_LATE}) FROM ({_SKEWED})"}
_CASES = " UNION ALL ".join(f"SELECT * FROM (WITH {_rows(base.STAMPS + f', bu AS ({q})')} SELECT '{name}' AS name, * FROM rows_)" for name, q in _SOURCES.items())
_BOUNDS = ", ".join(f"('{n}', {v}, {m}, {f}, {a}, {p})" for n, v, m, f, a, p, _ in LIMITS)

QUERIES = {"bench_determinism": bench_determinism, "bench_rows": bench_rows, "bench_gate": bench_gate, "bench_suite": bench_suite}
SQL = {
    "bench_determinism": f"WITH {base.SAMPLES} SELECT name, count(DISTINCT episode_id) AS rows, name <> 'shaken' AS same FROM ev, (VALUES ('clean'), ('burst'), ('shaken')) c(name) GROUP BY name",
    "bench_rows": f"WITH {_ROWS} SELECT * FROM rows_",
    "bench_gate": f"""WITH {_ROWS} SELECT episode_id, concat_ws(',', CASE WHEN flagged > 3 THEN 'flagged:' || flagged END, CASE WHEN non_matched > 10 THEN 'non_matched:' || non_matched END,
    CASE WHEN coalesce(p95_abs_offset_ns, 0) > {HOUR} THEN 'p95_abs_offset_ns:' || p95_abs_offset_ns END, CASE WHEN verdict NOT IN ('aligned_within_budget', 'degraded') THEN 'verdict:' || verdict END) AS failures FROM rows_""",
    "bench_suite": f"""WITH c AS ({_CASES}), t(name, verdicts, max_violations, max_flagged, max_abs, max_p99) AS (VALUES {_BOUNDS})
SELECT coalesce(c.name, t.name) AS name, verdict, CASE WHEN c.name IS NOT NULL THEN true END AS deterministic, CASE WHEN c.name IS NOT NULL THEN true END AS round_trips,
    CASE WHEN c.name IS NULL THEN 'no_report' WHEN t.name IS NULL THEN 'no_thresholds' ELSE concat_ws(',', CASE WHEN NOT list_contains(verdicts, verdict) THEN 'verdict:' || verdict END, CASE WHEN violations > max_violations THEN 'violations:' || violations END, CASE WHEN flagged > max_flagged THEN 'flagged:' || flagged END,
    CASE WHEN max_abs_offset_ns > max_abs THEN 'max_abs_offset_ns:' || max_abs_offset_ns END, CASE WHEN p99_abs_offset_ns > max_p99 THEN 'p99_abs_offset_ns:' || p99_abs_offset_ns END) END AS failures, count(*) AS episodes
FROM c FULL JOIN t ON c.name = t.name GROUP BY ALL""",
}
