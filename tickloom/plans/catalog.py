"""The queries of the telemetry operators over the given tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions import codec, render, serial, values
from tickloom.operators import align, events, faults, frames, meta, quality, scoring, timeline
from tickloom.plans import base, bench_case, datasets, long_episodes, recordings, sql
from tickloom.plans.base import HOUR
from tickloom.sources.registry import DETECTORS
from tickloom.streaming import stateful

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

#: The events of a user are hours apart; budgets are scaled to that.
BUDGET = quality.JitterBudget(p99_ns=48 * HOUR, gap_factor=6.0, min_samples=3)
SKEW = 6 * HOUR
TOLERANCE = 6 * HOUR


def query(oracle: str):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        _SQL[f.__name__] = oracle
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# Interval statistics and gates.


@query(f"WITH {base.SAMPLES}, {sql.jitter('ev')} SELECT * FROM jit")
def jitter_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.jitter(base.samples(spark, sf_dir))


@query(f"WITH {base.BY_DAY}, di AS (SELECT episode_id, timestamp_ns, min(seq) AS seq FROM bd GROUP BY 1, 2), {sql.jitter('di')} SELECT * FROM jit")
def jitter_distinct_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.jitter(quality.distinct_instants(base.by_day(spark, sf_dir)))


@query(f"""WITH {base.BURST}, {sql.jitter('bu', 6.0)}
SELECT *, concat_ws(',', CASE WHEN n_samples < 3 THEN 'too_few_samples:' || n_samples END, CASE WHEN backwards > 0 THEN 'backwards:' || backwards END,
    CASE WHEN dropouts > 0 THEN 'dropouts:' || dropouts END, CASE WHEN p99_jitter_ns > 172800000000000 THEN 'p99_jitter_ns:' || p99_jitter_ns END) AS reasons,
    NOT (n_samples < 3 OR backwards > 0 OR dropouts > 0 OR p99_jitter_ns > 172800000000000) AS ok
FROM jit""")
def jitter_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.recorder_gate(base.burst(spark, sf_dir), BUDGET).withColumn("reasons", F.concat_ws(",", "reasons"))


@query(f"""WITH {base.FULL}, ok AS (SELECT * FROM fs WHERE isfinite(joint_angle) AND isfinite(joint_velocity) AND isfinite(motor_current) AND isfinite(estimated_torque)),
di AS (SELECT episode_id, timestamp_ns, min(seq) AS seq FROM ok GROUP BY 1, 2), {sql.jitter('di', 6.0)},
r AS (SELECT a.episode_id, CASE WHEN n_samples IS NULL THEN 'empty' WHEN backwards > 0 THEN 'backwards' WHEN dropouts > 0 THEN 'dropouts' END AS reason FROM (SELECT DISTINCT episode_id FROM fs) a LEFT JOIN jit ON a.episode_id = jit.episode_id)
SELECT episode_id, reason IS NULL AS ok, reason FROM r""")
def export_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.export_gate(base.full_samples(spark, sf_dir), BUDGET)


@query(f"""WITH {base.BY_DAY}, di AS (SELECT episode_id, timestamp_ns, min(seq) AS seq FROM bd GROUP BY 1, 2), {sql.jitter('di', 6.0)},
r AS (SELECT *, CASE WHEN backwards > 0 THEN 'backwards' WHEN dropouts > 0 THEN 'dropouts' END AS reason FROM jit)
SELECT episode_id, reason IS NULL AS exported, reason IS NULL AND p99_jitter_ns > 172800000000000 AS quality_failed, reason FROM r""")
def frame_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.frame_gate(base.by_day(spark, sf_dir), BUDGET)


@query(f"""WITH {base.SAMPLES}, r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS r, count(*) OVER (PARTITION BY event_type) AS n FROM ev WHERE value IS NOT NULL)
SELECT event_type, min(value) FILTER (r >= ceil(0.5 * n)) AS p50, min(value) FILTER (r >= ceil(0.95 * n)) AS p95, min(value) FILTER (r >= ceil(0.99 * n)) AS p99 FROM r GROUP BY 1""")
def percentile_nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.nearest_rank_percentiles(base.samples(spark, sf_dir), "value", ("event_type",), {"p50": 50.0, "p95": 95.0, "p99": 99.0})


# Normalisation.

_NORM = """SELECT episode_id, seq, CASE WHEN {flag} IS NULL AND NOT back THEN {value} END AS normalized_ns, {skew} AS skew_ns,
    concat_ws(',', CASE WHEN back THEN 'backwards_in_source' END, {flag}) AS flags
FROM (SELECT *, coalesce(timestamp_ns <= max(timestamp_ns) OVER (PARTITION BY episode_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS back FROM bu)"""


def _normalized(records: DataFrame) -> DataFrame:
    return records.select("episode_id", "seq", "normalized_ns", "skew_ns", F.concat_ws(",", "flags").alias("flags"))


@query(f"WITH {base.BURST} " + _NORM.format(flag="NULL", value="timestamp_ns", skew="NULL::BIGINT"))
def normalize_monotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(timeline.normalize(base.burst(spark, sf_dir)))


@query(f"WITH {base.BURST} " + _NORM.format(flag="CASE WHEN timestamp_ns - 1704240000000000000 < 1 THEN 'skew_out_of_range' END", value="timestamp_ns - 1704240000000000000", skew="-1704240000000000000"))
def normalize_source_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(timeline.normalize(base.burst(spark, sf_dir), "source", -1_704_240_000_000_000_000))


@query(f"WITH {base.BURST} " + _NORM.format(flag="'unknown_skew'", value="NULL::BIGINT", skew="NULL::BIGINT"))
def normalize_unknown_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(timeline.normalize(base.burst(spark, sf_dir), "source"))


@query(f"WITH {base.BURST} SELECT * FROM (SELECT episode_id, seq, timestamp_ns, lag(timestamp_ns) OVER (PARTITION BY episode_id ORDER BY seq) AS before FROM bu) WHERE timestamp_ns <= before")
def timeline_disorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.disorder(base.burst(spark, sf_dir)).select("episode_id", "seq", "timestamp_ns", "before")


# Faults.


def _stamps(df: DataFrame) -> DataFrame:
    return df.select("episode_id", "idx", "timestamp_ns")


@query(f"WITH {base.STAMPS} SELECT episode_id, idx, timestamp_ns + 5000000 AS timestamp_ns FROM st")
def fault_fixed_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamps(faults.fixed_delay(base.stamps(spark, sf_dir), 5_000_000))


@query(f"WITH {base.BURST} SELECT episode_id, idx, timestamp_ns FROM bu")
def fault_burst_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamps(base.burst(spark, sf_dir))


@query(f"WITH {base.STAMPS} SELECT episode_id, idx, timestamp_ns FROM st WHERE (idx + 1) % 3 <> 0")
def fault_drop_every(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamps(faults.drop_every(base.stamps(spark, sf_dir), 3))


@query(f"WITH {base.STAMPS} SELECT episode_id, CASE WHEN idx > 4 THEN idx + 1 ELSE idx END AS idx, timestamp_ns FROM st UNION ALL SELECT episode_id, idx + 1, timestamp_ns FROM st WHERE idx = 4")
def fault_duplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamps(faults.duplicate(base.stamps(spark, sf_dir), 4))


@query(f"WITH {base.STAMPS} SELECT episode_id, CASE idx WHEN 7 THEN 8 WHEN 8 THEN 7 ELSE idx END AS idx, timestamp_ns FROM st")
def fault_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamps(faults.swap(base.stamps(spark, sf_dir), 7))


@query(f"WITH {base.STAMPS} SELECT episode_id, idx, timestamp_ns + 5000000 + CAST(round_even(500.0::DOUBLE * (timestamp_ns - first_value(timestamp_ns) OVER (PARTITION BY episode_id ORDER BY idx))::DOUBLE / 1e6, 0) AS BIGINT) AS timestamp_ns FROM st")
def fault_skewed_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamps(faults.skewed_clock(base.stamps(spark, sf_dir), 5_000_000, 500.0))


# Alignment.


def _floored(df: DataFrame, ns: int = HOUR) -> DataFrame:
    return df.withColumn("ns", F.col("ns") - F.col("ns") % ns)


@query(f"WITH {base.STREAMS}, {sql.nearest('refs', 'tgts', SKEW)} SELECT * FROM al")
def align_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, targets = base.streams(spark, sf_dir)
    return align.align_nearest(refs, targets, SKEW, base.MODALITIES)


@query(f"""WITH {base.STREAMS}, fr AS (SELECT * REPLACE (ns - ns % 21600000000000 AS ns) FROM refs), ft AS (SELECT * REPLACE (ns - ns % 21600000000000 AS ns) FROM tgts), {sql.nearest('fr', 'ft', 4 * SKEW)}
SELECT * FROM al""")
def align_nearest_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, targets = base.streams(spark, sf_dir)
    return align.align_nearest(_floored(refs, SKEW), _floored(targets, SKEW), 4 * SKEW, base.MODALITIES)


@query(f"""WITH {base.STREAMS}, fr AS (SELECT * REPLACE (ns - ns % 3600000000000 AS ns) FROM refs), ft AS (SELECT DISTINCT episode_id, modality, ns - ns % 3600000000000 AS ns FROM tgts),
a AS (SELECT r.episode_id, k.modality, r.ns, t.ns AS hit, EXISTS (SELECT 1 FROM ft x WHERE x.episode_id = r.episode_id AND x.modality = k.modality) AS has_any
    FROM fr r CROSS JOIN (SELECT DISTINCT modality FROM ft) k LEFT JOIN ft t ON t.episode_id = r.episode_id AND t.modality = k.modality AND t.ns = r.ns)
SELECT episode_id, modality, ns AS ref_ns, hit AS matched_ns, hit - ns AS offset_ns, 'exact' AS method, hit IS NOT NULL AS within_budget,
    CASE WHEN hit IS NOT NULL THEN 'matched' WHEN has_any THEN 'out_of_budget' ELSE 'no_target' END AS quality, false AS tie FROM a""")
def align_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, targets = base.streams(spark, sf_dir)
    return align.align_exact(_floored(refs), _floored(targets), base.MODALITIES)


@query(f"""WITH {base.STREAMS}, a AS (SELECT r.episode_id, k.modality, r.ns, t.ns AS hit FROM refs r CROSS JOIN (SELECT DISTINCT modality FROM tgts) k
    LEFT JOIN tgts t ON t.episode_id = r.episode_id AND t.modality = k.modality AND t.ns BETWEEN r.ns - {SKEW} AND r.ns + {SKEW})
SELECT episode_id, modality, ns AS ref_ns, hit AS matched_ns, hit - ns AS offset_ns, 'window' AS method, hit IS NOT NULL AS within_budget, CASE WHEN hit IS NOT NULL THEN 'matched' ELSE 'no_target' END AS quality, false AS tie FROM a""")
def align_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, targets = base.streams(spark, sf_dir)
    return align.align_window(refs, targets, SKEW, base.MODALITIES)


@query(f"""WITH {base.STREAMS}, {sql.nearest('refs', 'tgts', 2 * SKEW)}
SELECT modality, quality, method, count(*) AS n, min(offset_ns) AS min_ns, max(offset_ns) AS max_ns FROM al GROUP BY ALL""")
def align_modalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, targets = base.streams(spark, sf_dir)
    out = align.align_nearest(refs, targets, 2 * SKEW, base.MODALITIES)
    return out.groupBy("modality", "quality", "method").agg(F.count("*").alias("n"), F.min("offset_ns").alias("min_ns"), F.max("offset_ns").alias("max_ns"))


@query(f"""WITH {base.STREAMS}, b AS (SELECT r.episode_id, r.ns, (SELECT max(ns) FROM tgts t WHERE t.episode_id = r.episode_id AND t.modality = 'view' AND t.ns <= r.ns) AS t0,
    (SELECT min(ns) FROM tgts t WHERE t.episode_id = r.episode_id AND t.modality = 'view' AND t.ns >= r.ns) AS t1 FROM refs r),
v AS (SELECT b.*, x.value AS v0, y.value AS v1 FROM b LEFT JOIN tgts x ON x.episode_id = b.episode_id AND x.modality = 'view' AND x.ns = t0 LEFT JOIN tgts y ON y.episode_id = b.episode_id AND y.modality = 'view' AND y.ns = t1)
SELECT episode_id, ns, CASE WHEN t1 > t0 THEN CASE WHEN ns = t0 THEN v0 WHEN ns = t1 THEN v1 ELSE v0 + (v1 - v0) * ((ns - t0)::DOUBLE / (t1 - t0)::DOUBLE) END END AS value FROM v""")
def interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, targets = base.streams(spark, sf_dir)
    b = align.bracket(refs, targets.where("modality = 'view'"), "value")
    return b.select("episode_id", "ns", values.interpolate(F.col("ns"), F.col("t0"), F.col("v0"), F.col("t1"), F.col("v1")).alias("value"))


# Summaries.

_RECORDS = f"""{base.STREAMS}, rec AS (SELECT episode_id, modality, CASE WHEN coalesce(ns <= max(ns) OVER (PARTITION BY episode_id, modality ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN NULL ELSE ns END AS norm
    FROM (SELECT episode_id, modality, seq, CASE WHEN seq % 11 = 0 THEN ns + 432000000000000 ELSE ns END AS ns FROM tgts)),
clean AS (SELECT episode_id, modality, norm AS ns FROM rec WHERE norm IS NOT NULL), {sql.nearest('refs', 'clean', SKEW)},
tm AS (SELECT coalesce(a.episode_id, b.episode_id) AS episode_id, coalesce(a.modality, b.modality) AS modality, coalesce(clean, 0) AS clean, coalesce(flagged, 0) AS flagged, coalesce(matched, 0) AS matched, coalesce(out_of_budget, 0) AS out_of_budget, coalesce(no_target, 0) AS no_target, offset_min_ns, offset_max_ns, offset_mean_ns
    FROM (SELECT episode_id, modality, count(norm) AS clean, count(*) - count(norm) AS flagged FROM rec GROUP BY 1, 2) a
    FULL JOIN (SELECT episode_id, modality, count(*) FILTER (quality = 'matched') AS matched, count(*) FILTER (quality = 'out_of_budget') AS out_of_budget, count(*) FILTER (quality = 'no_target') AS no_target,
        min(offset_ns) AS offset_min_ns, max(offset_ns) AS offset_max_ns, sum(offset_ns)::DOUBLE / count(offset_ns) AS offset_mean_ns FROM al GROUP BY 1, 2) b ON a.episode_id = b.episode_id AND a.modality = b.modality)"""


def _records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records of two modalities, every 11th arriving late, and their alignment with the purchases."""
    refs, targets = base.streams(spark, sf_dir)
    late = targets.withColumn("timestamp_ns", F.when(F.col("seq") % 11 == 0, F.col("ns") + 120 * HOUR).otherwise(F.col("ns"))).drop("ns")
    records = timeline.normalize(late, by=("episode_id", "modality"))
    clean, _ = timeline.split(records)
    return records, align.align_nearest(refs, clean.select("episode_id", "modality", F.col("normalized_ns").alias("ns")), SKEW, base.MODALITIES)


@query(f"WITH {_RECORDS} SELECT * FROM tm")
def timing_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta.modality_timing(*_records(spark, sf_dir))


@query(f"""WITH {_RECORDS}, s AS (SELECT *, CASE WHEN clean = 0 OR (matched + out_of_budget + no_target > 0 AND matched = 0) THEN 2 WHEN flagged > 0 OR out_of_budget + no_target > 0 THEN 1 ELSE 0 END AS s FROM tm)
SELECT episode_id, CASE max(s) WHEN 0 THEN 'aligned_within_budget' WHEN 1 THEN 'degraded' ELSE 'quarantined' END AS verdict, CAST(sum(flagged) AS BIGINT) AS total_flagged, CAST(sum(matched) AS BIGINT) AS total_matched,
    CAST(sum(out_of_budget) AS BIGINT) AS total_out_of_budget, CAST(sum(no_target) AS BIGINT) AS total_no_target FROM s GROUP BY 1""")
def sync_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta.sync_verdict(meta.modality_timing(*_records(spark, sf_dir)))


@query(f"WITH {_RECORDS} SELECT episode_id, max(greatest(abs(offset_min_ns), abs(offset_max_ns))) AS max_abs_offset_ns FROM tm GROUP BY 1")
def max_abs_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta.max_abs_offset(meta.modality_timing(*_records(spark, sf_dir)))


@query(f"WITH {base.BURST} SELECT episode_id, 'backwards_in_source' AS flag, count(*) AS n FROM (SELECT *, timestamp_ns <= max(timestamp_ns) OVER (PARTITION BY episode_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS back FROM bu) WHERE back GROUP BY 1")
def flag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meta.flag_histogram(timeline.normalize(base.burst(spark, sf_dir)), ["episode_id"])


@query(f"""WITH {base.STREAMS}, a AS (SELECT DISTINCT episode_id, modality FROM tgts WHERE modality = 'view'), b AS (SELECT DISTINCT episode_id, modality FROM tgts WHERE seq % 2 = 0)
SELECT episode_id, modality, 'no_records' AS fault FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.episode_id = b.episode_id AND a.modality = b.modality)
UNION ALL SELECT episode_id, modality, 'no_results' FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.episode_id = b.episode_id AND a.modality = b.modality)""")
def timing_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, targets = base.streams(spark, sf_dir)
    return meta.orphans(targets.where("modality = 'view'"), targets.where("seq % 2 = 0"), "reference").select("episode_id", "modality", "fault")


# Detectors, phases, scores.


@query(f"WITH {base.FULL} SELECT episode_id, seq, timestamp_ns AS t_ns, 'current_spike' AS kind, 'estimated_torque' AS channel, abs(estimated_torque) AS level FROM fs WHERE NOT isnan(estimated_torque) AND abs(estimated_torque) >= 20.0")
def detect_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.detect_threshold(base.full_samples(spark, sf_dir), "estimated_torque", 20.0)


@query(f"WITH {base.SAMPLES}, rd AS (SELECT *, CASE WHEN tactile_event = 'release' THEN 0.0::DOUBLE WHEN tactile_event IS NOT NULL THEN 1.0::DOUBLE END AS level FROM ev), {sql.contact('rd', 0.5, 0.5)} SELECT * FROM con")
def detect_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.detect_contact(base.samples(spark, sf_dir), events.tactile_level(F.col("tactile_event")), 0.5, 0.5)


@query(f"WITH {base.FULL}, rd AS (SELECT *, abs(joint_angle) AS level FROM fs), {sql.contact('rd', 80.0, 20.0)} SELECT * FROM con")
def detect_contact_hysteresis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.detect_contact(base.full_samples(spark, sf_dir), F.abs("joint_angle"), 80.0, 20.0)


@query(f"WITH {base.SAMPLES}, rd AS (SELECT *, floor(value / 10)::DOUBLE AS level FROM ev), {sql.contact('rd', 3.0, 3.0)} SELECT * FROM con")
def detect_contact_collapsed_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.detect_contact(base.samples(spark, sf_dir), F.floor(F.col("value") / 10).cast("double"), 3.0, 3.0)


_IMPACTS = f"{base.FULL}, im AS (SELECT episode_id, chain_index, seq, timestamp_ns AS t_ns, 'impact' AS kind, abs(joint_angle - lag(joint_angle) OVER (PARTITION BY episode_id, chain_index ORDER BY seq)) AS delta FROM fs), hits AS (SELECT * FROM im WHERE isfinite(delta) AND delta >= 60.0)"


@query(f"WITH {_IMPACTS} SELECT * FROM hits")
def detect_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.detect_impact(base.full_samples(spark, sf_dir), "joint_angle", 60.0)


@query(f"""WITH RECURSIVE {_IMPACTS}, num AS (SELECT *, row_number() OVER (PARTITION BY episode_id, chain_index ORDER BY seq) AS k FROM hits),
walk AS (SELECT *, t_ns AS fired, true AS fires FROM num WHERE k = 1
    UNION ALL SELECT n.*, CASE WHEN n.t_ns - w.fired >= {96 * HOUR} THEN n.t_ns ELSE w.fired END, n.t_ns - w.fired >= {96 * HOUR} FROM walk w JOIN num n ON n.episode_id = w.episode_id AND n.chain_index = w.chain_index AND n.k = w.k + 1)
SELECT episode_id, chain_index, seq, t_ns, kind, delta FROM walk WHERE fires""")
def detect_impact_refractory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.detect_impact(base.full_samples(spark, sf_dir), "joint_angle", 60.0, 96 * HOUR)


def _truth_and_found(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Tokens of even samples as truth, of odd ones as detections."""
    e = base.samples(spark, sf_dir).where("tactile_event is not null").select("episode_id", F.col("tactile_event").alias("kind"), F.col("timestamp_ns").alias("t_ns"), F.col("seq").alias("ix"))
    return e.where("ix % 2 = 0"), e.where("ix % 2 = 1")


_MATCHES = f"""{base.SAMPLES}, tr AS (SELECT episode_id, tactile_event AS kind, timestamp_ns AS t_ns, seq AS ix FROM ev WHERE tactile_event IS NOT NULL AND seq % 2 = 0),
fo AS (SELECT episode_id, tactile_event AS kind, timestamp_ns AS t_ns, seq AS ix FROM ev WHERE tactile_event IS NOT NULL AND seq % 2 = 1),
pr AS (SELECT t.episode_id, t.kind, t.ix AS truth_ix, f.ix AS found_ix, t.t_ns AS truth_ns, f.t_ns AS found_ns, abs(t.t_ns - f.t_ns) AS dist,
    row_number() OVER (PARTITION BY t.episode_id, t.kind ORDER BY abs(t.t_ns - f.t_ns), t.t_ns, t.ix, f.t_ns, f.ix) AS k
    FROM tr t JOIN fo f ON f.episode_id = t.episode_id AND f.kind = t.kind AND abs(t.t_ns - f.t_ns) <= {TOLERANCE}),
walk AS (SELECT *, true AS taken, [truth_ix] AS ts, [found_ix] AS fs FROM pr WHERE k = 1
    UNION ALL SELECT p.*, NOT (list_contains(w.ts, p.truth_ix) OR list_contains(w.fs, p.found_ix)),
        CASE WHEN list_contains(w.ts, p.truth_ix) OR list_contains(w.fs, p.found_ix) THEN w.ts ELSE list_append(w.ts, p.truth_ix) END,
        CASE WHEN list_contains(w.ts, p.truth_ix) OR list_contains(w.fs, p.found_ix) THEN w.fs ELSE list_append(w.fs, p.found_ix) END
    FROM walk w JOIN pr p ON p.episode_id = w.episode_id AND p.kind = w.kind AND p.k = w.k + 1)"""


@query(f"WITH RECURSIVE {_MATCHES} SELECT episode_id, kind, truth_ix, found_ix, truth_ns, found_ns, dist FROM walk WHERE taken")
def match_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.match(*_truth_and_found(spark, sf_dir), TOLERANCE)


@query(f"""WITH RECURSIVE {_MATCHES}, c AS (SELECT kind, count(*) FILTER (src = 'm') AS tp, count(*) FILTER (src = 'f') - count(*) FILTER (src = 'm') AS fp, count(*) FILTER (src = 't') - count(*) FILTER (src = 'm') AS fn
    FROM (SELECT kind, 't' AS src FROM tr UNION ALL SELECT kind, 'f' FROM fo UNION ALL SELECT kind, 'm' FROM walk WHERE taken) GROUP BY ROLLUP (kind)),
r AS (SELECT *, CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp::DOUBLE / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 1.0 ELSE tp::DOUBLE / (tp + fn) END AS recall FROM c)
SELECT kind, tp, fp, fn, precision, recall, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM r""")
def score_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(*_truth_and_found(spark, sf_dir), TOLERANCE)


@query(f"""WITH {base.LATTICE}, {base.PHASES_SQL} SELECT la.episode_id, seq, phase_ix, kind AS phase_kind FROM la
LEFT JOIN ph ON start_s - 1e-9 <= (timestamp_ns - 1000000000)::DOUBLE / 1e9 AND (timestamp_ns - 1000000000)::DOUBLE / 1e9 < start_s + duration_s - 1e-9""")
def phase_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = events.phase_of(base.lattice(spark, sf_dir), base.phases(spark), F.lit(1_000_000_000))
    return out.select("episode_id", "seq", "phase_ix", "phase_kind")


@query(f"""WITH {base.LATTICE}, {base.PHASES_SQL}, own AS (SELECT * FROM la WHERE chain_index = 1), an AS (SELECT episode_id, min(timestamp_ns) AS anchor FROM own GROUP BY 1)
SELECT own.episode_id, phase_ix, CASE WHEN kind = 'release' THEN 'contact_release' ELSE kind END AS kind, min(timestamp_ns) AS t_ns FROM own JOIN an ON own.episode_id = an.episode_id
JOIN ph ON kind IN ('contact_start', 'slip', 'impact', 'release') AND start_s - 1e-9 <= (timestamp_ns - anchor)::DOUBLE / 1e9 AND (timestamp_ns - anchor)::DOUBLE / 1e9 < start_s + duration_s - 1e-9 GROUP BY ALL""")
def ground_truth_onsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.ground_truth(base.lattice(spark, sf_dir), base.phases(spark))


# Frame datasets.


def _text(c: str) -> F.Column:
    return F.array_join(F.transform(F.col(f"`{c}`"), lambda x: F.coalesce(x.cast("string"), F.lit("null"))), ",").alias(c.replace("observation.", ""))


_LISTED = "string_agg({0}::VARCHAR, ',' ORDER BY chain_index, seq)"


@query(f"""WITH {base.BY_DAY} SELECT episode_id, timestamp_ns, {_LISTED.format('chain_index')} AS chain_index, {_LISTED.format('joint_angle')} AS state,
    CASE WHEN count(camera_frame_id) = count(*) AND min(camera_frame_id) = max(camera_frame_id) THEN min(camera_frame_id) END AS camera_frame_id,
    CASE WHEN count(tactile_event) = count(*) AND min(tactile_event) = max(tactile_event) THEN min(tactile_event) END AS tactile_event FROM bd GROUP BY 1, 2""")
def frames_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = frames.pivot(base.by_day(spark, sf_dir))
    return out.select("episode_id", "timestamp_ns", _text("observation.chain_index"), _text("observation.state"), "camera_frame_id", "tactile_event")


@query(f"""WITH {base.BY_DAY} SELECT episode_id, timestamp_ns, CAST(row_number() OVER (PARTITION BY episode_id, timestamp_ns ORDER BY chain_index, seq) - 1 AS INTEGER) AS pos, chain_index::BIGINT AS chain_index, joint_angle, joint_velocity, motor_current, estimated_torque FROM bd""")
def frames_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.unnest(frames.pivot(base.by_day(spark, sf_dir))).drop("camera_frame_id", "tactile_event")


@query(f"""WITH {base.BY_DAY}, k AS (SELECT episode_id, timestamp_ns, row_number() OVER (PARTITION BY episode_id ORDER BY timestamp_ns) - 1 AS frame_index, dense_rank() OVER (ORDER BY episode_id) - 1 AS episode_index FROM (SELECT DISTINCT episode_id, timestamp_ns FROM bd))
SELECT *, row_number() OVER (ORDER BY episode_index, frame_index) - 1 AS index FROM k""")
def dense_export_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = base.by_day(spark, sf_dir).select("episode_id", "timestamp_ns").distinct()
    return frames.dense_index(f, f.select("episode_id", F.col("episode_id").alias("order")).distinct())


@query(f"""WITH {base.SAMPLES}, ep AS (SELECT episode_id, CASE WHEN episode_id % 7 = 0 THEN '' WHEN episode_id % 5 = 0 THEN NULL ELSE min_by(event_type, seq) END AS task_label FROM ev GROUP BY 1),
t AS (SELECT task_label, row_number() OVER (ORDER BY min(episode_id)) - 1 AS task_index FROM ep WHERE task_label IS NOT NULL AND task_label <> '' GROUP BY 1)
SELECT ep.episode_id, coalesce(t.task_index, -1) AS task_index FROM ep LEFT JOIN t ON ep.task_label = t.task_label""")
def task_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("episode_id") % 7 == 0, "").when(F.col("episode_id") % 5 == 0, F.lit(None).cast("string")).otherwise(F.min_by("event_type", "seq"))
    return frames.task_index(base.samples(spark, sf_dir).groupBy("episode_id").agg(label.alias("task_label")).withColumn("order", F.col("episode_id")))


@query(f"""WITH {base.BY_DAY}, di AS (SELECT episode_id, timestamp_ns, min(seq) AS seq FROM bd GROUP BY 1, 2), {sql.jitter('di')},
r AS (SELECT round_even(1e9 / period_ns, 6) AS fps, max_jitter_ns FROM jit WHERE n_samples >= 2 AND period_ns > 0), k AS (SELECT *, row_number() OVER (ORDER BY fps) AS r, count(*) OVER () AS n FROM r)
SELECT coalesce(min(fps) FILTER (r >= n // 2 + 1), 0.0) AS fps, max(max_jitter_ns) AS max_jitter_ns FROM k""")
def infer_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.infer_timing(quality.jitter(quality.distinct_instants(base.by_day(spark, sf_dir))))


@query(f"""WITH {base.BY_DAY}, x AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY timestamp_ns, chain_index, joint_angle) AS r FROM bd)
SELECT episode_id, CAST(r AS INTEGER) AS "row" FROM x WHERE r % 9 = 0""")
def roundtrip_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth row of the copy differs in a float; those rows and no others are found."""
    s = base.by_day(spark, sf_dir)
    order = Window.partitionBy("episode_id").orderBy("timestamp_ns", "chain_index", "joint_angle", "seq")
    other = s.withColumn("r", F.row_number().over(order)).withColumn("estimated_torque", F.when(F.col("r") % 9 == 0, F.col("estimated_torque") + 1).otherwise(F.col("estimated_torque"))).drop("r")
    return frames.differences(s, other)


@query(f"""WITH {_RECORDS} SELECT tm.* FROM tm WHERE episode_id % 3 <> 0""")
def sidecar_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    timing = meta.modality_timing(*_records(spark, sf_dir))
    known = base.samples(spark, sf_dir).select("episode_id").distinct()
    return meta.select_timing(timing, known, known.where("episode_id % 3 <> 0"))[0]


# Codec and calibration.


def _frames_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state frame for every event; every 13th has a wrong checksum."""
    s = base.samples(spark, sf_dir)
    data = codec.encode((F.col("seq") % 65536).cast("int"), (F.col("seq") % 60000 - 30000).cast("int"), (F.col("episode_id") % 256).cast("int"), F.col("chain_index"), (F.col("seq") % 64).cast("int"))
    broken = F.concat(F.substring(data, 1, 14), F.lpad(F.lower(F.hex((codec.byte_at(data, 7).bitwiseXOR(255)).cast("long"))), 2, "0"))
    return s.select("episode_id", "seq", "timestamp_ns", codec.can_id((F.col("episode_id") % 256).cast("int")).alias("can_id"), F.when(F.col("seq") % 13 == 0, broken).otherwise(data).alias("data"))


_BYTES = """b1 AS (SELECT *, seq % 65536 AS raw, (seq % 60000 - 30000) AS deg, episode_id % 256 AS node, seq % 64 AS flags FROM ev),
b2 AS (SELECT *, CASE WHEN deg < 0 THEN deg + 65536 ELSE deg END AS u FROM b1),
b3 AS (SELECT *, xor(xor(xor(xor(xor(xor(raw & 255, raw >> 8), u & 255), u >> 8), node), chain_index::BIGINT), flags) AS chk FROM b2)"""


@query(f"""WITH {base.SAMPLES}, {_BYTES} SELECT seq, CAST(node + 256 AS INTEGER) AS can_id, lower(format('{{:02x}}{{:02x}}{{:02x}}{{:02x}}{{:02x}}{{:02x}}{{:02x}}{{:02x}}', raw & 255, raw >> 8, u & 255, u >> 8, node, chain_index, flags, CASE WHEN seq % 13 = 0 THEN xor(chk, 255) ELSE chk END)) AS data FROM b3""")
def can_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frames_of(spark, sf_dir).select("seq", "can_id", "data")


@query(f"""WITH {base.SAMPLES}, {_BYTES} SELECT seq, CAST(raw AS INTEGER) AS raw_adc, CAST(deg AS INTEGER) AS millideg, CAST(node AS INTEGER) AS node_id, chain_index, CAST(flags AS INTEGER) AS status_flags, seq % 13 <> 0 AS valid, deg * (pi() / 180.0::DOUBLE / 1000.0::DOUBLE) AS angle_rad FROM b3""")
def can_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _frames_of(spark, sf_dir).select("seq", codec.decode(F.col("data")).alias("s")).select("seq", "s.*")
    return out.withColumn("angle_rad", codec.angle_rad(F.col("millideg")))


@query(f"""WITH {base.SAMPLES}, {_BYTES} SELECT seq, timestamp_ns // 1000000000 AS sec, timestamp_ns % 1000000000 AS nanosec, 'joint_pod' AS frame_id, CAST(node AS INTEGER) AS node_id, chain_index, CAST(raw AS INTEGER) AS angle_raw_adc, CAST(deg AS INTEGER) AS angle_millideg,
    deg * (pi() / 180.0::DOUBLE / 1000.0::DOUBLE) AS angle_rad, CAST(flags AS INTEGER) AS status_flags, seq % 13 <> 0 AS checksum_valid, 1 AS schema_version FROM b3""")
def pod_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message of every frame, laid flat."""
    m = _frames_of(spark, sf_dir).select("seq", codec.message(F.col("data"), F.col("timestamp_ns")).alias("m")).select("seq", "m.*")
    return m.select("header.stamp.*", "header.frame_id", *[c for c in m.columns if c != "header"])


@query(f"WITH {base.SAMPLES} SELECT episode_id, CASE WHEN seq % 13 = 0 THEN 'checksum_invalid' END AS reason, count(*) AS n FROM ev GROUP BY ALL")
def can_checksum_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _frames_of(spark, sf_dir).select("episode_id", codec.decode(F.col("data")).alias("s"))
    return out.groupBy("episode_id", codec.reject_reason(F.col("s.valid"), codec.angle_rad(F.col("s.millideg"))).alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {base.SAMPLES} SELECT CAST(i AS INTEGER) AS bit, sum((seq % 64 >> i) & 1)::BIGINT AS n FROM ev, range(6) t(i) GROUP BY 1")
def status_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = _frames_of(spark, sf_dir).select(codec.decode(F.col("data"))["status_flags"].alias("f"))
    bits = F.array(*[codec.status_bit(F.col("f"), k) for k in range(6)])
    return flags.select(F.posexplode(bits).alias("bit", "on")).groupBy("bit").agg(F.sum("on").alias("n"))


_CALIB = "SELECT l_returnflag, CAST(l_quantity AS INTEGER) AS raw_adc, CAST(floor(l_extendedprice / 10) AS INTEGER) AS millideg FROM lineitem"


def _calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", F.col("l_quantity").cast("int").alias("raw_adc"), F.floor(F.col("l_extendedprice") / 10).cast("int").alias("millideg"))


_FIT = f"""c AS ({_CALIB}), s AS (SELECT l_returnflag, count(*) AS n, sum(raw_adc)::DOUBLE AS sx, sum(millideg)::DOUBLE AS sy, sum(raw_adc::HUGEINT * raw_adc)::DOUBLE AS sxx, sum(raw_adc::HUGEINT * millideg)::DOUBLE AS sxy FROM c GROUP BY 1),
f AS (SELECT l_returnflag, n AS n_points, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope, (sy - (n * sxy - sx * sy) / (n * sxx - sx * sx) * sx) / n AS intercept FROM s)"""


@query(f"WITH {_FIT} SELECT * FROM f")
def calib_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values.fit_line(_calibration(spark, sf_dir), "raw_adc", "millideg", ["l_returnflag"])


@query(f"WITH {_FIT} SELECT c.l_returnflag, raw_adc, CAST(trunc((raw_adc::FLOAT * slope::FLOAT)::FLOAT + intercept::FLOAT) AS INTEGER) AS predicted, count(*) AS n FROM c JOIN f ON c.l_returnflag = f.l_returnflag GROUP BY ALL")
def calib_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _calibration(spark, sf_dir)
    j = values.with_line(c, "raw_adc", "millideg", ["l_returnflag"])
    return j.groupBy("l_returnflag", "raw_adc", values.adc_to_millideg(F.col("raw_adc"), F.col("slope"), F.col("intercept")).alias("predicted")).agg(F.count("*").alias("n"))


@query(f"""WITH {_FIT}, p AS (SELECT c.l_returnflag, millideg, trunc((raw_adc::FLOAT * slope::FLOAT)::FLOAT + intercept::FLOAT)::DOUBLE AS p FROM c JOIN f ON c.l_returnflag = f.l_returnflag),
m AS (SELECT l_returnflag, sum(millideg)::DOUBLE / count(*) AS m FROM p GROUP BY 1)
SELECT p.l_returnflag, round(1 - sum((millideg - p) * (millideg - p)) / sum((millideg - m) * (millideg - m)), 9) AS r2 FROM p JOIN m ON p.l_returnflag = m.l_returnflag GROUP BY 1""")
def calib_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _calibration(spark, sf_dir)
    j = values.with_line(c, "raw_adc", "millideg", ["l_returnflag"])
    return values.r_squared(j, "raw_adc", "millideg", "slope", "intercept", ["l_returnflag"]).withColumn("r2", F.round("r2", 9))


# Latest rows, carried values, rates, JSON.


@query(f"WITH {base.SAMPLES} SELECT episode_id, chain_index, max_by(event_type, seq) AS event_type, max_by(value, seq) AS value, max(seq) AS seq FROM ev GROUP BY 1, 2")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.max(F.struct("seq", "event_type", "value")).alias("l")
    return base.samples(spark, sf_dir).groupBy("episode_id", "chain_index").agg(last).select("episode_id", "chain_index", "l.event_type", "l.value", "l.seq")


@query(f"WITH {base.SAMPLES} SELECT episode_id, seq, last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY episode_id, chain_index ORDER BY seq) AS carried FROM ev")
def carry_last_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    upto = Window.partitionBy("episode_id", "chain_index").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return base.samples(spark, sf_dir).select("episode_id", "seq", F.last(F.when(F.col("event_type") != "error", F.col("value")), True).over(upto).alias("carried"))


@query(f"""WITH {base.SAMPLES} SELECT episode_id, count(*) FILTER (event_type <> 'error') AS n_ok, count(*) FILTER (event_type = 'error') AS n_errors,
    CASE WHEN count(*) FILTER (event_type <> 'error') > 1 THEN (count(*) FILTER (event_type <> 'error') - 1) / ((max(timestamp_ns) FILTER (event_type <> 'error') - min(timestamp_ns) FILTER (event_type <> 'error'))::DOUBLE / 1e9) ELSE 0.0 END AS hz,
    array_to_string(list_slice(list(seq ORDER BY seq) FILTER (event_type = 'error'), 1, 10), ',') AS first_errors FROM ev GROUP BY 1""")
def stream_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of good frames and the first ten errors of each stream."""
    s = base.samples(spark, sf_dir)
    bad = F.col("event_type") == "error"
    first = s.where(bad).withColumn("n", F.row_number().over(Window.partitionBy("episode_id").orderBy("seq"))).where("n <= 10").groupBy("episode_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("seq")), lambda x: x.cast("string")), ",").alias("first_errors"))
    good = F.when(~bad, F.col("timestamp_ns"))
    rate = s.groupBy("episode_id").agg(F.count_if(~bad).alias("n_ok"), F.count_if(bad).alias("n_errors"), ((F.max(good) - F.min(good)).cast("double") / 1e9).alias("span"))
    hz = F.when(F.col("n_ok") > 1, (F.col("n_ok") - 1) / F.col("span")).otherwise(0.0)
    return rate.join(first, "episode_id", "left").select("episode_id", "n_ok", "n_errors", hz.alias("hz"), "first_errors")


@query(f"WITH {base.SAMPLES} SELECT episode_id, seq, timestamp_ns, value, tactile_event, true AS ok FROM ev")
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples written as JSON and read back; none may differ."""
    s = base.samples(spark, sf_dir).select("episode_id", "seq", "timestamp_ns", "value", "tactile_event")
    return values.json_round_trip(s, s.columns, "episode_id long, seq long, timestamp_ns long, value double, tactile_event string")


@query(f"WITH {base.SAMPLES} SELECT seq, timestamp_ns // 1000000000 AS sec, timestamp_ns % 1000000000 AS nanosec FROM ev")
def stamp_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.samples(spark, sf_dir).select("seq", codec.stamp_parts(F.col("timestamp_ns")).alias("s")).select("seq", "s.*")


@query(f"""WITH {base.SAMPLES}, {_BYTES}, l AS (SELECT seq, node, chain_index, deg, deg * (pi() / 180.0::DOUBLE / 1000.0::DOUBLE) AS angle, flags, seq % 13 <> 0 AS ok FROM b3),
p AS (SELECT *, CAST(round_even((least(pi(), greatest(-pi(), angle)) + pi()) / (2 * pi()) * 39, 0) AS INTEGER) AS k FROM l),
q AS (SELECT *, substr(repeat('-', 20) || '|' || repeat('-', 19), 1, k) || '#' || substr(repeat('-', 20) || '|' || repeat('-', 19), k + 2) AS bar FROM p)
SELECT seq, 'pod ' || lpad(node::VARCHAR, greatest(2, length(node::VARCHAR))::INTEGER, ' ') || ':' || rpad(chain_index::VARCHAR, greatest(2, length(chain_index::VARCHAR))::INTEGER, ' ') || ' ' || printf('%+8.2f', deg / 1000.0::DOUBLE) || ' deg  [' || bar || '] ' || CASE WHEN flags = 0 THEN 'ok' ELSE '0x' || printf('%02X', flags) END || CASE WHEN ok THEN '' ELSE ' CK!' END AS line
FROM q""")
def pod_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _frames_of(spark, sf_dir).select("seq", codec.decode(F.col("data")).alias("s")).select("seq", "s.*")
    return f.select("seq", render.pod_line(F.col("node_id"), F.col("chain_index"), F.col("millideg"), codec.angle_rad(F.col("millideg")), F.col("status_flags"), F.col("valid")).alias("line"))


@query(f"WITH {base.FULL} SELECT episode_id, count(*) FILTER (isfinite(joint_angle)) AS recorded, count(*) FILTER (NOT isfinite(joint_angle)) AS dropped_by_recorder, count(*) FILTER (NOT (isfinite(joint_angle) AND isfinite(joint_velocity) AND isfinite(motor_current) AND isfinite(estimated_torque))) AS dropped_by_export FROM fs GROUP BY 1")
def drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recorder looks at the angle alone, exports at all four floats."""
    s, angle = base.full_samples(spark, sf_dir), codec.is_finite(F.col("joint_angle"))
    return s.groupBy("episode_id").agg(F.count_if(angle).alias("recorded"), F.count_if(~angle).alias("dropped_by_recorder"), F.count_if(~quality.finite_row()).alias("dropped_by_export"))


@query(f"WITH {base.SAMPLES} SELECT seq, CASE tactile_event WHEN 'release' THEN 'contact_release' ELSE tactile_event END AS kind FROM ev")
def event_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.samples(spark, sf_dir).select("seq", values.event_token(F.col("tactile_event")).alias("kind"))


@query(f"WITH {base.BURST} SELECT episode_id, count(*) FILTER (NOT isfinite(value)) AS not_finite, count(*) FILTER (timestamp_ns < before) AS decreasing, count(*) FILTER (timestamp_ns < 1) AS below_first FROM (SELECT *, lag(timestamp_ns) OVER (PARTITION BY episode_id ORDER BY seq) AS before FROM bu) GROUP BY 1")
def replay_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a recording must not have to be replayed: values that are not finite, and stamps that decrease."""
    s = base.burst(spark, sf_dir).withColumn("before", F.lag("timestamp_ns").over(Window.partitionBy("episode_id").orderBy("seq")))
    return s.groupBy("episode_id").agg(F.count_if(~codec.is_finite(F.col("value"))).alias("not_finite"), F.count_if(F.col("timestamp_ns") < F.col("before")).alias("decreasing"), F.count_if(F.col("timestamp_ns") < 1).alias("below_first"))


_BROKEN = """br AS (SELECT * REPLACE (CASE WHEN episode_id % 5 = 1 THEN offset_max_ns + 1 ELSE offset_min_ns END AS offset_min_ns, CASE WHEN episode_id % 5 = 2 THEN NULL ELSE offset_mean_ns END AS offset_mean_ns,
    CASE WHEN episode_id % 5 = 3 THEN 0 ELSE matched END AS matched) FROM tm)"""


@query(f"""WITH {_RECORDS}, {_BROKEN} SELECT episode_id, modality FROM br WHERE matched + out_of_budget + no_target = 0 OR clean + flagged = 0 OR least(clean, flagged, matched, out_of_budget, no_target) < 0 OR NOT offset_mean_ns BETWEEN offset_min_ns AND offset_max_ns OR (matched > 0) <> (offset_mean_ns IS NOT NULL) OR offset_min_ns > offset_max_ns OR greatest(abs(offset_min_ns), abs(offset_max_ns)) > {SKEW}""")
def timing_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that contradict themselves, of a summary that was spoilt in three ways."""
    t, of = meta.modality_timing(*_records(spark, sf_dir)), F.col("episode_id") % 5
    spoilt = t.withColumns({"offset_min_ns": F.when(of == 1, F.col("offset_max_ns") + 1).otherwise(F.col("offset_min_ns")), "offset_mean_ns": F.when(of != 2, F.col("offset_mean_ns")), "matched": F.when(of == 3, 0).otherwise(F.col("matched"))})
    return meta.contradictions(spoilt, SKEW)


@query(_SQL["score_events"])
def score_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores written as text and read back strictly."""
    text = score_events(spark, sf_dir).select(serial.written(serial.SCORE).alias("text"))
    return text.select(serial.read_score(F.col("text")).alias("s")).select("s.*")


@query(bench_case.SQL["bench_rows"])
def report_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows written as text and read back strictly."""
    text = bench_case.bench_rows(spark, sf_dir).select(serial.written(serial.REPORT).alias("text"))
    return text.select(serial.read_report(F.col("text")).alias("r")).select("r.*")


@query(f"WITH {_RECORDS} SELECT * FROM tm")
def timing_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries written as text and read back strictly."""
    text = meta.modality_timing(*_records(spark, sf_dir)).select(serial.written(serial.TIMING).alias("text"))
    return text.select(serial.read(F.col("text"), serial.TIMING).alias("t")).select("t.*")


@query(f"""WITH {base.BURST}, r AS (SELECT *, coalesce(timestamp_ns <= max(timestamp_ns) OVER (PARTITION BY episode_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS back FROM bu)
SELECT seq, timestamp_ns AS raw_ns, 'monotonic' AS domain, CASE WHEN NOT back THEN timestamp_ns END AS normalized_ns, CASE WHEN back THEN 'backwards_in_source' ELSE '' END AS flags, CAST(NULL AS BIGINT) AS skew_ns FROM r""")
def record_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised records written as text and read back strictly."""
    r = timeline.normalize(base.burst(spark, sf_dir)).withColumn("original", F.struct(F.col("timestamp_ns").alias("raw_ns"), F.lit("monotonic").alias("domain")))
    back = r.select("seq", serial.written(serial.RECORD).alias("text")).select("seq", serial.read_record(F.col("text")).alias("r"))
    return back.select("seq", "r.original.*", "r.normalized_ns", F.array_join("r.flags", ",").alias("flags"), "r.skew_ns")


@query(f"""WITH {base.SAMPLES} SELECT seq, seq % 4096 AS raw_adc, CAST(floor(value * 100) AS INTEGER) % 60000 - 30000 AS calibrated_millideg, CAST(seq % 256 AS INTEGER) AS node_id, CAST(episode_id % 256 AS INTEGER) AS chain_index, CAST(seq % 64 AS INTEGER) AS status_flags, true AS valid,
    CAST(768 + seq % 256 AS INTEGER) AS can_id FROM ev""")
def calib_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration frames, encoded and decoded."""
    node = (F.col("seq") % 256).cast("int")
    data = codec.encode_calib((F.col("seq") % 4096).cast("int"), F.floor(F.col("value") * 100).cast("int") % 60000 - 30000, node, (F.col("episode_id") % 256).cast("int"), (F.col("seq") % 64).cast("int"))
    return base.samples(spark, sf_dir).select("seq", codec.decode_calib(data).alias("s"), codec.calib_can_id(node).alias("can_id")).select("seq", "s.*", "can_id")


@query(f"""WITH {base.FULL}, rd AS (SELECT *, CASE WHEN tactile_event IN ('contact_start', 'slip', 'impact') THEN 1.0 WHEN tactile_event = 'release' THEN 0.0 END::DOUBLE AS level FROM fs), {sql.contact('rd', 0.5, 0.5)},
d AS (SELECT *, joint_velocity - lag(joint_velocity) OVER (PARTITION BY episode_id, chain_index ORDER BY seq) AS delta FROM fs)
SELECT episode_id, seq, kind, t_ns AS t_monotonic_ns, 0.5::DOUBLE AS confidence, 'tactile_event' AS channel, 'contact' AS detector, 1 AS schema_version, 'level,onset_threshold,release_threshold' AS names, level AS first, 0.5::DOUBLE AS second FROM con
UNION ALL SELECT episode_id, seq, 'current_spike', timestamp_ns, 1.0, 'motor_current', 'threshold', 1, 'value,threshold', motor_current, 20.0 FROM fs WHERE abs(motor_current) >= 20
UNION ALL SELECT episode_id, seq, 'impact', timestamp_ns, 0.9, 'joint_velocity', 'impact', 1, 'delta,jerk_threshold', delta, 30.0 FROM d WHERE abs(delta) >= 30""")
def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full records of four detectors, chosen by name."""
    s = base.full_samples(spark, sf_dir)
    found = [DETECTORS.make("noop", s), DETECTORS.make("contact", s, confidence=0.5), DETECTORS.make("threshold", s, "motor_current", 20.0), DETECTORS.make("impact", s, "joint_velocity", 30.0, confidence=0.9)]
    out = reduce(DataFrame.unionByName, found)
    values_ = F.map_values("payload")
    return out.withColumns({"names": F.array_join(F.map_keys("payload"), ","), "first": F.get(values_, 0), "second": F.get(values_, 1)}).drop("payload")


@query(f"""WITH {base.STAMPS}, a AS (SELECT *, timestamp_ns + CASE WHEN idx < 3 THEN {HOUR} ELSE 0 END AS t FROM st), b AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY idx) - 1 AS i FROM a WHERE (idx + 1) % 4 <> 0),
c AS (SELECT *, first_value(t) OVER (PARTITION BY episode_id ORDER BY i) AS t0 FROM b), d AS (SELECT episode_id, i, t + 5000 + CAST(round_even(20.0::DOUBLE * (t - t0)::DOUBLE / 1e6, 0) AS BIGINT) AS t FROM c)
SELECT episode_id, CASE WHEN i = 0 THEN k ELSE i + 1 END AS idx, t + 7 AS timestamp_ns FROM d, range(2) g(k) WHERE i = 0 OR k = 0""")
def fault_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five faults by kind, one after the other."""
    chain = [{"kind": "burst_delay", "window_start": 0, "window_len": 3, "delay_ns": HOUR}, {"kind": "drop", "every_k": 4}, {"kind": "skewed_clock", "offset_ns": 5000, "drift_ppm": 20.0}, {"kind": "duplicate", "at_index": 0}, {"kind": "fixed_delay", "delay_ns": 7}]
    return faults.chain(base.stamps(spark, sf_dir).select("episode_id", "idx", "timestamp_ns"), chain, 3)


# The same events as a stream.


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.samples_stream(spark, sf_dir)


@query(f"WITH {base.SAMPLES} SELECT episode_id, seq, timestamp_ns, CASE WHEN coalesce(timestamp_ns <= max(timestamp_ns) OVER (PARTITION BY episode_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN 'backwards_in_source' ELSE '' END AS flags FROM (SELECT * REPLACE (CASE WHEN seq % 17 = 0 THEN timestamp_ns + 432000000000000 ELSE timestamp_ns END AS timestamp_ns) FROM ev)")
def stream_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = _streamed(spark, sf_dir).withColumn("timestamp_ns", F.when(F.col("seq") % 17 == 0, F.col("timestamp_ns") + 120 * HOUR).otherwise(F.col("timestamp_ns")))
    return stateful.run_available(stateful.normalize(late), base.stream_folder(spark))


@query(f"WITH {base.SAMPLES}, rd AS (SELECT *, value AS level FROM ev), {sql.contact('rd', 80.0, 20.0)} SELECT episode_id, seq, t_ns, kind FROM con")
def stream_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _streamed(spark, sf_dir).select("episode_id", "seq", "timestamp_ns", F.col("value").alias("level"))
    return stateful.run_available(stateful.contacts(readings, 80.0, 20.0), base.stream_folder(spark))


@query(f"WITH {base.SAMPLES}, im AS (SELECT episode_id, chain_index, seq, timestamp_ns AS t_ns, abs(value - lag(value) OVER (PARTITION BY episode_id, chain_index ORDER BY seq)) AS delta FROM ev) SELECT * FROM im WHERE delta >= 60.0")
def stream_impacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _streamed(spark, sf_dir).select("episode_id", "chain_index", "seq", "timestamp_ns", "value")
    return stateful.run_available(stateful.impacts(s, 60.0), base.stream_folder(spark))


_QUERIES |= bench_case.QUERIES | long_episodes.QUERIES | datasets.QUERIES | recordings.QUERIES
_SQL |= bench_case.SQL | long_episodes.SQL | datasets.SQL | recordings.SQL
