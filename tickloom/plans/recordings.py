"""Queries over recordings as a whole: streams of an episode, reports, scripts, robot descriptions, parts chosen by name."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import checks, codec, serial, values
from tickloom.operators import align, bench, events, faults, quality
from tickloom.plans import base, sql
from tickloom.plans.base import HOUR
from tickloom.schema import METHODS, QUALITIES
from tickloom.session import cut_lineage, shared_folder
from tickloom.sources import canlog, commits, description, episodes
from tickloom.sources.registry import EXPORTERS, SOURCES, fault_counts
from tickloom.streaming import stateful

BUDGET = quality.JitterBudget(p99_ns=48 * HOUR, gap_factor=6.0, min_samples=3)
SKEW, NEAR = 12 * HOUR, 6 * HOUR
#: Bounds of the case of ``bench_table``.
LIMITS = [("streams", ["aligned_within_budget", "degraded"], 1, 4, SKEW, SKEW - 1, 0.1)]


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/recording-{uuid.uuid4().hex}"


# The streams of an episode, and their report.


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Four streams read the samples; written once, their order is not worked out for each.
    late = bench.episode_streams(cut_lineage(base.burst(spark, sf_dir).select("episode_id", "chain_index", "seq", "timestamp_ns", "tactile_event")))
    targets = {k: late[k] for k in ("frames", "tactile")}
    return bench.report(late["proprio"], targets, SKEW, BUDGET, late["events"], "frames", NEAR, base.samples(spark, sf_dir))


def bench_episode_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report row for each user, from three chains with a stall: two aligned with the third, and tactile events with the
    frames near them."""
    return _report(spark, sf_dir)


def bench_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, computed twice, gated and written as a table of text, line by line."""
    folder = _folder(spark)
    gated = bench.gate_cases(bench.suite({"streams": lambda: _report(spark, sf_dir)}), spark.createDataFrame(LIMITS, bench.THRESHOLDS))
    bench.write_table(gated, folder)
    return canlog.numbered_lines(spark, folder).select(F.col("value").alias("text"), (F.col("seq") - 1).alias("number"))


def bench_survival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps of each stream before and after a stall and the loss of every fifth, and how many normalise cleanly."""
    clean, late = base.stamps(spark, sf_dir), faults.drop_every(base.burst(spark, sf_dir), 5)
    return bench.survival(bench.episode_streams(clean), bench.episode_streams(late))


# Scripts, stamps, tokens.


def _script(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user's events as a script of phases, with what a script must not have."""
    kind = F.when(F.col("seq") % 37 == 0, "hop").when(F.col("tactile_event").isNull(), "settle").otherwise(F.col("tactile_event"))
    start = F.col("idx") * 0.5 + F.when(F.col("seq") % 29 == 0, 0.25).otherwise(0.0)
    return base.stamps(spark, sf_dir).select("episode_id", F.col("idx").alias("phase_ix"), kind.alias("kind"), start.alias("start_s"), F.when(F.col("seq") % 31 == 0, 0.0).otherwise(0.5).alias("duration_s"))


def phase_script_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with each script, phase by phase."""
    return events.check_phases(_script(spark, sf_dir), ("episode_id",))


def phase_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phases of known kinds that last, written as text and read back strictly."""
    fine = _script(spark, sf_dir).where("kind <> 'hop' and duration_s > 0")
    text = fine.select("episode_id", "phase_ix", serial.written(serial.PHASE).alias("text"))
    return text.select("episode_id", "phase_ix", serial.read_phase(F.col("text")).alias("p")).select("episode_id", "phase_ix", "p.*")


def stamp_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps written as text and read back, each compared with the one before it."""
    s = base.burst(spark, sf_dir).select("episode_id", "seq", F.col("timestamp_ns").alias("raw_ns"), F.lit("monotonic").alias("domain"))
    back = s.select("episode_id", "seq", serial.read_stamp(serial.written(serial.STAMP)).alias("s"))
    ordered = back.withColumn("p", F.expr("lag(s) over (partition by episode_id order by seq)"))
    ns = values.checked_stamp(values.require_monotonic(F.col("s.domain"), F.col("s.raw_ns")))
    return ordered.select("seq", ns.alias("ns"), F.when(F.col("p").isNotNull(), serial.stamp_before(F.col("p"), F.col("s"))).alias("later"))


def checked_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of an alignment whose tokens, offsets and counts are checked on the way, in totals for each episode."""
    refs, targets = base.streams(spark, sf_dir)
    r = align.align_nearest(refs, targets, NEAR, base.MODALITIES)
    r = r.withColumns({"quality": checks.member(F.col("quality"), QUALITIES, "quality"), "method": checks.member(F.col("method"), METHODS, "method"), "offset_ns": checks.offset(F.col("offset_ns"), "offset_ns")})
    n = r.groupBy("episode_id", "quality", "method").agg(F.count("*").alias("n"), F.sum("offset_ns").alias("offset_ns"), F.count_if("tie").alias("ties"))
    share = checks.ratio(F.col("ties") / F.col("n"), "ties")
    return n.withColumns({"n": checks.count(F.col("n"), "n"), "tied": share}).drop("ties")


# Robot descriptions.


def _robot(spark: SparkSession, sf_dir: str, spoilt: bool) -> tuple[DataFrame, DataFrame]:
    """A chain with a joint for each supplier, written as a description and read back."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), (F.abs("s_acctbal") + 1).alias("reach"))
    link = lambda k: F.format_string("link_%d", k)
    bad = F.col("k") % 10 if spoilt else F.lit(0)
    kind = F.when(bad == 7, "hinge").when(F.col("k") % 3 == 1, "fixed").when(F.col("k") % 3 == 2, "prismatic").otherwise("revolute")
    axis = F.when(bad == 5, F.array(*[F.lit(0.0)] * 3)).otherwise(F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    turned = F.when(bad == 3, -1).otherwise(1)
    joints = s.select("name", kind.alias("kind"), link(F.col("k")).alias("parent"), link(F.col("k") + 1).alias("child"), axis.alias("axis"), (-F.col("reach") * turned).alias("lower"), (F.col("reach") * turned).alias("upper"))
    links = s.select(F.explode(F.array(link(F.col("k")), link(F.col("k") + 1))).alias("name")).distinct()
    folder = _folder(spark)
    description.write(joints, links, folder)
    return description.joints(spark, f"{folder}/joints"), description.links(spark, f"{folder}/links")


def arm_of_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joints that move, counted from the base, as an arm is written and loaded."""
    folder = _folder(spark)
    description.write_arm(description.arm(*_robot(spark, sf_dir, False)), folder)
    return description.read_arm(spark, folder)


def description_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving joints without an axis, joints of unknown kind, and limits the wrong way round, whatever the kind."""
    return description.faults(*_robot(spark, sf_dir, True))


# Parts by name, tables of a dataset, files in order.


def datasets_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every exporter that is registered, read by the source of the same name: rows of each episode."""
    s, out = base.by_day(spark, sf_dir), []
    for name in EXPORTERS.names():
        folder = _folder(spark)
        EXPORTERS.make(name, s, folder, None, BUDGET)
        out.append(SOURCES.make(name, spark, folder).groupBy("episode_id").agg(F.count("*").alias("n"), F.min("timestamp_ns").alias("first_ns")).withColumn("kind", F.lit(name)))
    return reduce(DataFrame.unionByName, out)


def dataset_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tasks of a frame dataset, numbered as they first occur in its episodes."""
    folder = _folder(spark)
    episodes.export_frames(base.by_day(spark, sf_dir), folder, budget=BUDGET)
    return commits.read(spark, folder, "tasks")


def directory_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of samples read in the order of their names, and rows as they stand there."""
    folder = _folder(spark)
    base.samples(spark, sf_dir).select("episode_id", "timestamp_ns", "value", "seq").repartitionByRange("seq").sortWithinPartitions("seq").drop("seq").write.parquet(folder)
    return episodes.read_directory(spark, folder).drop("file_name")


def states_with_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joint states from rows of text that name their stamp in either way, or not at all."""
    s, text = base.samples(spark, sf_dir), lambda c: F.expr(c).cast("string")
    fields = {"node_id": "seq % 256", "chain_index": "chain_index", "angle_raw_adc": "1", "angle_millideg": "2", "angle_rad": "value", "status_flags": "0", "checksum_valid": "true", "schema_version": "1"}
    rows = s.select(*[text(c).alias(k) for k, c in fields.items()], F.when(F.col("seq") % 3 == 0, text("timestamp_ns")).alias("header_stamp_ns"), F.when(F.col("seq") % 3 <= 1, (F.col("timestamp_ns") + 7).cast("string")).alias("header_stamp"))
    return episodes.states_of(rows, stamped=True).select("node_id", "chain_index", "angle_rad", "checksum_valid", "header_stamp_ns")


# Streams.


def _spoilt_capture(spark: SparkSession, sf_dir: str) -> str:
    """A capture in which some lines are no records, of another version, too short, or have a wrong checksum."""
    s = base.samples(spark, sf_dir)
    data = codec.encode((F.col("seq") % 65536).cast("int"), (F.col("seq") % 60000 - 30000).cast("int"), (F.col("episode_id") % 256).cast("int"), F.col("chain_index"), (F.col("seq") % 64).cast("int"))
    broken = F.concat(F.substring(data, 1, 14), F.lpad(F.lower(F.hex((codec.byte_at(data, 7).bitwiseXOR(255)).cast("long"))), 2, "0"))
    k = F.col("seq")
    text = F.when(k % 17 == 0, F.substring(data, 1, 14)).when(k % 13 == 0, broken).otherwise(data)
    line = F.to_json(F.struct(F.when(k % 19 == 0, 2).otherwise(1).alias("v"), F.col("timestamp_ns").alias("t_ns"), codec.can_id((F.col("episode_id") % 256).cast("int")).alias("id"), text.alias("data")))
    folder = _folder(spark)
    s.select(F.when(k % 11 == 0, "noise").otherwise(line).alias("value")).write.text(folder)
    return folder


def stream_fault_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a spoilt capture, read as a stream, by what is wrong with them."""
    lines = SOURCES.make("stream", spark, _spoilt_capture(spark, sf_dir))
    return fault_counts(stateful.run_available(lines, base.stream_folder(spark)))


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of each chain of a stream."""
    s = base.samples_stream(spark, sf_dir).select("episode_id", "chain_index", "seq", "event_type", "value")
    return stateful.latest_available(s, ["episode_id", "chain_index"], base.stream_folder(spark))


_STREAMS = f"""tag AS (
    SELECT episode_id, CASE chain_index WHEN 0 THEN 'reference' WHEN 1 THEN 'tactile' ELSE 'frames' END AS modality, seq, timestamp_ns FROM bu
    UNION ALL SELECT episode_id, 'events', seq, timestamp_ns FROM bu WHERE chain_index = 1 AND tactile_event IS NOT NULL
), rec AS (
    SELECT *, CASE WHEN coalesce(timestamp_ns <= max(timestamp_ns) OVER (PARTITION BY episode_id, modality ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN NULL ELSE timestamp_ns END AS norm FROM tag
), cl AS (SELECT episode_id, modality, norm AS ns FROM rec WHERE norm IS NOT NULL),
rf AS (SELECT episode_id, ns FROM cl WHERE modality = 'reference'), tg AS (SELECT * FROM cl WHERE modality IN ('tactile', 'frames')), {sql.nearest('rf', 'tg', SKEW)},
win AS (SELECT e.episode_id, e.ns AS ref_ns, f.ns AS hit FROM cl e LEFT JOIN cl f ON f.episode_id = e.episode_id AND f.modality = 'frames' AND abs(f.ns - e.ns) <= {NEAR} WHERE e.modality = 'events'),
res AS (SELECT episode_id, modality, quality = 'matched' AS hit FROM al UNION ALL SELECT episode_id, 'events', hit IS NOT NULL FROM win),
tm AS (
    SELECT coalesce(a.episode_id, b.episode_id) AS episode_id, coalesce(clean, 0) AS clean, coalesce(flagged, 0) AS flagged, coalesce(matched, 0) AS matched, coalesce(n, 0) AS n
    FROM (SELECT episode_id, modality, count(norm) AS clean, count(*) - count(norm) AS flagged FROM rec GROUP BY 1, 2) a
    FULL JOIN (SELECT episode_id, modality, count(*) FILTER (hit) AS matched, count(*) AS n FROM res GROUP BY 1, 2) b ON a.episode_id = b.episode_id AND a.modality = b.modality
), tot AS (
    SELECT episode_id, CAST(sum(clean + flagged) AS BIGINT) AS total_records, CAST(sum(flagged) AS BIGINT) AS flagged, CAST(sum(n) AS BIGINT) AS total_results, CAST(sum(n - matched) AS BIGINT) AS non_matched,
        max(CASE WHEN clean = 0 OR (n > 0 AND matched = 0) THEN 2 WHEN flagged > 0 OR n > matched THEN 1 ELSE 0 END) AS worst FROM tm GROUP BY 1
), {sql.jitter('ev', 6.0)},
g AS (SELECT episode_id, NOT (n_samples < 3 OR backwards > 0 OR dropouts > 0 OR p99_jitter_ns > {48 * HOUR}) AS gate_passed FROM jit),
o AS (SELECT episode_id, abs(offset_ns) AS off, row_number() OVER (PARTITION BY episode_id ORDER BY abs(offset_ns)) AS r, count(*) OVER (PARTITION BY episode_id) AS n FROM al WHERE offset_ns IS NOT NULL),
p AS (SELECT episode_id, max(off) AS max_abs_offset_ns, sum(off)::DOUBLE / count(*) AS mean_abs_offset_ns, min(off) FILTER (r >= ceil(0.95 * n)) AS p95_abs_offset_ns, min(off) FILTER (r >= ceil(0.99 * n)) AS p99_abs_offset_ns FROM o GROUP BY 1),
e AS (SELECT episode_id, count(*) AS events_total FROM bu WHERE chain_index = 1 AND tactile_event IS NOT NULL GROUP BY 1),
h AS (SELECT episode_id, count(DISTINCT ref_ns) AS events_matched FROM win WHERE hit IS NOT NULL GROUP BY 1),
rep AS (
    SELECT tot.episode_id, total_records, flagged AS violations, flagged, total_results, non_matched, max_abs_offset_ns, mean_abs_offset_ns, p95_abs_offset_ns, p99_abs_offset_ns, gate_passed,
        CASE WHEN NOT gate_passed OR worst = 2 THEN 'quarantined' WHEN worst = 1 THEN 'degraded' ELSE 'aligned_within_budget' END AS verdict,
        coalesce(events_total, 0) AS events_total, coalesce(events_matched, 0) AS events_matched, CASE WHEN events_total > 0 THEN coalesce(events_matched, 0) / events_total END AS event_accuracy
    FROM tot JOIN g ON g.episode_id = tot.episode_id LEFT JOIN p ON p.episode_id = tot.episode_id LEFT JOIN e ON e.episode_id = tot.episode_id LEFT JOIN h ON h.episode_id = tot.episode_id
)"""
_, _VERDICTS, _VIOLATIONS, _FLAGGED, _MOST, _P99, _LEAST = LIMITS[0]
_SCRIPT = """sc AS (
    SELECT episode_id, idx AS phase_ix, CASE WHEN seq % 37 = 0 THEN 'hop' ELSE coalesce(tactile_event, 'settle') END AS kind, idx * 0.5::DOUBLE + CASE WHEN seq % 29 = 0 THEN 0.25::DOUBLE ELSE 0 END AS start_s, CASE WHEN seq % 31 = 0 THEN 0.0::DOUBLE ELSE 0.5 END AS duration_s FROM st
)"""
_GOOD = f"di AS (SELECT episode_id, timestamp_ns, min(seq) AS seq FROM bd GROUP BY 1, 2), {sql.jitter('di', 6.0)}, own AS (SELECT bd.* FROM bd JOIN jit ON jit.episode_id = bd.episode_id WHERE backwards = 0 AND dropouts = 0)"

QUERIES = {
    f.__name__: f
    for f in (
        bench_episode_streams, bench_table, bench_survival, phase_script_faults, phase_round_trip, stamp_order, checked_results, arm_of_description, description_faults, datasets_by_name, dataset_tasks, directory_order, states_with_stamps, stream_fault_counts, stream_latest,
    )
}
SQL = {
    "bench_episode_streams": f"WITH {base.BURST}, {_STREAMS} SELECT * FROM rep",
    "bench_table": f"""WITH {base.BURST}, {_STREAMS}, b AS (SELECT *, concat_ws(',', CASE WHEN NOT list_contains({_VERDICTS}, verdict) THEN 'verdict:' || verdict END, CASE WHEN violations > {_VIOLATIONS} THEN 'violations:' || violations END, CASE WHEN flagged > {_FLAGGED} THEN 'flagged:' || flagged END,
    CASE WHEN max_abs_offset_ns > {_MOST} THEN 'max_abs_offset_ns:' || max_abs_offset_ns END, CASE WHEN p99_abs_offset_ns > {_P99} THEN 'p99_abs_offset_ns:' || p99_abs_offset_ns END, CASE WHEN event_accuracy < {_LEAST} THEN 'event_accuracy' END) AS failures FROM rep)
SELECT row_number() OVER (ORDER BY episode_id) + 1 AS number, '| ' || concat_ws(' | ', 'streams', episode_id, verdict, violations, flagged || '/' || total_records, non_matched || '/' || total_results, coalesce(max_abs_offset_ns::VARCHAR, '-'), coalesce(p95_abs_offset_ns::VARCHAR, '-'), coalesce(p99_abs_offset_ns::VARCHAR, '-'),
    events_matched || '/' || events_total, 'yes', 'ok', CASE WHEN failures = '' THEN '-' ELSE failures END) || ' |' AS text FROM b
UNION ALL SELECT 0, '| {" | ".join(bench.TABLE)} |' UNION ALL SELECT 1, '|{"---|" * len(bench.TABLE)}'""",
    "bench_survival": f"""WITH {base.BURST}, s AS (SELECT st.*, bu.timestamp_ns AS late_ns, (st.idx + 1) % 5 <> 0 AS there, unnest(list_filter([['proprio', 'tactile', 'frames'][st.chain_index + 1], CASE WHEN st.chain_index = 1 AND st.tactile_event IS NOT NULL THEN 'events' END], lambda x: x IS NOT NULL)) AS stream FROM st JOIN bu ON st.episode_id = bu.episode_id AND st.idx = bu.idx),
n AS (SELECT *, there AND NOT coalesce(late_ns <= max(CASE WHEN there THEN late_ns END) OVER (PARTITION BY episode_id, stream ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS fine FROM s)
SELECT episode_id, stream, count(*) AS given, count(*) FILTER (there) AS delivered, count(*) FILTER (fine) AS surviving FROM n GROUP BY 1, 2""",
    "phase_script_faults": f"""WITH {base.STAMPS}, {_SCRIPT}, w AS (SELECT *, coalesce(lag(start_s + duration_s) OVER o, 0.0) AS want, sum(CASE kind WHEN 'contact_start' THEN 1 WHEN 'release' THEN -1 ELSE 0 END) OVER (o ROWS UNBOUNDED PRECEDING) AS open, lead(phase_ix) OVER o IS NULL AS last FROM sc WINDOW o AS (PARTITION BY episode_id ORDER BY phase_ix)),
f AS (SELECT episode_id, phase_ix, CASE WHEN kind = 'hop' THEN 'unknown_kind' WHEN duration_s <= 0 THEN 'no_duration' WHEN abs(start_s - want) > 1e-9 THEN 'not_tiled' WHEN open NOT IN (0, 1) THEN 'unbalanced' WHEN kind IN ('slip', 'impact') AND open <> 1 THEN 'outside_grasp' WHEN last AND open <> 0 THEN 'not_released' END AS fault FROM w)
SELECT * FROM f WHERE fault IS NOT NULL""",
    "phase_round_trip": f"WITH {base.STAMPS}, {_SCRIPT} SELECT * FROM sc WHERE kind <> 'hop' AND duration_s > 0",
    "stamp_order": f"WITH {base.BURST} SELECT seq, timestamp_ns AS ns, lag(timestamp_ns) OVER (PARTITION BY episode_id ORDER BY seq) < timestamp_ns AS later FROM bu",
    "checked_results": f"WITH {base.STREAMS}, {sql.nearest('refs', 'tgts', NEAR)} SELECT episode_id, quality, method, count(*) AS n, CAST(sum(offset_ns) AS BIGINT) AS offset_ns, count(*) FILTER (tie) / count(*) AS tied FROM al GROUP BY 1, 2, 3",
    "arm_of_description": "SELECT CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS INTEGER) AS chain_index, s_name AS name, CASE s_suppkey % 3 WHEN 2 THEN 'prismatic' ELSE 'revolute' END AS kind, -(abs(s_acctbal) + 1) AS lower, abs(s_acctbal) + 1 AS upper FROM supplier WHERE s_suppkey % 3 <> 1",
    "description_faults": """SELECT s_name AS name, 'unknown_kind' AS fault FROM supplier WHERE s_suppkey % 10 = 7 UNION ALL SELECT s_name, 'bad_axis' FROM supplier WHERE s_suppkey % 10 = 5 AND s_suppkey % 3 <> 1
UNION ALL SELECT s_name, 'limits_crossed' FROM supplier WHERE s_suppkey % 10 = 3""",
    "datasets_by_name": f"WITH {base.BY_DAY}, {_GOOD} SELECT kind, episode_id, count(*) AS n, min(timestamp_ns) AS first_ns FROM own, (VALUES ('rows'), ('frames')) k(kind) GROUP BY 1, 2",
    "dataset_tasks": f"WITH {base.BY_DAY}, {_GOOD}, e AS (SELECT episode_id, min(seq) AS first, min_by(task_label, seq) AS task FROM own GROUP BY 1) SELECT row_number() OVER (ORDER BY min(first)) - 1 AS task_index, task AS task_label FROM e WHERE task <> '' GROUP BY 2",
    "directory_order": f"WITH {base.SAMPLES} SELECT episode_id, timestamp_ns, value, row_number() OVER (ORDER BY seq) - 1 AS seq FROM ev",
    "states_with_stamps": f"WITH {base.SAMPLES} SELECT CAST(seq % 256 AS INTEGER) AS node_id, chain_index, value AS angle_rad, true AS checksum_valid, CASE seq % 3 WHEN 0 THEN timestamp_ns WHEN 1 THEN timestamp_ns + 7 ELSE 0 END AS header_stamp_ns FROM ev",
    "stream_fault_counts": f"WITH {base.SAMPLES} SELECT CASE WHEN seq % 11 = 0 THEN 'not_a_record' WHEN seq % 19 = 0 THEN 'unknown_version' WHEN seq % 17 = 0 THEN 'not_8_bytes' WHEN seq % 13 = 0 THEN 'checksum_invalid' END AS fault, count(*) AS n FROM ev GROUP BY 1",
    "stream_latest": f"WITH {base.SAMPLES} SELECT episode_id, chain_index, max(seq) AS seq, max_by(event_type, seq) AS event_type, max_by(value, seq) AS value FROM ev GROUP BY 1, 2",
}
