"""All events as one episode, over many tasks; and whole episodes out of a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.operators import align, events, meta, quality, scoring, timeline
from tickloom.plans import base, sql
from tickloom.plans.base import HOUR
from tickloom.session import shared_folder
from tickloom.sources import commits
from tickloom.streaming import carried, closed

SKEW = 2 * HOUR
#: Parts of a recording that arrive one after the other, and files of a batch.
PARTS, FILES = 3, 8
BUDGET = quality.JitterBudget(p99_ns=240 * HOUR, gap_factor=12.0, min_samples=3)


def _one(df: DataFrame) -> DataFrame:
    return df.withColumn("episode_id", F.lit(0).cast("long"))


def long_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps of all users in their order of arrival, every 17th late, on one timeline."""
    s = _one(base.samples(spark, sf_dir)).withColumn("timestamp_ns", F.when(F.col("seq") % 17 == 0, F.col("timestamp_ns") + 120 * HOUR).otherwise(F.col("timestamp_ns")))
    return timeline.normalize(s, long=True).select("seq", "normalized_ns", F.concat_ws(",", "flags").alias("flags"))


def long_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trigger over all readings, whose band is collapsed so that readings in it turn it over."""
    return events.detect_contact(_one(base.samples(spark, sf_dir)), F.floor(F.col("value") / 10).cast("double"), 3.0, 3.0, long=True)


def long_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases against views and clicks of all users."""
    refs, targets = base.streams(spark, sf_dir)
    out = align.align_nearest(_one(refs.dropDuplicates(["ns"])), _one(targets), SKEW, ["click", "view"], long=True)
    return out.select("modality", "ref_ns", "matched_ns", "offset_ns", "method", "quality", "tie")


def long_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy matches of the tokens of all users, as of one dense episode."""
    e = _one(base.samples(spark, sf_dir)).where("tactile_event is not null").select("episode_id", F.col("tactile_event").alias("kind"), F.col("timestamp_ns").alias("t_ns"), F.col("seq").alias("ix"))
    out = scoring.match(e.where("ix % 2 = 0"), e.where("ix % 2 = 1"), HOUR // 12)
    return out.select("kind", "truth_ix", "found_ix", "dist")


def stream_closed_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes that arrive in three parts, each ended by a mark on its last row, through the recorder's gate.

    The parts are written one after the other and read as a stream of small batches, so every episode lies over several.
    """
    s = base.burst(spark, sf_dir).select("episode_id", "seq", "idx", "timestamp_ns", F.col("value").alias("joint_angle"))
    n = F.count("*").over(Window.partitionBy("episode_id"))
    s = s.withColumn("part", F.least(F.floor(F.col("idx") * PARTS / n), F.lit(PARTS - 1))).withColumn("ends", F.col("idx") == n - 1).drop("idx")
    folder = f"{shared_folder(spark)}/closed-{uuid.uuid4().hex}"
    s.write.parquet(f"{folder}/parts")
    given = spark.read.schema(s.schema).parquet(f"{folder}/parts")
    for k in range(PARTS):
        given.where(F.col("part") == k).drop("part").repartition(FILES, "episode_id").write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(given.drop("part").schema).option("maxFilesPerTrigger", FILES).parquet(f"{folder}/in")
    closed.record_ended(stream, f"{folder}/out", f"{folder}/state", BUDGET).awaitTermination()
    kinds = {"data": s.select("episode_id").schema, "quarantine": "episode_id long, ok boolean, reasons array<string>", "stray": s.select("episode_id").schema}
    data, refused, stray = (t if t is not None else spark.createDataFrame([], kinds[k]) for k, t in ((k, commits.read(spark, f"{folder}/out", k)) for k in kinds))
    written = data.groupBy("episode_id").agg(F.count("*").alias("written"))
    out = written.select("episode_id", F.lit(True).alias("ok"), F.lit("").alias("reasons"), "written")
    out = out.unionByName(refused.select("episode_id", "ok", F.concat_ws(",", "reasons").alias("reasons"), F.lit(0).cast("long").alias("written")))
    lost = stray.groupBy("episode_id").agg(F.count("*").alias("stray"))
    return out.join(lost, "episode_id", "left").na.fill(0, ["stray"])


# The events of all users as one episode that arrives in parts, in order; every part is a batch of the stream.


def _in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _one(base.samples(spark, sf_dir)).select("episode_id", "chain_index", "seq", "timestamp_ns", "value")
    folder = f"{shared_folder(spark)}/parts-{uuid.uuid4().hex}"
    lo, hi = s.agg(F.min("seq"), F.max("seq")).first()
    parted = s.withColumn("part", F.floor((F.col("seq") - F.lit(lo)) * PARTS / (F.lit(hi) - F.lit(lo) + 1)))
    for k in range(PARTS):
        parted.where(F.col("part") == k).drop("part").repartition(FILES).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(s.schema).option("maxFilesPerTrigger", FILES).parquet(f"{folder}/in")


def stream_long_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``long_normalize`` out of a stream."""
    s = _in_parts(spark, sf_dir).withColumn("timestamp_ns", F.when(F.col("seq") % 17 == 0, F.col("timestamp_ns") + 120 * HOUR).otherwise(F.col("timestamp_ns")))
    return carried.normalize(s, base.stream_folder(spark)).select("seq", "normalized_ns", F.concat_ws(",", "flags").alias("flags"))


def stream_long_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``long_contacts`` out of a stream."""
    readings = _in_parts(spark, sf_dir).withColumn("level", F.floor(F.col("value") / 10).cast("double"))
    return carried.contacts(readings, base.stream_folder(spark), 3.0, 3.0)


def stream_long_impacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impacts of the three chains of one episode out of a stream, without those within a minute of one that fired; stamps
    are a second for each event, in order."""
    s = _in_parts(spark, sf_dir).withColumn("timestamp_ns", F.col("seq") * 1_000_000_000)
    return carried.impacts(s, base.stream_folder(spark), 60.0, 60 * 1_000_000_000)


# Summaries with histograms: one modality each by nearest stamp and by window, and one never aligned.


def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, targets = base.streams(spark, sf_dir)
    late = targets.withColumn("timestamp_ns", F.when(F.col("seq") % 11 == 0, F.col("ns") + 120 * HOUR).otherwise(F.col("ns"))).drop("ns")
    own = timeline.normalize(late, by=("episode_id", "modality"))
    reference = timeline.normalize(refs.select("episode_id", F.lit("purchase").alias("modality"), "seq", F.col("ns").alias("timestamp_ns")), "source", by=("episode_id", "modality"))
    clean = own.where("normalized_ns is not null").select("episode_id", "modality", F.col("normalized_ns").alias("ns"))
    near = align.align_nearest(refs, clean.where("modality = 'view'"), SKEW, ["view"])
    results = near.unionByName(align.align_window(refs, clean.where("modality = 'click'"), SKEW, ["click"]))
    records = own.drop("value").unionByName(reference.select(*own.drop("value").columns))
    return meta.summary(records, results)


def _flat(c: str) -> F.Column:
    return F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",").alias(c)


def timing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _summaries(spark, sf_dir)
    return s.select(*[_flat(c) if c.endswith("_counts") else F.col(c) for c in s.columns])


def _spoil(s: DataFrame) -> DataFrame:
    """Every kind of fault, each in the episodes of one remainder; one remainder stays as it is."""
    k, c = F.col("episode_id") % 17, F.col
    put = lambda m, t, n: F.map_concat(F.map_filter(m, lambda x, _: x != t), F.create_map(F.lit(t), F.lit(n).cast("long")))
    none = F.map_filter("flag_counts", lambda x, n: F.lit(False))
    return s.withColumns(
        {
            "clean": F.when(k == 1, -1).when(k == 2, 0).otherwise(c("clean")), "flagged": F.when(k == 2, 0).when(k == 3, c("flagged") + 100_000).otherwise(c("flagged")),
            "flag_counts": F.when(k == 2, none).when(k == 4, put("flag_counts", "unheard_of", 1)).when(k == 5, put("flag_counts", "unknown_skew", 0)).when(k == 6, F.map_from_entries(F.reverse(F.map_entries(put(put("flag_counts", "backwards_in_source", 1), "unknown_skew", 1))))).when(k == 7, put("flag_counts", "unknown_skew", 1_000_000)).otherwise(c("flag_counts")),
            "method_counts": F.when(k == 8, put("method_counts", "window", 1_000_000)).when(k == 9, put("method_counts", "window", 1)).otherwise(c("method_counts")), "matched": F.when(k == 10, c("matched") + 1).otherwise(c("matched")),
            "offset_min_ns": F.when(k == 11, c("offset_max_ns") + 1).when(k == 12, None).when(k == 13, F.coalesce("offset_min_ns", F.lit(5))).otherwise(c("offset_min_ns")), "offset_mean_ns": F.when(k == 14, float("nan")).when(k == 15, c("offset_max_ns") + 1.0).otherwise(c("offset_mean_ns")),
            "quality_counts": F.when(k == 16, none).otherwise(c("quality_counts")),
        }
    )


def timing_summary_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faults of summaries that were spoilt in every way that is looked for."""
    return meta.summary_faults(_spoil(_summaries(spark, sf_dir)), "purchase")


_LATE17 = "ev0 AS (SELECT * REPLACE (CASE WHEN seq % 17 = 0 THEN timestamp_ns + 432000000000000 ELSE timestamp_ns END AS timestamp_ns) FROM ev)"
_BOTH = """bt AS (SELECT DISTINCT modality, ns FROM tgts), ask AS (SELECT DISTINCT ns, modality FROM refs, (VALUES ('click'), ('view')) k(modality)),
bf AS (SELECT ask.*, bt.ns AS before FROM ask ASOF LEFT JOIN bt ON ask.modality = bt.modality AND ask.ns >= bt.ns), af AS (SELECT bf.*, bt.ns AS after FROM bf ASOF LEFT JOIN bt ON bf.modality = bt.modality AND bf.ns <= bt.ns),
m AS (SELECT *, CASE WHEN after IS NULL OR ns - before <= after - ns THEN before ELSE after END AS hit FROM af)"""

_SUMMARY = f"""{base.STREAMS},
rec AS (SELECT episode_id, modality, CASE WHEN coalesce(ns <= max(ns) OVER (PARTITION BY episode_id, modality ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN NULL ELSE ns END AS norm
    FROM (SELECT episode_id, modality, seq, CASE WHEN seq % 11 = 0 THEN ns + 432000000000000 ELSE ns END AS ns FROM tgts)),
views AS (SELECT episode_id, modality, norm AS ns FROM rec WHERE norm IS NOT NULL AND modality = 'view'), {sql.nearest('refs', 'views', SKEW)},
wi AS (SELECT r.episode_id, 'click' AS modality, r.ns AS ref_ns, c.norm - r.ns AS offset_ns, 'window' AS method, CASE WHEN c.norm IS NULL THEN 'no_target' ELSE 'matched' END AS quality
    FROM refs r LEFT JOIN rec c ON c.modality = 'click' AND c.episode_id = r.episode_id AND c.norm BETWEEN r.ns - {SKEW} AND r.ns + {SKEW}),
res AS (SELECT episode_id, modality, offset_ns, method, quality FROM al UNION ALL SELECT episode_id, modality, offset_ns, method, quality FROM wi),
back AS (SELECT episode_id, seq, coalesce(ns <= max(ns) OVER (PARTITION BY episode_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late FROM refs),
a AS (SELECT episode_id, modality, count(norm) AS clean, count(*) - count(norm) AS flagged, count(*) - count(norm) AS late, 0::BIGINT AS unknown FROM rec GROUP BY 1, 2
    UNION ALL SELECT episode_id, 'purchase', 0, count(*), count(*) FILTER (late), count(*) FROM back GROUP BY 1),
b AS (SELECT episode_id, modality, count(*) FILTER (quality = 'matched') AS matched, count(*) FILTER (quality = 'out_of_budget') AS out_of_budget, count(*) FILTER (quality = 'no_target') AS no_target, min(offset_ns) AS offset_min_ns, max(offset_ns) AS offset_max_ns,
    sum(offset_ns)::DOUBLE / count(offset_ns) AS offset_mean_ns, count(*) FILTER (method = 'exact') AS m1, count(*) FILTER (method = 'nearest') AS m2, count(*) FILTER (method = 'window') AS m3 FROM res GROUP BY 1, 2),
su AS (SELECT coalesce(a.episode_id, b.episode_id) AS episode_id, coalesce(a.modality, b.modality) AS modality, coalesce(clean, 0) AS clean, coalesce(flagged, 0) AS flagged, coalesce(matched, 0) AS matched, coalesce(out_of_budget, 0) AS out_of_budget, coalesce(no_target, 0) AS no_target,
    offset_min_ns, offset_max_ns, offset_mean_ns, coalesce(late, 0) AS late, coalesce(unknown, 0) AS unknown, coalesce(m1, 0) AS m1, coalesce(m2, 0) AS m2, coalesce(m3, 0) AS m3 FROM a FULL JOIN b ON a.episode_id = b.episode_id AND a.modality = b.modality)"""

QUERIES = {f.__name__: f for f in (long_normalize, long_contacts, long_nearest, long_matches, stream_closed_episodes, stream_long_normalize, stream_long_contacts, stream_long_impacts, timing_summary, timing_summary_faults)}
SQL = {
    "long_normalize": f"WITH {base.SAMPLES}, {_LATE17} SELECT seq, CASE WHEN NOT back THEN timestamp_ns END AS normalized_ns, CASE WHEN back THEN 'backwards_in_source' ELSE '' END AS flags FROM (SELECT *, coalesce(timestamp_ns <= max(timestamp_ns) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS back FROM ev0)",
    "long_contacts": f"WITH {base.SAMPLES}, rd AS (SELECT * REPLACE (0::BIGINT AS episode_id), floor(value / 10)::DOUBLE AS level FROM ev), {sql.contact('rd', 3.0, 3.0)} SELECT * FROM con",
    "long_nearest": f"""WITH {base.STREAMS}, {_BOTH} SELECT modality, ns AS ref_ns, CASE WHEN abs(hit - ns) <= {SKEW} THEN hit END AS matched_ns, CASE WHEN abs(hit - ns) <= {SKEW} THEN hit - ns END AS offset_ns, CASE WHEN hit = ns THEN 'exact' ELSE 'nearest' END AS method,
    CASE WHEN hit IS NULL THEN 'no_target' WHEN abs(hit - ns) <= {SKEW} THEN 'matched' ELSE 'out_of_budget' END AS quality, coalesce(abs(hit - ns) <= {SKEW} AND before <> after AND ns - before = after - ns, false) AS tie FROM m""",
    "long_matches": f"""WITH RECURSIVE {base.SAMPLES}, tr AS (SELECT tactile_event AS kind, timestamp_ns AS t_ns, seq AS ix FROM ev WHERE tactile_event IS NOT NULL AND seq % 2 = 0), fo AS (SELECT tactile_event AS kind, timestamp_ns AS t_ns, seq AS ix FROM ev WHERE tactile_event IS NOT NULL AND seq % 2 = 1),
e AS (SELECT t.kind, t.t_ns, ix FROM (SELECT * FROM tr UNION ALL SELECT * FROM fo) t),
cl AS (SELECT kind, t_ns, ix, sum(far) OVER (PARTITION BY kind ORDER BY t_ns, ix) AS cluster FROM (SELECT *, CASE WHEN t_ns - lag(t_ns) OVER (PARTITION BY kind ORDER BY t_ns, ix) <= {HOUR // 12} THEN 0 ELSE 1 END AS far FROM e)),
pr AS (SELECT t.kind, c.cluster, t.ix AS truth_ix, f.ix AS found_ix, abs(t.t_ns - f.t_ns) AS dist, row_number() OVER (PARTITION BY t.kind, c.cluster ORDER BY abs(t.t_ns - f.t_ns), t.t_ns, t.ix, f.t_ns, f.ix) AS k
    FROM tr t JOIN cl c ON c.kind = t.kind AND c.ix = t.ix JOIN fo f ON f.kind = t.kind AND abs(t.t_ns - f.t_ns) <= {HOUR // 12}),
walk AS (SELECT *, true AS taken, [truth_ix] AS ts, [found_ix] AS fs FROM pr WHERE k = 1
    UNION ALL SELECT p.*, NOT (list_contains(w.ts, p.truth_ix) OR list_contains(w.fs, p.found_ix)), list_append(w.ts, CASE WHEN NOT list_contains(w.fs, p.found_ix) THEN p.truth_ix END), list_append(w.fs, CASE WHEN NOT list_contains(w.ts, p.truth_ix) THEN p.found_ix END)
    FROM walk w JOIN pr p ON p.kind = w.kind AND p.cluster = w.cluster AND p.k = w.k + 1)
SELECT kind, truth_ix, found_ix, dist FROM walk WHERE taken""",
    "stream_closed_episodes": f"""WITH {base.BURST}, {sql.jitter('bu', BUDGET.gap_factor)},
v AS (SELECT episode_id, n_samples, concat_ws(',', CASE WHEN n_samples < 3 THEN 'too_few_samples:' || n_samples END, CASE WHEN backwards > 0 THEN 'backwards:' || backwards END, CASE WHEN dropouts > 0 THEN 'dropouts:' || dropouts END, CASE WHEN p99_jitter_ns > {BUDGET.p99_ns} THEN 'p99_jitter_ns:' || p99_jitter_ns END) AS reasons FROM jit)
SELECT episode_id, reasons = '' AS ok, reasons, CASE WHEN reasons = '' THEN n_samples ELSE 0 END AS written, 0::BIGINT AS stray FROM v""",
    "timing_summary": f"""WITH {_SUMMARY} SELECT episode_id, modality, clean, flagged, matched, out_of_budget, no_target, offset_min_ns, offset_max_ns, offset_mean_ns,
    concat_ws(',', CASE WHEN late > 0 THEN 'backwards_in_source:' || late END, CASE WHEN unknown > 0 THEN 'unknown_skew:' || unknown END) AS flag_counts,
    concat_ws(',', CASE WHEN m1 > 0 THEN 'exact:' || m1 END, CASE WHEN m2 > 0 THEN 'nearest:' || m2 END, CASE WHEN m3 > 0 THEN 'window:' || m3 END) AS method_counts,
    concat_ws(',', CASE WHEN matched > 0 THEN 'matched:' || matched END, CASE WHEN no_target > 0 THEN 'no_target:' || no_target END, CASE WHEN out_of_budget > 0 THEN 'out_of_budget:' || out_of_budget END) AS quality_counts FROM su""",
    "timing_summary_faults": f"""WITH {_SUMMARY}, k AS (SELECT *, episode_id % 17 AS k, matched + out_of_budget + no_target AS n FROM su),
f AS (SELECT episode_id, modality, CASE WHEN k = 1 THEN 'negative_count' WHEN k = 2 OR clean + flagged = 0 THEN 'no_records' WHEN k = 4 THEN 'unknown_token' WHEN k = 5 THEN 'count_without_rows' WHEN k = 6 THEN 'tokens_out_of_order'
    WHEN k = 3 AND late + unknown = 0 OR k = 7 AND flagged = 0 THEN 'flags_without_records' WHEN k = 3 THEN 'too_few_flags' WHEN k = 7 THEN 'too_many_of_a_flag' WHEN k = 8 OR k = 9 AND m3 <> 1 OR k = 16 AND n > 0 THEN 'methods_and_qualities_differ'
    WHEN k = 10 THEN 'counts_and_qualities_differ' WHEN n = 0 AND modality <> 'purchase' THEN 'no_results' WHEN m3 > 0 AND m1 + m2 > 0 THEN 'window_among_others'
    WHEN matched = 0 AND k IN (13, 14) THEN 'offsets_without_matches' WHEN matched > 0 AND k = 12 THEN 'matches_without_offsets' WHEN k = 14 THEN 'mean_not_finite' WHEN matched > 0 AND k = 11 THEN 'offsets_inverted' WHEN matched > 0 AND k = 15 THEN 'mean_outside_offsets' END AS fault FROM k)
SELECT * FROM f WHERE fault IS NOT NULL""",
}
SQL |= {
    "stream_long_normalize": SQL["long_normalize"],
    "stream_long_contacts": SQL["long_contacts"],
    "stream_long_impacts": f"""WITH RECURSIVE {base.SAMPLES}, im AS (SELECT 0::BIGINT AS episode_id, chain_index, seq, seq * 1000000000 AS t_ns, 'impact' AS kind, abs(value - lag(value) OVER (PARTITION BY chain_index ORDER BY seq)) AS delta FROM ev),
num AS (SELECT *, row_number() OVER (PARTITION BY chain_index ORDER BY seq) AS k FROM im WHERE delta >= 60.0),
ahead AS (SELECT *, (SELECT min(k) FROM num n WHERE n.chain_index = m.chain_index AND n.t_ns >= m.t_ns + 60000000000) AS onward FROM num m),
walk AS (SELECT * FROM ahead WHERE k = 1 UNION ALL SELECT a.* FROM walk w JOIN ahead a ON a.chain_index = w.chain_index AND a.k = w.onward)
SELECT episode_id, chain_index, seq, t_ns, kind, delta FROM walk""",
}
