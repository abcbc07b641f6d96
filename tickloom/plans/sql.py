"""Parts of SQL that several oracles share."""

from __future__ import annotations


def jitter(source: str, gap_factor: float = 2.5) -> str:
    """Common table expressions that end in ``jit``, the interval statistics of the rows of ``source``."""
    return f"""ivs AS (
    SELECT episode_id, timestamp_ns - lag(timestamp_ns) OVER (PARTITION BY episode_id ORDER BY seq) AS dt FROM {source}
), rk AS (
    SELECT episode_id, dt, row_number() OVER (PARTITION BY episode_id ORDER BY dt) AS r, count(*) OVER (PARTITION BY episode_id) AS n FROM ivs WHERE dt IS NOT NULL
), med AS (
    SELECT episode_id, (min(dt) FILTER (r >= (n + 1) // 2) + min(dt) FILTER (r >= n // 2 + 1)) // 2 AS period_ns FROM rk GROUP BY episode_id
), offs AS (
    SELECT rk.episode_id, dt, period_ns, n, abs(dt - period_ns) AS off, row_number() OVER (PARTITION BY rk.episode_id ORDER BY abs(dt - period_ns)) AS r FROM rk JOIN med ON rk.episode_id = med.episode_id
), agg AS (
    SELECT episode_id, any_value(period_ns) AS period_ns, max(off) AS max_jitter_ns, min(off) FILTER (r >= least(greatest(round_even(0.99 * n, 0), 1), n)) AS p99_jitter_ns,
        count(*) FILTER (dt <= 0) AS backwards, count(*) FILTER (period_ns > 0 AND dt > period_ns * CAST({gap_factor} AS DOUBLE)) AS dropouts, count(*) AS n_intervals
    FROM offs GROUP BY episode_id
), jit AS (
    SELECT s.episode_id, s.n_samples, coalesce(period_ns, 0) AS period_ns, coalesce(max_jitter_ns, 0) AS max_jitter_ns, coalesce(p99_jitter_ns, 0) AS p99_jitter_ns,
        coalesce(backwards, 0) AS backwards, coalesce(dropouts, 0) AS dropouts, coalesce(n_intervals, 0) AS n_intervals
    FROM (SELECT episode_id, count(*) AS n_samples FROM {source} GROUP BY episode_id) s LEFT JOIN agg ON s.episode_id = agg.episode_id
)"""


def nearest(refs: str, targets: str, max_skew_ns: int) -> str:
    """Common table expressions that end in ``al``: nearest alignment by comparing all pairs."""
    return f"""kinds AS (SELECT DISTINCT modality FROM {targets}),
rowed AS (SELECT episode_id, ns, row_number() OVER () AS rid FROM {refs}),
pairs AS (
    SELECT r.rid, r.episode_id, k.modality, r.ns AS ref_ns, t.ns AS t_ns FROM rowed r CROSS JOIN kinds k
    LEFT JOIN (SELECT DISTINCT episode_id, modality, ns FROM {targets}) t ON t.episode_id = r.episode_id AND t.modality = k.modality
), best AS (
    SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY rid, modality, abs(t_ns - ref_ns)) AS equal FROM pairs WINDOW w AS (PARTITION BY rid, modality ORDER BY abs(t_ns - ref_ns), t_ns)
), al AS (
    SELECT episode_id, modality, ref_ns,
        CASE WHEN abs(t_ns - ref_ns) <= {max_skew_ns} THEN t_ns END AS matched_ns,
        CASE WHEN abs(t_ns - ref_ns) <= {max_skew_ns} THEN t_ns - ref_ns END AS offset_ns,
        CASE WHEN t_ns = ref_ns THEN 'exact' ELSE 'nearest' END AS method,
        coalesce(abs(t_ns - ref_ns) <= {max_skew_ns}, false) AS within_budget,
        CASE WHEN t_ns IS NULL THEN 'no_target' WHEN abs(t_ns - ref_ns) <= {max_skew_ns} THEN 'matched' ELSE 'out_of_budget' END AS quality,
        coalesce(abs(t_ns - ref_ns) <= {max_skew_ns} AND equal > 1, false) AS tie
    FROM best WHERE rn = 1
)"""


def contact(readings: str, onset: float, release: float) -> str:
    """Common table expressions that end in ``con``: a Schmitt trigger over ``readings`` (``episode_id, seq,
    timestamp_ns, level``)."""
    return f"""cd AS (
    SELECT *, CASE WHEN level >= {onset} AND level <= {release} THEN 2 WHEN level >= {onset} THEN 1 WHEN level <= {release} THEN 0 END AS code
    FROM {readings} WHERE level IS NOT NULL AND NOT isnan(level)
), sp AS (
    SELECT *, count(*) FILTER (code < 2) OVER (PARTITION BY episode_id ORDER BY seq) AS span FROM cd
), stt AS (
    SELECT *, (coalesce(max(CASE WHEN code < 2 THEN code END) OVER (PARTITION BY episode_id, span), 0) + count(*) FILTER (code = 2) OVER (PARTITION BY episode_id, span ORDER BY seq)) % 2 AS state FROM sp
), ch AS (
    SELECT *, coalesce(lag(state) OVER (PARTITION BY episode_id ORDER BY seq), 0) AS was FROM stt
), con AS (
    SELECT episode_id, seq, timestamp_ns AS t_ns, CASE WHEN state = 1 THEN 'contact_start' ELSE 'contact_release' END AS kind, level FROM ch WHERE state <> was
)"""
