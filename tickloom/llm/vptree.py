"""Approximate nearest neighbours by vantage-point trees, one for each shard (operator 7).

The largest inner product is the least Euclidean distance once every point of a shard gets one more coordinate,
``sqrt(M^2 - |x|^2)`` with ``M`` the largest norm of the shard, and queries a zero there.  A tree node has a vantage point
and the median distance ``mu`` of its points to it.  With ``d`` the distance of a query to the vantage point and ``t`` that
of its kth candidate, the triangle inequality lets the search skip the other side of ``mu`` if ``|d - mu| > t``; this
search skips it if ``|d - mu| > t / factor``.  Factor 1 is exact; a larger one prunes more and may miss neighbours.  At
shards of ``PER_SHARD`` rows of 64 components, factor 2 loses nothing where norms are alike but finds only 0.62 of the
neighbours where they vary tenfold; the factor used finds 0.98 or more in both.

All queries of a block walk a tree together.  Every vector is indexed.  Equal vectors are one point with their ``k + 1``
least ids.  Scores are inner products of the original vectors, summed in order in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import cut_lineage
from tickloom.llm.shards import meet, number_of_shards, rank_least

K, FACTOR = 20, 1.25
PER_SHARD, PER_BLOCK, LEAF = 16_384, 256, 512


class VantagePointTree:
    """A tree over the rows of ``points``, searched for the largest inner products."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        square = (points * points).sum(1)
        self.top = square.max() if len(points) else 0.0
        self.full = np.c_[points, np.sqrt(np.maximum(self.top - square, 0))]
        self.leaf = leaf
        self.root = self._build(np.arange(len(points)), np.random.default_rng(0))

    def _build(self, rows: np.ndarray, r: np.random.Generator):
        if len(rows) <= self.leaf:
            return rows
        vantage = rows[r.integers(len(rows))]
        rest = rows[rows != vantage]
        d = np.sqrt(((self.full[rest] - self.full[vantage]) ** 2).sum(1))
        mu = float(np.median(d))
        inner, outer = rest[d <= mu], rest[d > mu]
        if not len(outer) or not len(inner):
            return rows  # all at one distance
        return vantage, mu, self._build(inner, r), self._build(outer, r)

    def search(self, queries: np.ndarray, k: int, factor: float = FACTOR) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances of the ``k`` nearest found of every query; missing ones are -1 at infinity."""
        q = np.c_[queries, np.zeros(len(queries))]
        rows, dist = np.full((len(q), k), -1, np.int64), np.full((len(q), k), np.inf)
        norms, mine = (self.full * self.full).sum(1), (q * q).sum(1)

        def offer(active: np.ndarray, points: np.ndarray) -> np.ndarray:
            d = np.sqrt(np.maximum(mine[active, None] + norms[points] - 2 * (q[active] @ self.full[points].T), 0))
            nearer = d < dist[active, -1][:, None]
            better = np.flatnonzero(nearer.any(1))
            if len(better):
                some = active[better]
                # Only as many columns as the query with most new candidates has.
                width = int(nearer[better].sum(1).max())
                new_d, new_r = d[better], np.broadcast_to(points, (len(some), len(points)))
                if width < len(points):
                    at = np.argpartition(new_d, width - 1, 1)[:, :width]
                    new_d, new_r = np.take_along_axis(new_d, at, 1), points[at]
                all_d, all_r = np.concatenate([dist[some], new_d], 1), np.concatenate([rows[some], new_r], 1)
                order = np.argsort(all_d, 1, kind="stable")[:, :k]
                dist[some] = np.take_along_axis(all_d, order, 1)
                rows[some] = np.take_along_axis(all_r, order, 1)
            return d

        def walk(node, active: np.ndarray) -> None:
            if not len(active):
                return
            if isinstance(node, np.ndarray):
                if len(node):
                    offer(active, node)
                return
            vantage, mu, inner, outer = node
            d = offer(active, np.array([vantage]))[:, 0]
            inside = d <= mu
            walk(inner, active[inside])
            walk(outer, active[~inside])
            crosses = np.abs(d - mu) <= dist[active, -1] / factor
            walk(outer, active[inside & crosses])
            walk(inner, active[~inside & crosses])

        walk(self.root, np.arange(len(q)))
        return rows, dist


def ordered_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b``, components added from first to last."""
    out = np.zeros(len(a))
    for c in range(a.shape[1]):
        out += a[:, c] * b[:, c]
    return out


def _valid(vectors: DataFrame) -> DataFrame:
    v = F.col("vector")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(vectors["vec_id"].cast("long").alias("id"), vectors["embedding"].cast("array<double>").alias("vector")).where("id is not null and vector is not null").where(fine)


def nearest(vectors: DataFrame, every: int = 20, k: int = K, factor: float = FACTOR, per_shard: int = PER_SHARD, per_block: int = PER_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose ``vec_id`` is divisible by ``every`` the ``k`` nearest found.

    Candidates are all other rows whose vectors are as long.  Vectors that are null, zero or hold null or non-finite
    components take no part, as do rows without an id; repeated rows count once; with fewer than ``k`` candidates all
    are returned; an empty table gives no rows.
    """
    rows = cut_lineage(_valid(vectors).distinct())
    rows = rows.withColumn("same", F.sha2(F.concat_ws(",", F.col("vector").cast("array<string>")), 256))
    entries = cut_lineage(rank_least(rows, "same", "id", k + 1).join(rows.groupBy("same").agg(F.first("vector").alias("vector")), "same"))
    queries = rows.where(F.col("id") % every == 0).select("id", "same")
    asked = cut_lineage(queries.groupBy("same").agg(F.count("*").alias("n")).join(entries.select("same", "vector"), "same").select("same", "vector"))
    shards = number_of_shards(entries.count(), per_shard)
    blocks = number_of_shards(asked.count(), per_block)

    def search(points, asked):
        names, sizes = points.field("same").to_pylist(), points.field("vector").value_lengths().to_numpy()
        flat = points.field("vector").flatten().to_numpy()
        starts = np.concatenate([[0], np.cumsum(sizes)])
        own = {size: np.flatnonzero(sizes == size) for size in np.unique(sizes).tolist()}
        trees = {}
        for block in asked:
            ask_names, ask_sizes = block.field("same").to_pylist(), block.field("vector").value_lengths().to_numpy()
            ask_flat = block.field("vector").flatten().to_numpy()
            ask_starts = np.concatenate([[0], np.cumsum(ask_sizes)])
            for size in np.unique(ask_sizes).tolist():
                if size not in own:
                    continue
                if size not in trees:
                    trees[size] = VantagePointTree(flat[starts[own[size]][:, None] + np.arange(size)])
                asking = np.flatnonzero(ask_sizes == size)
                q = ask_flat[ask_starts[asking][:, None] + np.arange(size)]
                got, _ = trees[size].search(q, min(k + 1, len(own[size])), factor)
                i, j = np.nonzero(got >= 0)
                point = got[i, j]
                score = ordered_products(q[i], trees[size].points[point])
                yield pa.RecordBatch.from_arrays([pa.array([ask_names[x] for x in asking[i].tolist()], pa.string()), pa.array([names[x] for x in own[size][point].tolist()], pa.string()), pa.array(score, pa.float64())], schema=columns)

    columns = pa.schema([("asked", pa.string()), ("near", pa.string()), ("score", pa.float64())])
    row = F.struct("same", "vector", F.col("least")[0].alias("first"))
    near = meet(entries, asked, shards, blocks, row, F.struct("same", "vector"), F.xxhash64("same"), F.xxhash64("same"), search, "asked string, near string, score double", columns)
    near = near.join(entries.select(F.col("same").alias("near"), "least"), "near").withColumn("first", F.col("least")[0])
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "first")
    near = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    listed = near.select("asked", F.explode(F.transform("least", lambda i: F.struct((-F.col("score")).alias("less"), i.alias("id")))).alias("r")).groupBy("asked").agg(F.slice(F.array_sort(F.collect_list("r")), 1, k + 1).alias("listed"))
    own = queries.join(listed, F.col("same") == F.col("asked")).select("id", F.slice(F.filter("listed", lambda r: r["id"] != F.col("id")), 1, k).alias("listed"))
    return own.select(F.col("id").alias("query_id"), F.posexplode("listed").alias("pos", "r")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("r.id").alias("vec_id"), (-F.col("r.less")).alias("score"))
