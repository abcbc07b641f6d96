"""Exact top-k search over 64-bit codes by incremental multi-index hashing (operator 5).

A code is cut into segments, and every shard indexes its codes by the value of each segment.  A search probes the
segments' values within a growing radius, one segment after the other.  Once segments 0 to a have been probed to radius
r and the others to r - 1, every code within Hamming distance ``segments * r + a`` has been met; the search of a query
ends when the distance of its kth verified code is at most that.  Verified means that the distance of the whole codes
has been computed, so the result is exact.

Equal codes are one index entry with the ``k + 1`` least ids, all that a result can need of them; equal queries are
searched once.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import cut_lineage
from tickloom.llm.shards import meet, number_of_shards, rank_least

BITS, SEGMENTS, K = 64, 4, 10
PER_SHARD, PER_BLOCK = 16_384, 256


def sign_code(vector: Column) -> Column:
    """The signs of the components as a 64-bit code; null for null vectors and vectors with null or non-finite components.

    Vectors of more than 64 components are an error.
    """
    bit = lambda x, i: F.when(x > 0, F.expr("1L")).otherwise(F.expr("0L"))
    bits = F.transform(vector, lambda x, i: F.call_function("shiftleft", bit(x, i), F.pmod(i, F.lit(BITS))))
    valid = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    fits = F.when(F.size(vector) > BITS, F.raise_error(F.lit(f"vectors of more than {BITS} components have no code"))).otherwise(F.lit(True))
    return F.when(vector.isNotNull() & fits & valid, F.aggregate(bits, F.expr("0L"), lambda a, b: a.bitwiseOR(b)))


@lru_cache(maxsize=None)
def masks(width: int, radius: int) -> np.ndarray:
    """All values of ``width`` bits with ``radius`` ones."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], dtype=np.int64)


class MultiIndex:
    """Codes of one shard by the value of each of their segments."""

    def __init__(self, codes: np.ndarray, segments: int = SEGMENTS):
        self.codes, self.segments, self.width = codes, segments, BITS // segments
        parts = [(codes >> np.uint64(self.width * s)).astype(np.int64) & ((1 << self.width) - 1) for s in range(segments)]
        self.order = [np.argsort(p, kind="stable") for p in parts]
        self.offsets = [np.concatenate([[0], np.cumsum(np.bincount(p, minlength=1 << self.width))]) for p in parts]

    def search(self, queries: np.ndarray, k: int, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``query, entry, distance``: the ``k`` nearest entries of every query (all, if fewer); ties to less ``tie``."""
        n, k = len(queries), min(k, len(self.codes))
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        active = np.arange(n)
        if not k:
            return found
        for radius in range(self.width + 1):
            for s in range(self.segments):
                part = (queries[active] >> np.uint64(self.width * s)).astype(np.int64) & ((1 << self.width) - 1)
                for flips in np.array_split(masks(self.width, radius), -(-len(masks(self.width, radius)) * len(active) // 500_000)):
                    probes = (part[:, None] ^ flips[None, :]).ravel()
                    first, count = self.offsets[s][probes], self.offsets[s][probes + 1] - self.offsets[s][probes]
                    hit = np.flatnonzero(count)
                    count = count[hit]
                    total = int(count.sum())
                    if total:
                        at = np.repeat(first[hit] - (np.cumsum(count) - count), count) + np.arange(total)
                        entry = self.order[s][at]
                        query = np.repeat(active[hit // len(flips)], count)
                        found = self._keep(found, query, entry, queries, k, tie)
                covered = self.segments * radius + s
                held = np.bincount(found[0], minlength=n)
                worst = np.zeros(n, np.int64)
                np.maximum.at(worst, found[0], found[2])
                active = active[(held[active] < k) | (worst[active] > covered)]
                if not len(active):
                    return found
        return found

    def _keep(self, found, query, entry, queries, k, tie):
        distance = np.bitwise_count(queries[query] ^ self.codes[entry]).astype(np.int64)
        q, e, d = (np.concatenate(x) for x in zip(found, (query, entry, distance), strict=True))
        order = np.lexsort((tie[e], d, q))
        q, e, d = q[order], e[order], d[order]
        new = np.concatenate([[True], (q[1:] != q[:-1]) | (e[1:] != e[:-1])])  # met by several segments
        q, e, d = q[new], e[new], d[new]
        begin = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        rank = np.arange(len(q)) - np.repeat(begin, np.diff(np.append(begin, len(q))))
        keep = rank < k
        return q[keep], e[keep], d[keep]


def nearest(codes: DataFrame, queries: DataFrame, k: int = K, per_shard: int = PER_SHARD, per_block: int = PER_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, distance``: of every row of ``queries`` (``id, code``) the ``k`` rows of ``codes``
    (``id, code``) with the least Hamming distance, but for rows with the query's own id; nearest first, ties to the
    lesser id.

    Rows with a null id or code take no part; repeated rows of an id count once; fewer than ``k`` other rows are all
    returned; an empty table gives no rows.
    """
    codes = cut_lineage(codes.where("id is not null and code is not null").distinct())
    queries = cut_lineage(queries.where("id is not null and code is not null").distinct())
    entries = cut_lineage(rank_least(codes, "code", "id", k + 1))
    asked = queries.select("code").distinct()
    shards = number_of_shards(entries.count(), per_shard)
    blocks = number_of_shards(asked.count(), per_block)
    points = F.struct("code", F.col("least")[0].alias("first"))

    def search(points, asked):
        code, tie = (points.field(k).to_numpy(zero_copy_only=False) for k in ("code", "first"))
        index = MultiIndex(code.view(np.uint64))
        for block in asked:
            q = block.to_numpy(zero_copy_only=False)
            query, entry, distance = index.search(q.view(np.uint64), k + 1, tie)
            yield pa.RecordBatch.from_arrays([pa.array(q[query]), pa.array(code[entry]), pa.array(distance.astype(np.int32))], schema=columns)

    columns = pa.schema([("asked", pa.int64()), ("code", pa.int64()), ("distance", pa.int32())])
    points = F.struct("code", F.col("least")[0].alias("first"))
    near = meet(entries, asked, shards, blocks, points, F.col("code"), F.xxhash64("code"), F.xxhash64("code"), search, "asked long, code long, distance int", columns)
    near = near.withColumnRenamed("code", "near").join(entries.withColumnRenamed("code", "near"), "near")
    best = Window.partitionBy("asked").orderBy("distance", "first")
    near = near.withColumn("first", F.col("least")[0]).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    # Of each asked code: ids in order of distance and id, at most (k + 1)^2 of them before the cut.
    listed = near.select("asked", F.explode(F.transform("least", lambda i: F.struct("distance", i.alias("id")))).alias("r")).groupBy("asked").agg(F.slice(F.array_sort(F.collect_list("r")), 1, k + 1).alias("listed"))
    own = queries.join(listed, F.col("code") == F.col("asked")).select("id", F.slice(F.filter("listed", lambda r: r["id"] != F.col("id")), 1, k).alias("listed"))
    return own.select(F.col("id").alias("query_id"), F.posexplode("listed").alias("pos", "r")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("r.id").alias("vec_id"), F.col("r.distance").alias("distance"))


def op5(vectors: DataFrame, every: int = 50, k: int = K) -> DataFrame:
    """Top-k of the rows whose id is divisible by ``every``, by the signs of their components."""
    codes = vectors.select(vectors["vec_id"].cast("long").alias("id"), sign_code(vectors["embedding"]).alias("code"))
    return nearest(codes, codes.where(F.col("id") % every == 0), k)


#: Brute force over all rows.
ORACLE_SQL = """
WITH codes AS (
    SELECT vec_id, list_sum(list_transform(range(1, 65), lambda i:
        CASE WHEN embedding[i] > 0 THEN (1::HUGEINT << (i - 1)) ELSE 0::HUGEINT END)) AS code
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(bit_count(CAST(xor(q.code, c.code) AS HUGEINT)) AS INTEGER) AS distance
    FROM codes q JOIN codes c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank, vec_id, distance
    FROM pairs
)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10
"""
