import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import topk, vptree


@pytest.mark.parametrize("segments,k", [(4, 1), (4, 10), (8, 5)])
def test_multi_index_is_exact(segments, k):
    r = np.random.default_rng(3)
    centres = r.integers(0, 1 << 63, 20, dtype=np.uint64)
    codes = np.unique(np.concatenate([r.integers(0, 1 << 63, 1500, dtype=np.uint64), *[centres ^ (np.uint64(1) << np.uint64(b)) for b in range(12)]]))
    queries = np.concatenate([centres, r.integers(0, 1 << 63, 10, dtype=np.uint64)])
    tie = r.permutation(len(codes))
    q, e, d = topk.MultiIndex(codes, segments).search(queries, k, tie)
    for i, x in enumerate(queries):
        dist = np.bitwise_count(x ^ codes).astype(int)
        want = np.lexsort((tie, dist))[:k]
        assert e[q == i].tolist() == want.tolist() and d[q == i].tolist() == dist[want].tolist()


def test_nearest_with_copies_ties_and_shards(spark):
    r = np.random.default_rng(5)
    code = r.integers(-(1 << 63), 1 << 63, 300)
    code[:120] = code[0]
    code[120:130] = code[0] ^ 1
    rows = [(i, int(c)) for i, c in enumerate(code)] + [(500, None), (None, 3), (7, int(code[7]))]
    codes = spark.createDataFrame(rows, "id long, code long").repartition(3)
    got = {}
    for x in topk.nearest(codes, codes.where(F.col("id") % 30 == 0), 9, per_shard=40, per_block=2).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["distance"]))
    u = code.view(np.uint64)
    for i in range(0, 300, 30):
        d = np.bitwise_count(u[i] ^ u).astype(int)
        want = [(int(d[j]), j) for j in range(300) if j != i]
        assert sorted(got[i]) == [(n + 1, j, x) for n, (x, j) in enumerate(sorted(want)[:9])]
    assert set(got) == set(range(0, 300, 30))
    assert topk.nearest(codes.limit(0), codes.limit(0)).count() == 0
    few = topk.nearest(codes.where("id < 4"), codes.where("id = 0"), 9)
    assert few.count() == 3


def test_sign_codes(spark):
    rows = [([0.5, -1.0, 2.0],), (None,), ([float("nan")],), ([None, 1.0],), ([],), ([-1.0] * 63 + [1.0],), ([1.0] * 64,)]
    got = [r[0] for r in spark.createDataFrame(rows, "v array<float>").select(topk.sign_code(F.col("v"))).collect()]
    assert got == [5, None, None, None, 0, -(1 << 63), -1]
    with pytest.raises(Exception, match="more than 64 components"):
        spark.createDataFrame([([1.0] * 65,)], "v array<float>").select(topk.sign_code(F.col("v"))).collect()


def table(seed=0, n=900, d=16):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)) + 2 * r.normal(size=(12, d))[r.integers(0, 12, n)]
    x = x.astype(np.float32).astype(float)
    x[:40] = x[0]
    return x


def test_factor_one_is_exact():
    x = table()
    t = vptree.VantagePointTree(x, 20)
    got, _ = t.search(x[::30], 7, 1.0)
    for q, row in zip(x[::30], got, strict=True):
        s = x @ q
        assert np.allclose(np.sort(s)[-7:], np.sort(s[row]))


def test_nearest_vectors_with_copies_and_bad_rows(spark):
    x = table()
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [None] * 16), (2080, [float("inf")] + [0.0] * 15), (None, [1.0] * 16), (2100, [1.0, 2.0]), (2101, [3.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    out = vptree.nearest(df, per_shard=300, per_block=10).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 900, 20)) | {2100}
    assert got[2100] == [(2101, 5.0)]
    hits = 0
    for i in range(0, 900, 20):
        score = vptree.ordered_products(np.repeat(x[i : i + 1], 900, 0), x)
        want = sorted((-score[j], j) for j in range(900) if j != i)[:20]
        assert all(s == score[j] for j, s in got[i]) and len(got[i]) == 20
        assert [(-s, j) for j, s in got[i]] == sorted((-s, j) for j, s in got[i])
        hits += len({j for j, _ in got[i]} & {j for _, j in want})
    assert hits / (45 * 20) >= 0.9
    assert vptree.nearest(df.limit(0)).count() == 0


def test_recall_at_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    out = vptree.nearest(df, per_shard=400).collect()
    rows = df.select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    got = {}
    for r in out:
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for k in np.flatnonzero(ids % 20 == 0):
        s = x @ x[k]
        s[k] = -np.inf
        recall.append(len(got[ids[k]] & set(ids[np.argsort(-s)[:20]])) / 20)
    assert np.mean(recall) >= 0.9


@pytest.mark.parametrize("kind", ["plain", "clusters", "norms"])
def test_recall_of_pruning_trees_at_the_shard_size_of_the_query(kind):
    """Four shards of as many rows as the query's, whose leaves are a thirtieth of them."""
    r, n = np.random.default_rng(7), vptree.PER_SHARD
    x = r.normal(size=(4 * n, 64))
    if kind != "plain":
        x = r.normal(size=(40, 64))[r.integers(40, size=4 * n)] + 0.4 * x
    if kind == "norms":
        x *= np.exp(0.7 * r.normal(size=(4 * n, 1)))
    q = x[r.integers(4 * n, size=100)]
    scores = q @ x.T
    want = np.argsort(-scores, 1)[:, :20]
    exact, found = [], []
    for at in range(0, 4 * n, n):
        tree = vptree.VantagePointTree(x[at : at + n])
        assert isinstance(tree.root, tuple)
        found.append(at + tree.search(q, 20)[0])
        exact.append(at + tree.search(q, 20, 1.0)[0])
    for shards, least in ((found, 0.95), (exact, 1.0)):
        rows = np.concatenate(shards, 1)
        best = np.take_along_axis(rows, np.argsort(-np.take_along_axis(scores, rows, 1), 1)[:, :20], 1)
        assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(best, want)]) >= least


def test_two_runs_agree_whatever_the_order_of_arrival(spark, monkeypatch):
    r = np.random.default_rng(8)
    monkeypatch.setattr(vptree.VantagePointTree.__init__, "__defaults__", (8,))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(r.normal(size=(600, 12)))], "vec_id long, embedding array<double>")
    a, b = (sorted(map(tuple, vptree.nearest(d, factor=6.0, per_shard=200, per_block=7).collect())) for d in (df.repartition(2), df.orderBy(F.rand(3)).repartition(7)))
    assert a == b and len(a) == 600
