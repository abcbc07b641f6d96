import random
from collections import Counter
from math import exp, log, log1p

import numpy as np
import pytest

from tickloom.llm import minhash
from tickloom.llm.components import components


def corpus(seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    texts = [" ".join(word() for _ in range(r.randint(60, 200))) for _ in range(40)]
    out = list(texts)
    for t in texts[:20]:
        for edits in (1, 2, 3, 12):
            w = t.split()
            for _ in range(edits):
                w[r.randrange(len(w))] = word()
            out.append(" ".join(w))
    out += texts[:5] + [texts[0].upper(), "  " + texts[1].replace(" ", "\n"), "", None, " ", "one two", "One  two", "three words here"]
    return out


def brute(texts):
    """Classes by comparing all pairs of weighted sets, with plain dictionaries."""
    words = [(t or "").lower().split() for t in texts]
    sets = [Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter() for w in words]
    code = lambda s: minhash.shingles(minhash.word_hashes(" ".join(s)))[0] if s else None
    buckets = [{s: int(minhash.buckets_of(code(s))[0]) for s in c} for c in sets]
    df = Counter(b for c in buckets for b in set(c.values()))
    weigh = lambda c, b: {s: exp(round(16 * (log(n) + log(1 + log1p(len(texts) / df[b[s]]) / 10))) / 16) for s, n in c.items()}
    weights = [weigh(c, b) for c, b in zip(sets, buckets, strict=True)]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            a, b = weights[i], weights[j]
            both = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
            if words[i] == words[j] or a and b and both / (sum(a.values()) + sum(b.values()) - both) >= 0.8:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def test_classes_equal_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "fp", 1) for i, t in enumerate(texts)], "doc_id long, text string, fp string, id int").repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs).collect()}
    assert got == dict(enumerate(brute(texts)))
    assert len(set(got.values())) < len(texts) - 30


def test_pairs_inside_a_large_family_just_below_the_threshold(spark):
    r = random.Random(3)
    base = [f"w{i}" for i in range(480)]

    def edited(words, n):
        out = list(words)
        for k in r.sample(range(len(out)), n):
            out[k] = f"x{r.randrange(1 << 40)}"
        return out

    texts = [edited(base, 6) for _ in range(1000)]
    texts += [edited(t, 8) for t in texts[:150]]
    texts = [" ".join(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    log_idf = minhash.document_frequencies(docs)
    sets = [(h, minhash.weight_steps(h, c, log_idf)) for h, c in (minhash.shingles(minhash.word_hashes(t)) for t in texts)]
    draw = minhash.sampler(minhash.BANDS * minhash.ROWS)
    keys = [set(minhash.bands(draw.sample(*s), minhash.BANDS)) for s in sets]
    family = [minhash.similarity(sets[r.randrange(1000)], sets[r.randrange(1000)]) for _ in range(2000)]
    assert 0.7 < np.median(family) < 0.78
    planted = [(i, 1000 + i) for i in range(150) if keys[i] & keys[1000 + i] and 0.8 <= minhash.similarity(sets[i], sets[1000 + i]) < 0.84]
    assert len(planted) > 90
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs).collect()}
    assert len(set(got.values())) > 700
    assert [p for p in planted if got[p[0]] != got[p[1]]] == []


def test_buckets_of_many_blocks_lose_no_link(spark):
    """A family that fills many blocks: the classes are those of all pairs that share a bucket."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(260):
        w = list(base)
        for i in r.sample(range(150), r.choice([2, 3, 4])):
            w[i] = f"x{r.randrange(1 << 40)}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    log_idf = minhash.document_frequencies(docs)
    sets = [(h, minhash.weight_steps(h, c, log_idf)) for h, c in (minhash.shingles(minhash.word_hashes(t)) for t in texts)]
    draw = minhash.sampler(minhash.BANDS * minhash.ROWS)
    keys = [set(minhash.bands(draw.sample(*s), minhash.BANDS)) for s in sets]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if keys[i] & keys[j] and minhash.similarity(sets[i], sets[j]) >= 0.8:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    want = {i: find(i) for i in range(len(texts))}
    assert 5 < len(set(want.values())) < 250
    for block in (16, 512):
        assert {r["doc_id"]: r["class_id"] for r in minhash.classes(docs, block=block).collect()} == want


@pytest.mark.parametrize("n", [1, 2, 3, 9, 60])
def test_a_cell_links_what_all_pairs_link(n):
    r = np.random.default_rng(n)
    for _ in range(8):
        pool = np.unique(r.integers(0, 1 << 62, 60, dtype=np.uint64))
        sets = []
        for _ in range(n):
            h = np.sort(r.choice(pool, r.integers(40, 60), replace=False))
            sets.append((h, r.integers(0, 4, len(h))))
        start = [int(x) for x in r.integers(0, n, n)] if n > 3 else list(range(n))
        root = {c: c for c in start}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for i in range(n):
            for j in range(i):
                if minhash.similarity(sets[i], sets[j]) >= 0.6:
                    root[find(start[i])] = find(start[j])
        cell = minhash.Cell(sets, start)
        links = cell.links(0.6)
        assert all(minhash.similarity(sets[i], sets[j]) >= 0.6 for i, j in links) and len(links) < n
        assert [[a == b for a in cell.of] for b in cell.of] == [[find(x) == find(y) for x in start] for y in start]


def test_one_document_of_each_class_stays(spark):
    texts = corpus(2)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {i: texts[i] for i in set(brute(texts))}


def test_repeated_rows_null_ids_and_empty_tables(spark):
    t = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(7, t), (7, t), (None, t), (9, "other words that are not near at all to it"), (None, None)], "doc_id long, text string")
    got = Counter((r["doc_id"], r["class_id"]) for r in minhash.classes(docs).collect())
    assert got == {(7, 7): 2, (None, 7): 1, (9, 9): 1, (None, None): 1}
    assert minhash.one_of_each(docs).count() == 3
    near = t.replace("w0 ", "v0 ")
    many = docs.unionByName(spark.createDataFrame([(7, t)] * 3000 + [(None, near)] * 3000, docs.schema)).selectExpr("*", "1 as id", "2 as own", "'n' as n", "3 as `__id`")
    got = Counter((r["doc_id"], r["class_id"]) for r in minhash.classes(many).collect())
    assert got == {(7, 7): 3002, (None, 7): 3001, (9, 9): 1, (None, None): 1}
    one = minhash.one_of_each(many)
    assert one.columns == many.columns and sorted(one.select("doc_id", "n").collect(), key=str) == sorted([(7, "n"), (9, "n"), (None, "n")], key=str)
    assert minhash.classes(docs.limit(0)).count() == 0


def test_samples_agree_as_often_as_sets_are_similar():
    r = np.random.default_rng(0)
    a = np.unique(r.integers(0, 1 << 63, 400, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:300], r.integers(0, 1 << 63, 100, dtype=np.uint64)]))
    x, y = r.integers(0, 30, len(a)), r.integers(0, 30, len(b))
    want = minhash.similarity((a, x), (b, y))
    s = minhash.Sampler(4000)
    got = (s.sample(a, x) == s.sample(b, y)).mean()
    assert got == pytest.approx(want, abs=0.03)


def test_long_texts_and_short_texts():
    h, c = minhash.shingles(minhash.word_hashes("a b c"))
    assert len(h) == 1 and c.tolist() == [1]
    h, c = minhash.shingles(minhash.word_hashes("a b c d e f " * 20_000))
    assert len(h) == 6 and c.sum() == 119_996
    big = minhash.word_hashes(" ".join(map(str, range(100_000))))
    h, c = minhash.shingles(big)
    assert len(minhash.sampler(8).sample(h, np.zeros(len(h), np.int64))) == 8


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(5, 5), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
