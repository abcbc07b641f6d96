import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
import regex

from tickloom.llm import resample

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(docs, target, share=10, least=20, widest=1, buckets=10_000):
    def buckets_of(text):
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, widest + 1) for i in range(len(words) - n + 1)], len(words)

    s, t = [0] * buckets, [0] * buckets
    for texts, h in (([d[1] for d in docs], s), (target, t)):
        for x in texts:
            for b in buckets_of(x)[0]:
                h[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, text, *_ in docs:
        found, words = buckets_of(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: share * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def corpus(n=250, seed=0):
    r = random.Random(seed)
    pool = ["".join(r.choice("abcdeéÉZ09ß") for _ in range(r.randint(1, 7))) for _ in range(300)]
    docs = [(i, r.choice([" ", ", ", "\n"]).join(r.choice(pool) for _ in range(r.randint(0, 90))), "x") for i in range(n)]
    docs += [(None, "Aa bb " * 30, "x"), (1000, None, "x"), (1001, "", "x"), (1002, "!? ..", "x"), (1003, "long " * 60_000 + " Ünder", "x"), (5, docs[5][1], "x"), (5, docs[5][1], "x")]
    return docs, [" ".join(r.choice(pool[:40]) for _ in range(50)) for _ in range(8)] + [None, ""]


def tables(spark, docs, target):
    return spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(5), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")


@pytest.mark.parametrize("widest", [1, 3])
def test_equals_a_plain_computation(spark, widest):
    docs, target = corpus()
    got = resample.resample(*tables(spark, docs, target), widest=widest)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs, target, widest=widest)


def test_equals_the_sql(spark):
    docs, target = corpus(seed=3)
    d, t = tables(spark, docs, target)
    db = duckdb.connect()
    documents, benchmark = d.toPandas().astype({"doc_id": "Int64"}), t.toPandas()  # noqa: F841
    assert sorted(db.sql(resample.ORACLE_SQL).fetchall(), key=str) == sorted((tuple(r) for r in resample.resample(d, t).collect()), key=str)


def test_shares_bounds_and_empty_tables(spark):
    docs, target = corpus(60)
    d, t = tables(spark, docs, target)
    for share, least in ((0, 20), (100, 1), (33, 40)):
        assert sorted((tuple(r) for r in resample.resample(d, t, share, least).collect()), key=str) == plain(docs, target, share, least)
    assert resample.resample(d.limit(0), t).count() == 0
    assert sorted((tuple(r) for r in resample.resample(d, t.limit(0)).collect()), key=str) == plain(docs, [])


def test_words_are_those_of_the_pattern_and_chunks_cost_none(monkeypatch):
    r = random.Random(2)
    text = "".join(r.choice("abZÉé 0\x7f\x80'\n,[z{\U0001d518") for _ in range(5000))
    one = resample.Features(2)
    whole = one.buckets(text)
    assert [w for w, _ in one.split.pre_tokenize_str(resample.lowered(text))] == WORD.findall(resample.lowered(text))
    for size in (1, 10, 333):
        monkeypatch.setattr(resample, "CHUNK", size)
        assert sorted(one.buckets(text)[0]) == sorted(whole[0]) and one.buckets(text)[1] == whole[1]


def test_gains_round_down_and_are_nothing_for_equal_shares():
    assert resample.gains([3, 1], [3, 1]).tolist() == [0, 0]
    assert resample.gains([9, 0], [0, 9]).tolist() == [math.floor(1000 * math.log(0.1)), math.floor(1000 * math.log(10))]
    assert resample.gains([0] * 4, [0] * 4).dtype == np.int64
