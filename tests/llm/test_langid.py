import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import langid

SYLLABLES = {"aa": ["ka", "lo", "mi", "the", "sun"], "bb": ["ße", "zu", "lich", "ung", "mi"], "cc": ["ñe", "los", "ción", "ka", "ue"]}


def corpus(n=400, seed=0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang = r.choice(["aa", "aa", "bb", "cc"])
        text = " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(2, 120)))
        out.append((i, text + (" 123!! " if i % 3 else ""), lang, "x"))
    return out


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(3)


def plain_grams(text):
    """The folding and the n-grams, character by character."""
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
    x = f" {' '.join(low.split())} " if low.strip() else ""
    return Counter(x[i : i + n] for n in langid.ORDERS for i in range(len(x) - n + 1) if n > 1 or x[i] != " ")


@pytest.mark.parametrize("text", ["Hello, Wörld!  42 x", "ÀÉ İß 日本 ab\U0001d518c", "a", "", "1234 !!", " a  b "])
def test_grams_are_those_of_a_plain_count(text):
    which, count = langid.grams(text)
    want = plain_grams(text)
    assert count.sum() == sum(want.values())
    if len(which) == len(want):  # no two n-grams share a bucket
        assert sorted(count) == sorted(want.values())


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = " ".join(t for _, t, _, _ in corpus(30))
    whole = langid.grams(text)
    for size in (7, 64, 1001):
        monkeypatch.setattr(langid, "CHUNK", size)
        for a, b in zip(whole, langid.grams(text), strict=True):
            assert np.array_equal(a, b)


def test_the_leader_takes_the_published_steps():
    """Against the update written out for one coordinate at a time."""
    r = np.random.default_rng(1)
    model = langid.Leader(6, 3, 0.7, 1.0, 0.3, 0.2)
    z, n = np.zeros((7, 3)), np.zeros((7, 3))
    for _ in range(60):
        which = np.sort(r.choice(6, 3, replace=False))
        v, y = r.normal(size=3), int(r.integers(3))
        model.learn(which, v, y)
        w = {}
        for j in [*which, 6]:
            for c in range(3):
                l1, l2 = (0.3, 0.2) if j < 6 else (0.0, 0.0)
                w[j, c] = 0.0 if abs(z[j, c]) <= l1 else -(z[j, c] - math.copysign(l1, z[j, c])) / ((1 + math.sqrt(n[j, c])) / 0.7 + l2)
        x = {**dict(zip(which, v)), 6: 1.0}
        e = [math.exp(sum(x[j] * w[j, c] for j in x)) for c in range(3)]
        for j in x:
            for c in range(3):
                g = (e[c] / sum(e) - (c == y)) * x[j]
                s = (math.sqrt(n[j, c] + g * g) - math.sqrt(n[j, c])) / 0.7
                z[j, c] += g - s * w[j, c]
                n[j, c] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_penalties_leave_coordinates_at_zero():
    rows = [(t, lang) for _, t, lang, _ in corpus(300)]
    df = np.zeros(langid.BUCKETS, np.int64)
    for t, _ in rows:
        df[langid.grams(t)[0]] += 1
    model = langid.train(rows, df, len(rows))
    assert 0 < len(model.rows) < (df > 0).sum() and (model.rows == 0).any()


def test_the_temperature_undoes_a_scale():
    r = np.random.default_rng(0)
    true = r.normal(size=(20_000, 4))
    y = np.array([r.choice(4, p=p) for p in langid.softmax(true)])
    for scale in (0.3, 1.0, 5.0):
        assert langid.temperature(true * scale, y) == pytest.approx(scale, rel=0.1)


def test_document_frequencies_are_those_of_all_documents(spark):
    rows = corpus(200)
    df, n = langid.document_frequencies(langid.learnable(docs_of(spark, rows)))
    learn = [t for i, t, _, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    want = np.zeros(langid.BUCKETS, np.int64)
    for t in learn:
        want[langid.grams(t)[0]] += 1
    assert n == len(learn) and np.array_equal(df, want)


def test_held_out_documents_are_told_and_never_learnt_from(spark):
    rows = corpus()
    out = {r["doc_id"]: r for r in langid.classify(docs_of(spark, rows)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert all(out[r[0]]["held_out"] == (r in held) and 0 <= out[r[0]]["score"] <= 1 for r in rows)
    assert np.mean([out[r[0]]["lang_pred"] == r[2] for r in held]) > 0.97
    turned = [(i, t, "zz" if (i, t, lang, s) in held else lang, "other") for i, t, lang, s in rows]
    assert {r["doc_id"]: r for r in langid.classify(docs_of(spark, turned).repartition(7)).collect()} == out


def test_the_sample_is_bounded_and_even(spark, monkeypatch):
    monkeypatch.setattr(langid, "PER_SAMPLE", 60)
    monkeypatch.setattr(langid, "LEAST", 5)
    got = langid.sample(langid.learnable(docs_of(spark, corpus(900))))
    assert Counter(lang for _, lang in got) == {"aa": 20, "bb": 20, "cc": 20}
    again = langid.sample(langid.learnable(docs_of(spark, corpus(900)).repartition(5)))
    assert got == again
    monkeypatch.setattr(langid.labelled, "SAMPLE_CHARS", 6000)
    few = langid.sample(langid.learnable(docs_of(spark, corpus(900))))
    assert 3 <= len(few) < 60 and {t for t, _ in few} <= {t for _, t, _, _ in corpus(900)}


def test_odd_rows(spark):
    rows = corpus(200) + [(None, "ka lo mi", "aa", "x"), (900, None, "aa", "x"), (901, "", None, "x"), (902, "12 !?", "bb", "x"), (903, "lichung " * 60_000, None, "x"), (7, "kalo", "cc", "x"), (7, "kalo", "aa", "x")]
    out = langid.classify(docs_of(spark, rows))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(rows)
    assert [got[i]["lang_pred"] for i in (900, 901, 902, 903)] == ["und", "und", "und", "bb"] and got[900]["score"] == 0
    assert langid.classify(docs_of(spark, rows).limit(0)).count() == 0
    none = langid.classify(docs_of(spark, [(i, t, None, s) for i, t, _, s in rows])).collect()
    assert len(none) == len(rows) and {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
    one = langid.classify(docs_of(spark, [(i, t, "aa", s) for i, t, _, s in rows])).collect()
    assert {r["lang_pred"] for r in one} == {"aa", "und"}
