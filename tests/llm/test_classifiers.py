import random
import zlib

import numpy as np
import pytest

from tickloom.llm import labelled, quality, toxicity


def prose(r, n, marked=()):
    syll = ["an", "be", "chi", "do", "el", "fro", "ga", "hu", "in", "jo"]
    out = []
    for _ in range(n):
        w = "".join(r.choice(syll) for _ in range(r.randint(1, 4)))
        out.append(w)
    for k in r.sample(range(n), max(2, n // 25)) if marked else ():  # every marked text says it
        out[k] = r.choice(marked)
    return " ".join(out)


def labelled_corpus(n=1200, seed=0):
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic, good = int(r.random() < 0.3), int(r.random() < 0.7)
        t = prose(r, r.randint(30, 300), ("wretchkin", "foulmouther", "scumbagget") if toxic else ())
        if not good:
            t = " ".join([t.split()[0]] * 40 + t.split()[:20]) if r.random() < 0.5 else t.upper().replace(" ", "!! ")
        docs.append((i, t, "x"))
        if r.random() < 0.9:
            labels.append((i, good, toxic))
    return docs, labels


def tables(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    return d.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module,target,folds,held,threshold", [(toxicity, 2, 5, 0, 0.5), (quality, 1, 4, 2, 0.7)])
def test_held_out_accuracy(spark, module, target, folds, held, threshold):
    docs, labels = labelled_corpus()
    out = {r["doc_id"]: r for r in module.classify(*tables(spark, docs, labels)).collect()}
    assert len(out) == len(docs)
    right = []
    for row in labels:
        r, crc = out[row[0]], zlib.crc32(str(row[0]).encode()) % folds
        assert r["held_out"] == (crc == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
        if r["held_out"]:
            right.append(r["predicted"] == row[target])
    assert len(right) > 100 and np.mean(right) > 0.95


@pytest.mark.parametrize("module,target", [(toxicity, "toxic"), (quality, "quality")])
def test_scores_do_not_depend_on_labels_of_the_held_out_fold_or_on_other_columns(spark, module, target):
    docs, labels = labelled_corpus(300)
    d, lab = tables(spark, docs, labels)
    held = labelled.fold(lab["doc_id"], module.FOLDS) == module.HELD
    from pyspark.sql import functions as F

    turned = lab.withColumn(target, F.when(held, 1 - F.col(target)).otherwise(F.col(target)))
    a = sorted(map(tuple, module.classify(d, lab).collect()))
    b = sorted(map(tuple, module.classify(d.withColumn("score", F.lit("other")).repartition(7), turned).collect()))
    assert a == b


@pytest.mark.parametrize("module,filtered", [(toxicity, toxicity.without_toxic), (quality, quality.without_poor)])
def test_odd_rows(spark, module, filtered):
    docs, labels = labelled_corpus(300)
    docs += [(None, "no id", "x"), (5000, None, "x"), (5001, "", "x"), (5002, "a" * 300_000, "x"), (5003, "\n\n \t", "x"), (7, "again", "x")]
    labels += [(None, 1, 1), (3, None, None), (4, 0, 1), (4, 1, 0), (9999, 1, 1)]
    d, lab = tables(spark, docs, labels)
    out = module.classify(d, lab).collect()
    assert len(out) == len(docs) and all(0 <= r["score"] <= 1 for r in out)
    score = {r["doc_id"]: r["score"] for r in out}
    assert score[5000] == score[5001]
    kept = filtered(d, lab)
    assert kept.columns == d.columns and 0 < kept.count() < len(docs)
    assert module.classify(d.limit(0), lab).count() == 0
    # Without labels, or with one label only, every score is the share of label 1.
    none = module.classify(d, lab.limit(0)).collect()
    assert len({r["score"] for r in none}) == 1
    assert filtered(d, lab.limit(0)).count() == len(docs)


def test_windows_hold_the_whole_text():
    r = random.Random(1)
    for t in (prose(r, 500), "x" * 1000, "é" * 700, " a  b ", ""):
        assert b"".join(toxicity.windows(t)) == t.lower().encode()
        assert all(len(w) <= toxicity.WINDOW for w in toxicity.windows(t))


def test_every_word_is_in_one_passage():
    x = quality.passages("one two three " * 100)
    assert len(x) == -(-300 // quality.WORDS)
    assert np.isfinite(x).all() and quality.passages(None).shape == (1, quality.N_FEATURES)


def test_the_sample_takes_whole_texts_and_fewer_of_them_if_they_are_long(spark, monkeypatch):
    docs = [(i, f"{i} " + "word " * 12_000 + f"end{i}", "x") for i in range(40)]
    d, lab = tables(spark, docs, [(i, 1, i % 2) for i in range(40)])
    whole = {(t, i % 2) for i, t, _ in docs}
    assert set(labelled.sample(d, lab, "toxic", 5, -1, False, {1: 100, 0: 100})) == whole
    monkeypatch.setattr(labelled, "SAMPLE_CHARS", 500_000)
    some = labelled.sample(d, lab, "toxic", 5, -1, False, {1: 100, 0: 100})
    assert len(some) == 10 and set(some) < whole and sum(label for _, label in some) == 5


def test_bag_scores_equal_a_plain_forward_pass_and_gradients_are_numeric_ones():
    import math

    r = np.random.default_rng(0)
    shapes = {"W": (6, 4), "b": (4,), "V": (4, 3), "U": (4, 3), "w": (3,), "c": (4,), "d": ()}
    model = quality.BagModel(np.zeros(6), np.ones(6), {k: np.array(r.normal(size=s)) for k, s in shapes.items()})
    bags = [r.normal(size=(n, 6)) for n in (1, 4, 2)]
    p, sigma = model.p, lambda v: 1 / (1 + math.exp(-v))
    want = []
    for bag in bags:
        h = [[math.tanh(sum(x[i] * p["W"][i, j] for i in range(6)) + p["b"][j]) for j in range(4)] for x in bag]
        e = [math.exp(sum(p["w"][g] * math.tanh(sum(v[j] * p["V"][j, g] for j in range(4))) * sigma(sum(v[j] * p["U"][j, g] for j in range(4))) for g in range(3))) for v in h]
        want.append(sigma(sum(w / sum(e) * sum(v[j] * p["c"][j] for j in range(4)) for w, v in zip(e, h, strict=True)) + p["d"]))
    assert model.score(bags) == pytest.approx(want)
    x, begins, y = np.concatenate(bags), np.array([0, 1, 5]), np.array([1.0, 0.0, 1.0])

    def loss():
        f = model.forward(x, begins)["y"]
        return -np.mean(y * np.log(f) + (1 - y) * np.log(1 - f))

    for k, g in model.gradients(x, begins, y).items():
        for at in np.ndindex(p[k].shape):
            old = p[k][at].copy()
            p[k][at] = old + 1e-6
            up = loss()
            p[k][at] = old - 1e-6
            down = loss()
            p[k][at] = old
            assert np.asarray(g)[at] == pytest.approx((up - down) / 2e-6, abs=1e-6), k


def test_word_features_count_hashed_words_and_pairs():
    n = quality.HASHED
    x = quality.passages("aa bb aa bb cc")
    assert len(x) == 1 and (x[0, -2 * n : -n] ** 2).sum() == pytest.approx(1) and (x[0, -n:] ** 2).sum() == pytest.approx(4 / 5)
    assert (quality.passages("aa")[0, -n:] == 0).all()
    assert (quality.passages("x " * 64 + "y")[1] != quality.passages("x " * 64 + "z")[1]).any()


def test_toxicity_scores_equal_plain_compressions():
    """Window by window with compressors built here from the dictionaries of the model."""
    import zstandard

    docs, labels = labelled_corpus(200, 3)
    toxic = {i: t for i, _, t in labels}
    model = toxicity.train([(t, toxic[i]) for i, t, _ in docs if i in toxic], 2)
    texts = [t for _, t, _ in docs[:20]] + ["", "word"]
    params = zstandard.ZstdCompressionParameters(window_log=17, hash_log=17, chain_log=16, min_match=6, target_length=1, strategy=zstandard.STRATEGY_FAST, write_content_size=False, write_checksum=False, write_dict_id=False)
    for text, got in zip(texts, model.scorer()(texts), strict=True):
        odds = []
        for pair in model.pairs:
            filler = np.random.default_rng(0).integers(128, 255, len(pair.toxic)).astype(np.uint8).tobytes()
            size = lambda content, w: len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params).compress(w))
            saved = sorted([size(filler + pair.ordinary, w) - size(pair.toxic + pair.ordinary, w) for w in toxicity.windows(text)] or [0])
            n = len(saved)
            often = [sum(s >= k for s in saved) for k in range(1, 8)]
            x = [sum(saved) / n, saved[-1], sum(saved[-3:]) / len(saved[-3:]), np.log(n), np.log1p(len(text)), *[np.log1p(o) for o in often], *[np.sqrt(k / n) for k in often]]
            odds.append(sum((v - m) / s * w for v, m, s, w in zip(x, pair.mean, pair.scale, pair.weights, strict=False)) + pair.weights[-1])
        assert got == pytest.approx(1 / (1 + np.exp(-np.mean(odds))), abs=1e-9)
