import hashlib
import random

import numpy as np
import pytest

from tickloom.llm import suffix


def brute(texts, length):
    """Counts every string of the given length and removes what the repeated ones cover."""
    data = [(t or "").encode() for t in texts]
    times = {}
    for d in data:
        for s in range(len(d) - length + 1):
            times[d[s : s + length]] = times.get(d[s : s + length], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for s in range(len(d) - length + 1):
            if times[d[s : s + length]] > 1:
                gone[s : s + length] = True
        n_spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passage, texts = prose(120), []
    for i in range(n):
        kind = i % 8
        if kind == 0:
            texts.append(prose(150))
        elif kind == 1:
            texts.append(prose(r.randint(0, 30)) + " " + passage + " " + prose(r.randint(0, 60)))
        elif kind == 2:
            texts.append(passage[: r.randint(300, 450)])
        elif kind == 3 and texts:
            w = texts[0].split()
            w[r.randrange(len(w))] = "X"
            texts.append(" ".join(w))
        elif kind == 4:
            texts.append("ab " * r.randint(0, 300))
        elif kind == 5:
            texts.append("a" * r.randint(0, 900))
        elif kind == 6:
            texts.append(None if i % 3 else "")
        else:
            texts.append(texts[1])
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_suffix_sort_finds_all_repeated_starts(seed):
    r = random.Random(seed)
    pool = ["".join(r.choice("ab\0") for _ in range(r.randint(20, 60))) for _ in range(5)]
    frags = [("".join(r.choice(pool) for _ in range(3)) + "c" * r.randint(0, 30)).encode() for _ in range(40)]
    got = suffix.repeated_starts(frags, 20)
    times = {}
    for f in frags:
        for s in range(len(f) - 19):
            times[f[s : s + 20]] = times.get(f[s : s + 20], 0) + 1
    for f, g in zip(frags, got, strict=True):
        assert g.tolist() == [s for s in range(len(f) - 19) if times[f[s : s + 20]] > 1]


@pytest.mark.parametrize("crowded", [suffix.CROWDED, 2])
def test_removal_equals_brute_force(spark, crowded):
    texts = corpus(7)
    docs = spark.createDataFrame([(i, t, "k1") for i, t in enumerate(texts)], "doc_id long, text string, k1 string").repartition(3)
    out = suffix.removal_digest(docs, crowded=crowded).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out} == dict(enumerate(brute(texts, 400)))
    for r in out:
        if r["n_removed"] == 0:
            assert r["text"] == (texts[r["doc_id"]] or "")
        assert r["n_bytes"] - r["n_removed"] - 6 * r["n_spans"] <= len(r["text"].encode()) <= r["n_bytes"] - r["n_removed"]


@pytest.mark.parametrize("crowded", [suffix.CROWDED, 3])
def test_shorter_strings_and_crowded_grams(spark, crowded):
    """One passage amid many different texts, so its grams have many fragments."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    passage = " ".join(word() for _ in range(30))
    texts = [" ".join(word() for _ in range(9)) + " " + passage[k % 40 :] + " " + " ".join(word() for _ in range(9)) for k in range(60)] + corpus(8, 16)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.removal_digest(docs, 60, 16, crowded).collect()}
    assert got == dict(enumerate(brute(texts, 60)))


def test_repeated_ids_nulls_and_empty_table(spark):
    t = "word " * 20 + "x" * 500
    docs = spark.createDataFrame([(1, t), (1, t), (None, t[::-1]), (1, "short")], "doc_id long, text string")
    got = sorted((r["n_bytes"], r["n_removed"]) for r in suffix.removal_digest(docs).collect())
    want = sorted((n, m) for n, m, _, _ in brute([t, t, t[::-1], "short"], 400))
    assert got == want
    assert suffix.removal_digest(docs.limit(0)).count() == 0
    near = t[:-3] + "yyy" + "z" * 50
    many = docs.unionByName(spark.createDataFrame([(1, t)] * 2000 + [(None, near)] * 2000, docs.schema)).selectExpr("*", "1 as k1", "2 as bytes", "3 as runs", "4 as row")
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix.removal_digest(many).collect()}
    want = {(i, n, m) for i, (n, m, _, _) in zip([1, 1, None, 1, None, None], brute([t, t, t[::-1], "short", near, near], 400), strict=True)}
    assert got == want
    out = suffix.without_repeats(many)
    assert out.columns == many.columns and out.count() == 4004 and out.where("k1 = 1 and bytes = 2 and runs = 3 and row = 4").count() == 4004


def test_texts_lose_the_spans_and_keep_other_columns(spark):
    texts = corpus(3, 24)
    docs = spark.createDataFrame([(i, t, "x", i * 2) for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_chars long")
    out = {r["doc_id"]: r for r in suffix.without_repeats(docs).collect()}
    assert docs.columns == list(out[0].asDict())
    for i, (n, removed, _, sha) in enumerate(brute(texts, 400)):
        assert out[i]["lang"] == "x" and out[i]["n_chars"] == 2 * i
        if removed == 0:
            assert out[i]["text"] == (texts[i] or "")
        if removed == n:
            assert out[i]["text"] == ""


@pytest.mark.parametrize("crowded", [suffix.CROWDED, 2])
def test_repeated_passages_shorter_than_the_removed_strings(spark, crowded):
    """The removed strings are sought inside the passages; neither changes what the other would be alone."""
    texts = corpus(11) + corpus(7, 12)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = {r["doc_id"]: r for r in suffix.removal_digest(docs, crowded=crowded, passage=200).collect()}
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in out.items()} == dict(enumerate(brute(texts, 400)))
    assert {i: (r["n_passage_bytes"], r["n_passages"]) for i, r in out.items()} == {i: (b, s) for i, (_, b, s, _) in enumerate(brute(texts, 200))}


def test_query_finds_passages_of_51_words(spark, tmp_path):
    """Two documents share 51 words that are shorter than the strings of the contract, which leaves them where they are."""
    from tickloom.llm import registry

    r = random.Random(5)
    prose = lambda k: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(k))
    passage = prose(51)
    texts = [f"{prose(80)} {passage} {prose(70)}", f"{prose(40)} {passage} {prose(90)}", prose(150), None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r["doc_id"]: r for r in registry.op8_suffix_dedup(spark, str(tmp_path)).collect()}
    assert [(out[i]["n_removed"], out[i]["n_spans"]) for i in range(4)] == [(0, 0)] * 4
    assert [out[i]["n_passages"] for i in range(4)] == [1, 1, 0, 0]
    assert all(len(passage) <= out[i]["n_passage_bytes"] <= len(passage) + 6 for i in (0, 1))


def test_passages_of_repeated_ids_nulls_and_empty_table(spark):
    t = "word " * 20 + "".join(random.Random(2).choice("abcdefgh") for _ in range(500))
    docs = spark.createDataFrame([(1, t), (1, t), (None, t[::-1]), (None, t[:330] + "z" * 90), (1, "short")], "doc_id long, text string")
    got = sorted((r["n_bytes"], r["n_removed"], r["n_passage_bytes"], r["n_passages"]) for r in suffix.removal_digest(docs, passage=200).collect())
    texts = [t, t, t[::-1], t[:330] + "z" * 90, "short"]
    assert got == sorted((n, m, b, s) for (n, m, _, _), (_, b, s, _) in zip(brute(texts, 400), brute(texts, 200), strict=True))
    assert suffix.removal_digest(docs.limit(0), passage=200).count() == 0
    with pytest.raises(ValueError):
        suffix.removal_digest(docs, passage=401)
