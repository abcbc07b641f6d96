import random
import zlib
from collections import Counter

import duckdb
import pytest
import regex

from tickloom.llm import variants


def plain_vocabulary(docs):
    n = Counter()
    for i, text, *_ in docs:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(words):
    form, count = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w], count[w] = best if best and words[best] >= 5 * n else None, len(others)
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, count[w], words.get(form[w])))
    return out


def words_of(spark, words, parts=4):
    return spark.createDataFrame(list(words.items()) or [], "word string, n long").repartition(parts)


def random_words(seed, alphabet, n, longest=9):
    r = random.Random(seed)
    return {"".join(r.choice(alphabet) for _ in range(r.randint(2, longest))): r.choice([5, 6, 7, 30, 40, 200, 1100]) for _ in range(n)}


@pytest.mark.parametrize("seed,alphabet,n", [(1, "ab", 120), (2, "abé", 200), (3, "xyz\U0001d518", 150), (4, "a", 9)])
def test_forms_equal_a_comparison_of_all_words(spark, seed, alphabet, n):
    words = random_words(seed, alphabet, n)
    assert {tuple(r) for r in variants.forms(words_of(spark, words)).collect()} == plain_forms(words)


def test_ranges_share_their_paths(spark):
    """Every range of few words; the same prefix over many of them has one number."""
    words = random_words(5, "ab", 150) | {"aaaaaaaaaa" + "b" * k: 5 for k in range(30)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rows = variants.numbered_paths(words_of(spark, words), "word").collect()
        assert {tuple(r) for r in variants.forms(words_of(spark, words)).collect()} == plain_forms(words)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    number = {}
    for r in rows:
        assert len(r["path"]) == len(r["word"]) + 1
        for k, node in enumerate(r["path"]):
            assert number.setdefault(r["word"][:k], node) == node
    assert len(set(number.values())) == len(number)
    ordered = sorted(words)
    assert [number[w] for w in ordered] == sorted(number[w] for w in ordered)


def test_vocabulary_equals_a_plain_count(spark):
    r = random.Random(0)
    pool = ["".join(r.choice("abcÀé") for _ in range(r.randint(4, 9))) for _ in range(60)] + ["TheraPist", "ÉcolesX"]
    docs = [(i, " ".join(r.choice(pool) for _ in range(80)) + r.choice(["", "-x1", "\n"]), "other") for i in range(60)]
    docs += [(None, "nameless " * 6, "x"), (3, None, "x"), (4, "", "x"), (5, "z" * 200_000, "x"), (6, "!!! 123", "x"), (7, docs[7][1], "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string, n string").repartition(5)
    got = {r["word"]: r["n"] for r in variants.vocabulary(table).collect()}
    assert got == plain_vocabulary(docs) and got["nameless"] == 6
    assert {tuple(x) for x in variants.forms(variants.vocabulary(table)).collect()} == plain_forms(got)
    db = duckdb.connect()
    documents = table.toPandas().astype({"doc_id": "Int64"})  # noqa: F841
    assert set(db.sql(variants.ORACLE_SQL).fetchall()) == plain_forms(got)
    assert variants.vocabulary(table.limit(0)).count() == 0 and variants.forms(variants.vocabulary(table.limit(0))).count() == 0


def test_damaged_runs_lose_their_code_point(spark):
    docs = [(i, "misspelling " * 5) for i in range(2000)]
    got = {r["word"]: r["n"] for r in variants.vocabulary(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == plain_vocabulary(docs) and len(got) > 3


def test_long_words_and_chains(spark):
    words = {"b" * 3000: 5, "b" * 2999: 25, "b" * 2998: 125, "b" * 2997 + "c": 624}
    assert {tuple(r) for r in variants.forms(words_of(spark, words)).collect()} == plain_forms(words)
