import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tickloom.llm import bpe, packing

LIBRARY = Tokenizer.from_file(bpe.default_path())
PIECES = [*"abethin  \n\t'sr1290.,!?éß漢😀", "<|endoftext|>", "'ll", " the", "\n\n", "aaaa", "!!!!", "ing", "''", " ", " ", "²", "ǅ"]


def texts(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, 40))) for _ in range(n)]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_automaton_equals_the_library():
    a = bpe.automaton(bpe.default_path())
    for t in [*texts(1, 3000), "x" * 5000, "-" * 3000, ""]:
        ids = np.frombuffer(a.encode(t), "<u4").tolist()
        assert ids == ids_of(t), t
        assert a.decode(a.encode(t)) == LIBRARY.decode(ids, skip_special_tokens=False).encode()


def test_each_word_has_one_path():
    """Among all ways to cut a word into vocabulary entries exactly one is a path of the automaton."""
    a = bpe.automaton(bpe.default_path())

    tokens = {a.labels[i]: i for i in a.into}

    def paths(data, state):
        if not data:
            yield []
        for n in range(1, len(data) + 1):
            t = tokens.get(data[:n])
            if t is not None and a.arc(state, t) >= 0:
                for rest in paths(data[n:], a.into[t]):
                    yield [t, *rest]

    for word in (b"thinker", b" aaaaaaa", b"\xc3\xa9t\xc3\xa9", b" estiin"):
        assert list(paths(word, 0)) == [a.encode_word(word)]


def test_every_entry_of_the_vocabulary_is_its_own_path_and_words_equal_the_library():
    a = bpe.automaton(bpe.default_path())
    assert all(a.encode_word(a.labels[i]) == [i] for i in a.into)
    words = [x for x in (a.labels[i].decode("utf-8", "ignore") for i in a.into) if x]
    words += [x + y for x, y in zip(words[::7], words[3::7], strict=False)]
    for w, e in zip(words, LIBRARY.encode_batch(words, add_special_tokens=False), strict=True):
        assert np.frombuffer(a.encode(w), "<u4").tolist() == e.ids, w


LONG = ["\n" * 1_000_000, " " * 2_000_000, "x" * 300_000, "-" * 300_000, "a \n" * 100_000]


def test_very_long_runs_encode_as_the_library_does():
    encode, a = packing._encoder(bpe.default_path()), bpe.automaton(bpe.default_path())
    for t in LONG:
        want = ids_of(t)
        assert encode(t).tolist() == want and np.frombuffer(a.encode(t), "<u4").tolist() == want


def test_packing_ids_equal_the_library():
    r = random.Random(6)
    prose = [r.choice(["", " "]) + "".join(r.choice(["Word", "it's", "a", "1st", "x,y", "(b)", "é", "\n", "z.\nNew", "\0", "\u00a0", "\u2003"]) + r.choice([" "] * 30 + ["  ", " \n", "\n ", "\t"]) for _ in range(r.randint(1, 30))).rstrip(r.choice(["", " "])) for _ in range(3000)]
    some = [*texts(5, 1500), *prose, None, "", "<|endoftext|>", "a<|endoftext|> b"]
    for _ in range(2):
        assert [packing._encoder(bpe.default_path())(t).tolist() for t in some] == [ids_of(t) for t in some]


def test_round_trip_query_equals_the_library(spark):
    rows = [(i, t) for i, t in enumerate(texts(2, 300))] + [(900, None), (901, ""), (5, "again"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens").repartition(3)
    got = sorted(bpe.round_trip(docs).collect(), key=str)
    want = []
    for i, t in rows:
        ids = ids_of(t)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_encoded_documents_decode(spark):
    docs = spark.createDataFrame([(1, "Hello there.\nYou"), (2, None)], "doc_id long, text string")
    out = {r["doc_id"]: r["ids"] for r in bpe.encode_documents(docs).collect()}
    assert np.frombuffer(out[1], "<u4").tolist() == ids_of("Hello there.\nYou") and out[2] == b""


def check_places(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= capacity
    return len(places)


def test_packing_is_whole_gapless_and_tight(spark):
    r = random.Random(4)
    rows = [(i, "word " * r.choice([0, 1, 3, 50, 200, 300, 500, 900, 1500, 4000])) for i in range(400)] + [(1000, None), (1001, ""), (3, "same id"), (1002, "x <|endoftext|> y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'a' as piece", "0 as offset").repartition(4)
    out = packing.pack_documents(docs.where("doc_id is not null")).collect()
    n = check_places(out, 1024)
    total = sum(x["length"] for x in out)
    assert n <= 1.05 * -(-total // 1024) + 1
    by = {}
    for x in out:
        by.setdefault(x["doc_id"], []).append(x)
    for i, t in rows:
        if i == 3:
            continue
        ids = np.array([*ids_of(t), 2], "<u4")
        pieces = sorted(by[i], key=lambda x: x["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        at = 0
        for p in pieces:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids) and all(p["length"] == 1024 for p in pieces[1:])


def test_no_documents_no_sequences(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_length_once(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 30, 100])
    counts = {s: r.choice([0, 1, 2, 7, 100]) for s in range(1, capacity + 1)}
    runs, n_bins = packing.plan(counts, capacity)
    used, placed = {}, {s: [] for s in counts}
    for size, first, n, at, each, offset in runs:
        for k in range(n):
            placed[size].append(first + k)
            used.setdefault(at + k // each, []).append((offset + k % each * size, size))
    assert all(sorted(placed[s]) == list(range(counts[s])) for s in counts)
    large = [[n for _, n in spans if 3 * n > capacity] for spans in used.values()]
    assert max(map(len, large), default=0) <= 2
    for spans in used.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= capacity
    assert len(used) == n_bins <= 1.3 * sum(s * n for s, n in counts.items()) / capacity + 2


def test_cut_points():
    assert packing.cut_points(5, 10) == [(0, 5)]
    assert packing.cut_points(10, 10) == [(0, 10)]
    assert packing.cut_points(25, 10) == [(0, 5), (5, 10), (15, 10)]
