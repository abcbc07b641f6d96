"""Spelling variants by a trie-node pair dictionary (operator 12).

The nodes of the trie of all words and of the trie of all reversed words are numbered.  A word and a place in it are then
two integers, (prefix node, suffix node): with the character at the place skipped, or with nothing skipped.  Words whose
pairs agree with one character skipped on both sides differ by a replacement there; a pair with a skip that agrees with
one without is a deletion.  Equality of pairs is equality of the strings around the place, so the neighbours are exact and
need no check.

Layout: words are sorted by ranges, each range numbers its own nodes in one scan with a stack, and only the path of a
range's first word can lie in the ranges before, so a path for each range is all that is aligned between them.  The
dictionary is one shuffle of about ``2 * length + 1`` pairs a word.  A pair has at most as many entries as the alphabet
has letters and one more: no group grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import cut_lineage, prepare, small, written
from tickloom.llm.resample import CRC_TABLE_SQL, crc_sql

#: The letters of words (fixed value).
LETTERS = r"[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS, LEAST_COUNT, RATIO, DAMAGE = 6, 5, 5, 199
#: Bits of a node's number within its range.
LOCAL = 36


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """``word, n``: the words of whole texts with at least ``least_letters`` code points and ``least_count`` occurrences.

    A run whose hash with its document's id is divisible by ``damage`` loses one code point.  Null texts have no words; a
    null id is hashed as empty text; repeated rows count as often as they stand there; an empty table gives no rows.
    Columns other than ``doc_id`` and ``text`` are not read.
    """
    runs = docs.select(
        F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id"),
        F.explode(F.filter(F.regexp_extract_all(F.translate(docs["text"].cast("string"), UPPER, LOWER), F.lit(LETTERS), 0), lambda w: F.length(w) >= least_letters)).alias("run"),
    )
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    hurt = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    words = runs.select(F.when(h % damage == 0, hurt).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def numbered_paths(words: DataFrame, key: str) -> DataFrame:
    """``words`` (one row for each ``key``, a string) with ``path``, the numbers of the trie nodes of its prefixes, the root
    (0) first.  Numbers grow in the order of the first word that has the prefix."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)
    names, place = words.columns, words.columns.index(key)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        base, fresh, before, stack, first = part << LOCAL, 0, "", [0], True
        for b in small(batches):
            paths, heads = [], []
            for word in b.column(place).to_pylist():
                del stack[_shared(before, word) + 1 :]
                new = len(word) + 1 - len(stack)
                stack.extend(range(base + fresh + 1, base + fresh + new + 1))
                fresh += new
                paths.append(list(stack))
                heads.append(first)
                first, before = False, word
            n = len(paths)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(paths, pa.list_(pa.int64())), pa.array([part] * n, pa.int32()), pa.array(heads, pa.bool_())], names=[*names, "path", "part", "head"])

    dealt = written(words.repartitionByRange(key).sortWithinPartitions(key).mapInArrow(scan, f"{kinds}, path array<long>, part int, head boolean"))
    # One path for each range at most: the first word's, as far as the ranges before have it.
    ends = dealt.groupBy("part").agg(F.max(F.struct(F.col(key), F.col("path"))).alias("last"), F.max(F.when(F.col("head"), F.struct(F.col(key), F.col("path")))).alias("first")).orderBy("part").collect()
    known: dict[int, int] = {}
    for left, right in zip(ends, ends[1:]):
        n = _shared(left["last"][key], right["first"][key])
        for mine, theirs in zip(right["first"]["path"][1 : n + 1], left["last"]["path"][1 : n + 1]):
            known[mine] = known.get(theirs, theirs)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            paths = [[known.get(x, x) for x in path] for path in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(paths, pa.list_(pa.int64()))], names=[*names, "path"])

    return dealt.select(*names, "path").mapInArrow(align, f"{kinds}, path array<long>")


def pair_entries(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The dictionary's entries ``p, s, skip, first, id, n`` of ``word, n``, and ``id, word, n``.

    ``id``, the number of the node where a word ends, grows in the order of words.  ``skip``: the pair leaves out one character, and ``first`` that the one before it is another (of a run of equal
    characters only the first is taken out, so that a deletion is found once).
    """
    ahead = numbered_paths(words, "word")
    ahead = ahead.select("word", "n", F.col("path").alias("pre"), F.element_at("path", -1).alias("id"))
    behind = numbered_paths(words.select(F.reverse("word").alias("back")), "back").select(F.reverse("back").alias("word"), F.col("path").alias("suf"))
    both = ahead.join(behind, "word").withColumn("m", F.length("word")).withColumn("letters", F.regexp_extract_all("word", F.lit("(?s)."), 0))
    at = lambda name, i: F.get(F.col(name), i)

    def entry(p: Column, s: Column, skip: bool, first: Column) -> Column:
        return F.struct(p.alias("p"), s.alias("s"), F.lit(skip).alias("skip"), first.alias("first"))

    skips = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda i: entry(at("pre", i), at("suf", F.col("m") - i - 1), True, (i == 0) | (at("letters", i) != at("letters", i - 1))))
    wholes = F.transform(F.sequence(F.lit(0), F.col("m")), lambda i: entry(at("pre", i), at("suf", F.col("m") - i), False, F.lit(False)))
    return both.select("id", "n", F.explode(F.concat(skips, wholes)).alias("e")).select("e.p", "e.s", "e.skip", "e.first", "id", "n"), ahead.select("id", "word", "n")


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``word, n`` (distinct words of two letters or more).

    ``n_near`` counts the words at one inserted, deleted or replaced code point; ``form`` is the one of them with the
    largest ``n`` (ties: the smallest), if that is at least ``ratio`` times the word's own; ``root`` is where the forms
    lead.  No words give no rows.
    """
    prepare(words.sparkSession)
    entries, names = pair_entries(cut_lineage(words))
    names = cut_lineage(names)
    groups = entries.groupBy("p", "s").agg(F.collect_list(F.struct("skip", "first", "id", "n")).alias("own")).where(F.size("own") > 1)
    replaced = lambda a, b: a["skip"] & b["skip"] & (a["id"] != b["id"])
    deleted = lambda a, b: (a["first"] & ~b["skip"]) | (~a["skip"] & b["first"])
    near = F.transform(F.filter("own", lambda b: replaced(F.col("a"), b) | deleted(F.col("a"), b)), lambda b: F.struct((-b["n"]).alias("less"), b["id"].alias("id")))
    met = groups.select("own", F.explode("own").alias("a")).select(F.col("a.id").alias("id"), near.alias("near")).where(F.size("near") > 0)
    best = met.groupBy("id").agg(F.sum(F.size("near")).alias("n_near"), F.min(F.array_min("near")).alias("best"))
    known = names.join(best, "id", "left").select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(-F.col("best.less") >= F.col("n") * ratio, F.col("best.id")).alias("up"))
    known = cut_lineage(known.join(names.select(F.col("id").alias("up"), F.col("word").alias("form"), F.col("n").alias("form_n")), "up", "left"))
    # From the words without a form downwards: a word has at most as many others below it as it has near words.
    settled = known.where("up is null").select("id", F.col("word").alias("root"))
    open_, level = known.where("up is not null").select("id", "up"), settled
    while not open_.isEmpty():
        level = cut_lineage(open_.join(level.withColumnRenamed("id", "up"), "up").select("id", "root"))
        settled = settled.unionByName(level)
        open_ = cut_lineage(open_.join(level, "id", "left_anti"))
    return known.join(settled, "id").select("word", "form", "root", "n", "n_near", "form_n")


_LETTERS = f"'{UPPER}', '{LOWER}'"

#: The same in SQL: patterns with one place open, and recursion over the forms.
ORACLE_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS key FROM runs WHERE length(run) >= {LEAST_LETTERS} GROUP BY 1, 2),
hashed AS (SELECT run, n, {crc_sql("key")} AS h FROM counted, table_of),
written AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM written WHERE length(word) >= {LEAST_LETTERS} GROUP BY 1 HAVING sum(n) >= {LEAST_COUNT}),
places AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM words),
open AS (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM places),
near AS (
    SELECT x.word, y.word AS other, y.n AS m FROM open x JOIN open y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
    UNION SELECT x.word, y.word, y.n FROM open x JOIN words y ON y.word = x.a || x.b
    UNION SELECT y.word, x.word, x.n FROM open x JOIN words y ON y.word = x.a || x.b
),
best AS (SELECT word, count(*) AS n_near, arg_max(other, m) FILTER (last) AS other, max(m) AS m FROM (
    SELECT *, row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(other)) = 1 AS last FROM near) GROUP BY 1),
known AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= {RATIO} * w.n THEN b.other END AS form, CASE WHEN b.m >= {RATIO} * w.n THEN b.m END AS form_n FROM words w LEFT JOIN best b USING (word)),
walk AS (
    SELECT word, word AS root FROM known WHERE form IS NULL
    UNION ALL
    SELECT k.word, walk.root FROM known k JOIN walk ON k.form = walk.word
)
SELECT word, form, root, n, n_near, form_n FROM known JOIN walk USING (word)
"""
