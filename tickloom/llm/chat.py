"""Conversations without quotations, ordered by reply (operator 9).

Only DataFrame functions are used.  The quote level of a line is the number of ``>`` marks before its text.  Runs of
lines of one level are passages; a passage is normalised (lower case, white space) and hashed, as a whole and sentence by
sentence, since people quote parts.  What a message quotes is joined by conversation and hash to the first earlier
message of the conversation that says it itself, as its whole text, a paragraph or a sentence; the message answers the
one that most of its shallowest quoted hashes come from, the latest of those if several do.  A message that quotes
nothing known answers the message before it.  Depth and root follow by doubling the reach of the reply links, and every
message gets its position in its conversation: a reply stands after what it answers.

Nothing gathers a conversation in one task: hashes are aggregated before they are joined, predecessors are found within
blocks of turns, links are joined by conversation and turn, positions are counted by ranges, and the conversation itself
is built in parts of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import cut_lineage
from tickloom.operators.ordered import running

MARKS = r"^\s*(>[>\s]*)"
#: A line that introduces a quotation ("On Monday, A wrote:").
INTRODUCTION = r"(?i)^\s*(on\b.*\b(wrote|writes|said)|.{0,80}\b(wrote|writes))\s*:\s*$"
#: Turns of one block, and messages of one part of a conversation.
BLOCK, PART = 512, 256
_BLANK = " \t\n\r\f"


def quote_level(line: Column) -> Column:
    """Number of quote marks at the start of a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), r"[^>]", ""))


def _lines(text: Column) -> Column:
    """Lines with their level, body and whether they introduce a quotation."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), r"\r?\n"),
        lambda x: F.struct(quote_level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("body")),
    )


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once for a row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _passages(lines: Column) -> Column:
    """Maximal runs of lines of one level, joined; each line is looked at a fixed number of times."""

    def cut(lines: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: (i == 1) | (F.get(lines, i - 1)["level"] != F.get(lines, i - 2)["level"]))
        return _let(starts, lambda at: F.transform(at, lambda i, k: passage(lines, i, F.coalesce(F.get(at, k + 1), F.size(lines) + 1))))

    def passage(lines: Column, first: Column, end: Column) -> Column:
        body = F.array_join(F.transform(F.slice(lines, first, end - first), lambda x: x["body"]), "\n")
        return F.struct(F.get(lines, first - 1)["level"].alias("level"), body.alias("body"))

    return _let(lines, cut)


def normalised(passage: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(passage), r"\s+", " "))


def _sentences(body: Column) -> Column:
    """Normalised sentences of a passage."""
    return F.transform(F.split(F.regexp_replace(normalised(body), r"([.!?…])\s+", "$1\n"), "\n"), F.trim)


def _units(body: Column, *more: Column) -> Column:
    """What of a passage is hashed: its sentences and the whole of it; arrays of further units may follow."""
    return F.array_distinct(F.filter(F.concat(_sentences(body), F.array(normalised(body)), *more), lambda s: F.length(s) > 0))


def without_quotes(text: Column) -> Column:
    """The text's own lines: no quoted lines, no lines that introduce a quotation."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: ~x.rlike(MARKS) & ~x.rlike(INTRODUCTION))
    return F.btrim(F.array_join(lines, "\n"), F.lit(_BLANK))


def threads(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, quote_levels, parent_turn, root_turn, depth`` of every message.

    ``text`` is without quotations, ``quote_levels`` the deepest level quoted; every message comes after its parent in
    the order ``(conv_id, root_turn, depth, turn)``.  Null texts stay null and quote nothing; messages without a
    conversation or a turn are roots on their own; messages that share conversation and turn are answered together and
    each answer alike as their quotations are pooled; repeated rows stay; an empty table gives no rows.
    """
    base = messages.select(messages["conv_id"], messages["turn"].cast("long").alias("turn"), messages["role"].cast("string").alias("role"), messages["text"].cast("string").alias("text"))
    placed = base.where("conv_id is not null and turn is not null")
    quoting = placed.where(F.col("text").contains(">")).select("conv_id", "turn", F.explode(_passages(_lines(F.col("text")))).alias("p")).where("p.level > 0")
    quoted = quoting.select("conv_id", "turn", F.col("p.level").alias("level"), F.explode(_units(F.col("p.body"))).alias("s")).select("conv_id", "turn", "level", F.xxhash64("s").alias("h"), F.length("s").alias("n")).distinct()
    sought = quoted.select("conv_id", "h", "n").distinct()
    # A quotation of level 2 answers what its parent quoted; the text itself was said, unquoted, further up.
    own = placed.join(sought.select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", "turn", without_quotes(F.col("text")).alias("own"))
    paragraphs = F.transform(F.split("own", r"\n\s*\n"), normalised)
    said = own.select("conv_id", "turn", F.explode(_units(F.col("own"), paragraphs)).alias("s")).select("conv_id", "turn", F.xxhash64("s").alias("h"), F.length("s").alias("n"))
    first = said.groupBy("conv_id", "h", "n").agg(F.min("turn").alias("source"))
    linked = quoted.join(first, ["conv_id", "h", "n"]).where("source < turn")
    votes = linked.groupBy("conv_id", "turn", "level", "source").agg(F.count("*").alias("votes"))
    answers = votes.groupBy("conv_id", "turn").agg(F.min(F.struct("level", (-F.col("votes")).alias("v"), (-F.col("source")).alias("s")))["s"].alias("s")).select("conv_id", "turn", (-F.col("s")).alias("quoted_turn"))

    keys = placed.select("conv_id", "turn").distinct().withColumn("block", F.floor(F.col("turn") / BLOCK))
    earlier = Window.partitionBy("conv_id").orderBy("block")
    before = keys.groupBy("conv_id", "block").agg(F.max("turn").alias("last")).withColumn("before", F.lag("last").over(earlier)).drop("last")
    inside = Window.partitionBy("conv_id", "block").orderBy("turn")
    keys = keys.withColumn("previous", F.lag("turn").over(inside)).join(before, ["conv_id", "block"]).select("conv_id", "turn", F.coalesce("previous", "before").alias("previous"))
    parents = keys.join(answers, ["conv_id", "turn"], "left").select("conv_id", "turn", F.coalesce("quoted_turn", "previous").alias("parent_turn"))

    # `up` is the furthest message known to be answered, over `depth` links; rows move until it is a root.
    root = F.col("parent_turn").isNull()
    reach = cut_lineage(parents.select("conv_id", "turn", "parent_turn", F.coalesce("parent_turn", "turn").alias("up"), F.when(root, 0).otherwise(1).cast("long").alias("depth"), (~root).alias("moves")))
    while not reach.where("moves").isEmpty():
        ahead = reach.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"))
        step = reach.where("moves").join(ahead, ["conv_id", "up"])
        step = step.select("conv_id", "turn", "parent_turn", F.col("further").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("more") > 0).alias("moves"))
        reach = cut_lineage(reach.where("not moves").unionByName(step))
    reach = reach.select("conv_id", "turn", "parent_turn", F.col("up").alias("root_turn"), "depth")
    levels = F.coalesce(F.array_max(F.transform(_lines(F.col("text")), lambda x: x["level"])), F.lit(0))
    out = base.join(reach, ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", without_quotes(F.col("text")).alias("text"), levels.cast("int").alias("quote_levels"), "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))


def formatted(messages: DataFrame) -> DataFrame:
    """``threads`` with ``position`` and ``message``.

    ``position``: the message's place in its conversation, from 1, in the order of root, depth, turn, role and text, so
    that replies follow what they answer; messages without a conversation are placed among themselves.  ``message``: role
    mark and text, ready to be joined in that order (a null role counts as unknown).
    """
    numbered = running(threads(messages), ["conv_id", "root_turn", "depth", "turn", "role", "text"], {})
    first = numbered.groupBy(F.col("conv_id").alias("conv")).agg(F.min("number").alias("first"))
    placed = numbered.join(first, F.col("conv_id").eqNullSafe(F.col("conv"))).withColumn("position", F.col("number") - F.col("first") + 1)
    mark = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"))
    return placed.drop("number", "conv", "first").withColumn("message", F.concat(mark, F.coalesce("text", F.lit(""))))


def conversations(messages: DataFrame, part: int = PART) -> DataFrame:
    """``conv_id, part, n_messages, conversation``: reply-ordered conversations without quotations.

    ``conversation`` joins messages in order of position, by line ends; a conversation of more than ``part`` messages
    has several parts, in order from 0, so none is gathered as a whole.  Rows as in ``formatted``.
    """
    cut = formatted(messages).select("conv_id", F.floor((F.col("position") - 1) / part).alias("part"), F.struct("position", "message").alias("m"))
    parts = cut.groupBy("conv_id", "part").agg(F.count("*").alias("n_messages"), F.array_sort(F.collect_list("m")).alias("m"))
    return parts.select("conv_id", "part", "n_messages", F.array_join(F.transform("m", lambda x: x["message"]), "\n").alias("conversation"))


#: The same by window and recursive SQL.
ORACLE_SQL = r"""
WITH RECURSIVE base AS (
    SELECT conv_id, turn, role, text FROM conversations
),
lines AS (
    SELECT conv_id, turn, pos, regexp_replace(line, '^\s*(>[>\s]*)', '') AS body,
        length(regexp_replace(regexp_extract(line, '^\s*(>[>\s]*)', 1), '[^>]', '', 'g')) AS level, line
    FROM (SELECT conv_id, turn, unnest(string_split_regex(coalesce(text, ''), '\r?\n')) AS line,
            generate_subscripts(string_split_regex(coalesce(text, ''), '\r?\n'), 1) AS pos FROM base)
),
marked AS (
    SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER (PARTITION BY conv_id, turn ORDER BY pos) THEN 1 ELSE 0 END AS cut FROM lines
),
numbered AS (
    SELECT *, sum(cut) OVER (PARTITION BY conv_id, turn ORDER BY pos) AS run FROM marked
),
passages AS (
    SELECT conv_id, turn, level, string_agg(body, chr(10) ORDER BY pos) AS body FROM numbered WHERE level > 0 GROUP BY conv_id, turn, run, level
),
quoted AS (
    SELECT DISTINCT conv_id, turn, level, s FROM (
        SELECT conv_id, turn, level, trim(unnest(string_split(regexp_replace(trim(regexp_replace(lower(body), '\s+', ' ', 'g')), '([.!?…])\s+', '\1' || chr(10), 'g'), chr(10)))) AS s FROM passages
        UNION ALL
        SELECT conv_id, turn, level, trim(regexp_replace(lower(body), '\s+', ' ', 'g')) FROM passages
    ) WHERE length(s) > 0
),
own AS (
    SELECT conv_id, turn, string_agg(line, chr(10) ORDER BY pos) AS body FROM lines
    WHERE level = 0 AND NOT regexp_matches(line, '(?i)^\s*(on\b.*\b(wrote|writes|said)|.{0,80}\b(wrote|writes))\s*:\s*$')
    GROUP BY conv_id, turn
),
said AS (
    SELECT conv_id, s, min(turn) AS source FROM (
        SELECT conv_id, turn, trim(unnest(string_split(regexp_replace(trim(regexp_replace(lower(body), '\s+', ' ', 'g')), '([.!?…])\s+', '\1' || chr(10), 'g'), chr(10)))) AS s FROM own
        UNION ALL
        SELECT conv_id, turn, trim(regexp_replace(lower(unnest(string_split_regex(body, '\n\s*\n'))), '\s+', ' ', 'g')) FROM own
        UNION ALL
        SELECT conv_id, turn, trim(regexp_replace(lower(body), '\s+', ' ', 'g')) FROM own
    ) WHERE length(s) > 0 GROUP BY conv_id, s
),
votes AS (
    SELECT q.conv_id, q.turn, q.level, f.source, count(*) AS votes FROM quoted q JOIN said f ON q.conv_id = f.conv_id AND q.s = f.s
    WHERE f.source < q.turn GROUP BY ALL
),
answers AS (
    SELECT conv_id, turn, source FROM votes QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, votes DESC, source DESC) = 1
),
parents AS (
    SELECT k.conv_id, k.turn, coalesce(a.source, k.previous) AS parent_turn
    FROM (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM (SELECT DISTINCT conv_id, turn FROM base)) k
    LEFT JOIN answers a ON a.conv_id = k.conv_id AND a.turn = k.turn
),
walk AS (
    SELECT conv_id, turn, turn AS root_turn, 0 AS depth FROM parents WHERE parent_turn IS NULL
    UNION ALL
    SELECT p.conv_id, p.turn, w.root_turn, w.depth + 1 FROM parents p JOIN walk w ON p.conv_id = w.conv_id AND p.parent_turn = w.turn
)
SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY root_turn, depth, turn, role, text) AS position,
    '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || text AS message
FROM (
    SELECT b.conv_id, b.turn, b.role, trim(coalesce(o.body, ''), ' ' || chr(9) || chr(10) || chr(12) || chr(13)) AS text,
        CAST(coalesce(l.level, 0) AS INTEGER) AS quote_levels, p.parent_turn, w.root_turn, CAST(w.depth AS BIGINT) AS depth
    FROM base b
    LEFT JOIN own o ON o.conv_id = b.conv_id AND o.turn = b.turn
    LEFT JOIN (SELECT conv_id, turn, max(level) AS level FROM lines GROUP BY conv_id, turn) l ON l.conv_id = b.conv_id AND l.turn = b.turn
    JOIN parents p ON p.conv_id = b.conv_id AND p.turn = b.turn
    JOIN walk w ON w.conv_id = b.conv_id AND w.turn = b.turn
)
"""

#: Parts of ``PART`` messages.
CONVERSATIONS_SQL = f"""
SELECT conv_id, CAST((position - 1) // {PART} AS BIGINT) AS part, count(*) AS n_messages, string_agg(message, chr(10) ORDER BY position) AS conversation
FROM ({ORACLE_SQL}) GROUP BY ALL
"""
