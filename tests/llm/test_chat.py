from pyspark.sql import functions as F

from tickloom.llm import chat

M = "conv_id long, turn long, role string, text string"


def rows(df):
    return {(r["conv_id"], r["turn"]): r for r in df.collect()}


def test_replies_follow_quotations(spark):
    data = [
        (1, 0, "a", "The plan is ready. We start on Monday."),
        (1, 1, "b", "Which budget do we have? I forgot it."),
        (1, 2, "c", "On Monday, a wrote:\n> The  plan is READY. We start on Monday.\nFine with me."),
        (1, 3, "d", "> > The plan is ready. We start on Monday.\n> Fine with me.\nAnd with me."),
        (1, 4, "e", "> Which budget do we have?\nTen."),
        (1, 5, "f", "> Nobody said this.\nStill."),
        (2, 0, "a", "Fine with me."),
        (2, 1, "b", "> Which budget do we have?\nOther talk."),
    ]
    got = rows(chat.threads(spark.createDataFrame(data, M).repartition(3)))
    assert {k: r["parent_turn"] for k, r in got.items()} == {(1, 0): None, (1, 1): 0, (1, 2): 0, (1, 3): 2, (1, 4): 1, (1, 5): 4, (2, 0): None, (2, 1): 0}
    assert {k: r["depth"] for k, r in got.items()} == {(1, 0): 0, (1, 1): 1, (1, 2): 1, (1, 3): 2, (1, 4): 2, (1, 5): 3, (2, 0): 0, (2, 1): 1}
    assert got[1, 2]["text"] == "Fine with me." and got[1, 3]["text"] == "And with me."
    assert got[1, 3]["quote_levels"] == 2 and got[1, 4]["quote_levels"] == 1 and got[1, 0]["quote_levels"] == 0
    assert all(r["root_turn"] == 0 for r in got.values())


def test_order_puts_every_reply_after_its_parent(spark):
    data = [(1, i, "u", f"Message number {i}." if i % 3 else f"> Message number {i // 2}.\nReply {i}.") for i in range(1, 1300)]
    df = spark.createDataFrame(data, M)
    out = chat.formatted(df).orderBy("position").collect()
    assert [r["position"] for r in out] == list(range(1, 1300))
    place = {r["turn"]: k for k, r in enumerate(out)}
    parts = chat.conversations(df, 100).orderBy("part").collect()
    assert [r["n_messages"] for r in parts] == [100] * 12 + [99] and [r["part"] for r in parts] == list(range(13))
    assert "\n".join(r["conversation"] for r in parts) == "\n".join(r["message"] for r in out)
    assert len(place) == 1299 and all(r["parent_turn"] is None or place[r["parent_turn"]] < place[r["turn"]] for r in out)
    assert out[0]["message"].startswith("<|u|>\n")


def test_odd_rows(spark):
    data = [(1, 0, None, None), (1, 0, "a", "x"), (1, 0, "a", "x"), (None, 1, "a", "> x\ny"), (1, None, "a", "z"), (2, 5, "b", ""), (2, 9, "b", ">>>"), (3, 0, "c", "> " * 500 + "deep\n" + "long " * 20000), (4, 0, "d", "> " * 200_000 + "deep"), (4, 1, "d", "x" + " " * 200_000 + "y\n" + "> a\n>> b\n" * 20_000)]
    df = spark.createDataFrame(data, M).withColumn("depth", F.lit("clash"))
    out = chat.formatted(df).collect()
    assert len(out) == len(data)
    assert {r["quote_levels"] for r in out if r["conv_id"] == 3} == {500}
    assert sorted(r["quote_levels"] for r in out if r["conv_id"] == 4) == [2, 200_000]
    assert sorted(r["position"] for r in out if r["conv_id"] is None) == [1] and sorted(r["position"] for r in out if r["conv_id"] == 1) == [1, 2, 3, 4]
    assert [r["parent_turn"] for r in out if r["conv_id"] == 2 and r["turn"] == 9] == [5]
    assert [r["message"] for r in out if r["role"] is None] == ["<|unknown|>\n"]
    assert chat.threads(df.limit(0)).count() == 0


def test_a_whole_passage_outweighs_its_sentences(spark):
    """Both messages say both sentences; only the second says them as one paragraph."""
    data = [(1, 0, "a", "See you there. Then bye now."), (1, 1, "b", "Bye now. Well.\n\nSee you there. Bye now.\n\nMore."), (1, 2, "a", "Bye now."), (1, 3, "c", "> See you there.\n> Bye now.\nYes.")]
    assert rows(chat.threads(spark.createDataFrame(data, M)))[1, 3]["parent_turn"] == 1


def test_no_python_in_the_plan(spark):
    plan = chat.conversations(spark.createDataFrame([(1, 0, "a", "x")], M))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
