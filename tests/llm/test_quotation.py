from pyspark.sql import functions as F

from scrivel.llm.quotation import reply_ordered

SCHEMA = "conv_id long, turn int, role string, text string"


def ordered(spark, rows):
    return reply_ordered(spark.createDataFrame(rows, SCHEMA)).collect()


def test_a_thread_out_of_nested_quotations(spark):
    rows = [
        (1, 0, "a", "Shall we meet on Monday?\nOr later?"),
        (1, 1, "b", "The weather is fine."),
        (1, 2, "c", "> Shall  we MEET on monday?\n> Or later?\n\nMonday is good."),
        (1, 3, "a", ">> shall we meet on Monday?\n>> or later?\n> Monday is good.\nAt noon then."),
        (1, 4, "b", "Yes.\n> the weather is fine.\nIt rains now."),
        (1, 5, "d", "> nobody said this\nHello."),
        (1, 6, "c", "> > > Or later?\n> > Monday is good.\nI quote from afar."),
    ]
    got = {r["turn"]: r for r in ordered(spark, rows)}
    assert {t: r["parent"] for t, r in got.items()} == {0: None, 1: None, 2: 0, 3: 2, 4: 1, 5: None, 6: 2}
    assert {t: (r["thread"], r["depth"]) for t, r in got.items()} == {
        0: (0, 0), 1: (1, 0), 2: (0, 1), 3: (0, 2), 4: (1, 1), 5: (5, 0), 6: (0, 2),
    }
    assert got[4]["text"] == "Yes.\nIt rains now."
    assert got[3]["text"] == "At noon then."
    assert got[5]["links"] == 0


def test_messages_come_after_what_they_reply_to(spark):
    rows = [(c, t, "x", f"text {c} {t}" if t == 0 else f"> text {c} {t // 3}\ntext {c} {t}") for c in range(5) for t in range(40)]
    at = {(r["conv_id"], r["turn"]): i for i, r in enumerate(ordered(spark, rows))}
    assert all(at[c, t] > at[c, t // 3] for c, t in at if t)


def test_the_latest_earlier_message_is_meant_also_over_chunks(spark):
    rows = [(1, t, "x", "Same words." if t in (0, 10, 1500) else f"unique {t}") for t in range(0, 5000, 10)]
    rows += [(1, t, "x", "> same words.\nreply") for t in (5, 15, 1400, 4995)] + [(1, 1500, "x", "Same words.")]
    got = {r["turn"]: r["parent"] for r in ordered(spark, rows) if r["parent"] is not None}
    assert got == {5: 0, 15: 10, 1400: 10, 4995: 1500}


def test_a_long_chain(spark):
    rows = [(1, t, "x", f"m{t}" if t == 0 else f"> m{t - 1}\nm{t}") for t in range(200)]
    assert {r["turn"]: (r["thread"], r["depth"]) for r in ordered(spark, rows)} == {t: (0, t) for t in range(200)}


def test_odd_rows(spark):
    rows = [
        (None, 0, "a", "> x"), (1, None, "a", "y"), (None, None, None, None), (2, 0, "a", None), (2, 1, "a", ""),
        (2, 2, "a", "> \n>\n"), (3, 0, "a", "hello there"), (3, 1, "b", "> hello there\nhi"), (3, 1, "b", "> hello there\nhi"),
        (4, 0, "a", "> hello there\nnot in this conversation"), (5, 0, "a", "> only quoted"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("parent", F.lit("x")).withColumn("level", F.lit(1)).withColumn("conv", F.lit(2))
    got = reply_ordered(df)
    assert got.columns == ["conv_id", "turn", "role", "text", "level", "conv", "parent", "thread", "depth", "links"]
    rows_out = got.collect()
    assert len(rows_out) == len(rows)
    replies = [(r["conv_id"], r["turn"], r["parent"], r["text"]) for r in rows_out if r["parent"] is not None]
    assert replies == [(3, 1, 0, "hi")] * 2
    assert reply_ordered(spark.createDataFrame([], SCHEMA)).collect() == []
