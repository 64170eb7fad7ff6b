import random

from pyspark.sql import functions as F

from ledgerloom.llm import chat

KINDS = "conv_id long, turn long, role string, text string, extra string, loss string, formatted string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], KINDS)


def back(df):
    out = df.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("texts", chat.loss_texts(F.col("formatted"), F.col("loss")))
    return {r.conv_id: ([tuple(t) for t in r.turns], list(r.texts), r.formatted) for r in out.collect()}


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(1)
    bits = ["\\", "<", "#", "</turn>", "<turn>", "### ", "\\b", "\\l", "\\h", "\n", "### user\n", "ü", "\U0001f600", "", "a b"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "as<si#st\\ant", ""]), "".join(rng.choices(bits, k=rng.randrange(8))))
            for c in range(40) for t in range(rng.randrange(1, 9))]
    found = back(chat.format_conversations(made(spark, rows).repartition(5)))
    for c in range(40):
        own = [(r, x) for k, _, r, x in sorted(rows) if k == c]
        turns, texts, _ = found[c]
        assert turns == own
        assert texts == [x for r, x in own if r == "assistant"]


def test_neighbours_of_one_role_share_a_heading(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "user", "d")]
    turns, texts, formatted = back(chat.format_conversations(made(spark, rows)))[1]
    assert formatted == "### user\n<turn>a</turn><turn>b</turn>\n### assistant\n<turn>c</turn>\n### user\n<turn>d</turn>"
    assert texts == ["c"]


def test_nulls_ties_repeats_and_no_rows(spark):
    rows = [(None, 1, "user", "x"), (1, None, "user", None), (1, 2, None, "n"), (1, 2, "assistant", "t"), (1, 2, "assistant", "t")]
    found = back(chat.format_conversations(made(spark, rows)))
    assert found[1][0] == [("user", ""), ("", "n"), ("assistant", "t"), ("assistant", "t")]
    assert found[None][0] == [("user", "x")]
    assert chat.format_conversations(made(spark, rows).limit(0)).collect() == []


def test_long_conversation(spark):
    rows = [(1, t, "assistant" if t % 3 else "user", f"{t} " * 200) for t in range(500)]
    turns, texts, _ = back(chat.format_conversations(made(spark, rows)))[1]
    assert [x for _, x in turns] == [r[3] for r in rows] and len(texts) == 333
