import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from couriermart.llm.chat import Template, escape, fingerprint_of, format_chats, gather_turns, read_loss, read_turns, unescape

RECORD = (
    "id long, fingerprint string, record struct<messages:array<struct<role:string,content:string>>,system:string,"
    "conversations:array<struct<from:string,value:string>>,prompt:string,response:string,completion:string,"
    "instruction:string,input:string,output:string,data:struct<question:string,answer:string>,other:string>"
)


def record(**fields):
    return {name: fields.get(name) for name in (
        "messages", "system", "conversations", "prompt", "response", "completion", "instruction", "input", "output", "data", "other",
    )}


def chats(spark, *records):
    frame = spark.createDataFrame([(i, "clash", r) for i, r in enumerate(records)], RECORD)
    return {row.id: row for row in format_chats(frame, "id").withColumn("loss", read_loss(F.col("segments"))).withColumn(
        "back", read_turns(F.col("formatted"))
    ).collect()}


def test_layouts_become_turns(spark):
    got = chats(
        spark,
        record(messages=[("system", "s"), ("user", None), ("assistant", "a")]),
        record(system="be kind", conversations=[("human", "h"), ("gpt", "g"), ("tool", "t")]),
        record(prompt="p", response="r", other="ignored"),
        record(instruction="i", output="o"),
        record(instruction="i", input="in", output="o"),
        record(data=("q", "a")),
        record(prompt="p", output="o"),
        record(),
        record(messages=[]),
    )
    turns = {i: (row.layout, [tuple(turn) for turn in row.turns]) for i, row in got.items()}
    assert turns == {
        0: ("messages", [("system", "s"), ("user", ""), ("assistant", "a")]),
        1: ("conversations", [("system", "be kind"), ("user", "h"), ("assistant", "g"), ("tool", "t")]),
        2: ("prompt_response", [("user", "p"), ("assistant", "r")]),
        3: ("instruction", [("user", "i"), ("assistant", "o")]),
        4: ("instruction", [("user", "i\n\nin"), ("assistant", "o")]),
        5: ("question_answer", [("user", "q"), ("assistant", "a")]),
        6: (None, []),
        7: (None, []),
        8: ("messages", []),
    }
    assert got[2].fingerprint == fingerprint_of({"prompt", "response"}) != got[6].fingerprint
    for row in got.values():
        assert row.back == row.turns
        assert row.loss == "".join(turn.text for turn in row.turns if turn.role == "assistant")
        assert "".join(piece.text for piece in row.segments) == row.formatted


def test_nulls_ties_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string, record string"
    rows = [(1, 2, "assistant", "b", "x"), (1, 1, "user", "z", "x"), (1, 1, "user", "a", "x"), (1, 1, "user", "a", "x"),
            (None, None, None, None, None), (2, 0, "assistant", None, None)]
    gathered = gather_turns(spark.createDataFrame(rows, schema), "conv_id", "turn", "role", "text")
    got = {row.conv_id: [tuple(t) for t in row.turns] for row in format_chats(gathered, "conv_id").collect()}
    assert got == {
        1: [("user", "a"), ("user", "a"), ("user", "z"), ("assistant", "b")], None: [("", "")], 2: [("assistant", "")],
    }
    assert format_chats(gathered.where("conv_id = 99"), "conv_id").collect() == []


parts = st.sampled_from([*Template().controls(), "\\", "<", "</s", "|", "[", "INST]", ">", "é", "\n", "a", " "])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(parts, max_size=12).map("".join), min_size=40, max_size=60))
def test_escape_is_reversible(spark, texts):
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    escaped = escape(F.col("text"))
    for row in frame.select("text", escaped.alias("e"), unescape(escaped).alias("back")).collect():
        assert row.back == row.text
        assert not any(control in row.e for control in Template().controls())


def test_long_text(spark):
    text = "[INST] \\ </s>" * 200_000
    row = chats(spark, record(prompt=text, response=text))[0]
    assert hashlib.sha256(row.loss.encode()).digest() == hashlib.sha256(text.encode()).digest()
    assert [turn.text for turn in row.back] == [text, text]
