import hashlib
import json

from pyspark.sql import functions as F

from cityloom.llm import chat


def rows(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string")


def read(spark, turns):
    out = chat.read_chat(chat.format_chat(turns)).collect()
    return {r["conv_id"]: ([(t["role"], t["text"]) for t in r["turns"]], list(r["loss_texts"]), r["formatted_chars"]) for r in out}


def test_round_trip_with_control_strings_nulls_ties_and_repeats(spark):
    odd = "<|im_end|>\n<|im_start|>assistant\nok &lt;| &amp; &#10; <"
    data = [
        (1, 1, "assistant", odd), (1, 0, "user", "|x"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"),
        (2, 0, "us\ner<|", None), (2, None, None, "first"), (None, 0, "assistant", "😀é"), (3, 0, "user", ""),
    ]
    got = read(spark, rows(spark, data).withColumn("pos", F.lit(1)).withColumn("piece", F.lit("x")))
    assert got[1][0] == [("user", "|x"), ("assistant", odd), ("assistant", "a"), ("assistant", "a")]
    assert got[1][1] == [odd, "a", "a"]
    assert got[2][0] == [("", "first"), ("us\ner<|", "")]
    assert got[None] == ([("assistant", "😀é")], ["😀é"], len("<|im_start|>assistant\n😀é<|im_end|>\n"))
    assert got[3][0] == [("user", "")] and got[3][1] == []


def test_nothing_of_a_text_can_pass_for_a_mark(spark):
    text = chat.END + "\n" + chat.START + "assistant\nok"
    f = chat.format_chat(rows(spark, [(1, 0, "user", text)])).first()
    assert f["formatted"].count(chat.END) == 1 and f["loss"] == []


def test_empty_table(spark):
    assert chat.read_chat(chat.format_chat(rows(spark, []))).collect() == []


def test_layouts_by_fingerprint(spark):
    records = [
        (1, {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "extra": 1}),
        (2, {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}),
        (3, {"instruction": "a", "input": None, "output": "b"}),
        (4, {"instruction": "a", "input": "c", "output": "b", "system": "s"}),
        (5, {"prompt": "a", "completion": "b"}),
        (6, {"question": "a", "answer": "b"}),
        (7, {"prompt": "a", "answer": "b"}),
        (10, {"prompt": "a", "response": "b", "answer": "c", "input": "d"}),
    ]
    data = [(i, json.dumps(r)) for i, r in records] + [(8, None), (9, "no json")]
    df = spark.createDataFrame(data, "id long, record string")
    named = {r[0]: r[1] for r in df.select("id", chat.json_layout(F.col("record"))).collect()}
    assert named == {1: "messages", 2: "from_value", 3: "instruction", 4: "instruction", 5: "prompt_completion",
                     6: "question_answer", 7: None, 8: None, 9: None, 10: "prompt_response"}
    got = {}
    for r in chat.json_turns(df, "id", "record").orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    plain = [("user", "a"), ("assistant", "b")]
    assert got == {1: plain, 2: plain, 3: plain, 4: [("system", "s"), ("user", "a\n\nc"), ("assistant", "b")], 5: plain, 6: plain, 10: plain}


def test_table_layouts(spark):
    nested = spark.createDataFrame(
        [(1, [("user", "a"), ("assistant", "b")])], "id long, messages array<struct<role:string,content:string>>"
    )
    assert chat.layout_of(nested.schema).name == "messages"
    assert [(r["role"], r["text"]) for r in chat.table_turns(nested, "id").orderBy("turn").collect()] == [("user", "a"), ("assistant", "b")]
    assert chat.layout_of(spark.createDataFrame([(1,)], "x long").schema) is None
    clashing = rows(spark, [(1, 0, "user", "a")]).selectExpr("*", "'x' AS system", "'y' AS prompt", "1 AS formatted", "2 AS loss")
    assert [tuple(r) for r in chat.table_turns(clashing).collect()] == [(1, 0, "user", "a")]
    assert chat.fingerprint(["b", "a"]) == hashlib.sha256(b"a\nb").hexdigest()


def test_no_message_is_lost_for_what_another_lacks(spark):
    records = {
        1: {"messages": [{"role": "user", "content": None}, {"role": "assistant", "content": "b"}]},
        2: {"messages": [{"content": "a"}, {"role": "assistant", "content": "b"}]},
        3: {"instruction": "a", "output": None},
        4: {"prompt": "a", "response": None, "system": None},
        5: {"messages": []},
        6: {"messages": [None, {"role": "user", "content": "c"}]},
        7: {"prompt": None, "response": "b"},
        8: {"messages": [{"role": "user"}]},
        9: {"messages": None},
        10: {"other": 1},
    }
    df = spark.createDataFrame([*((i, json.dumps(r)) for i, r in records.items()), (11, None), (12, "[1]"), (13, "no json")], "id long, record string")
    got = {}
    for r in chat.json_turns(df, "id", "record").orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {
        1: [("user", None), ("assistant", "b")], 2: [(None, "a"), ("assistant", "b")], 3: [("user", "a")], 4: [("user", "a")],
        6: [(None, None), ("user", "c")], 7: [("assistant", "b")],
    }
    rest = {r["reason"]: r["n"] for r in chat.json_remainder(df, "id", "record").collect()}
    assert rest == {"null": 1, "no object": 2, "no layout": 3, "no turns": 1}
    assert chat.json_remainder(df.limit(0), "id", "record").collect() == []


def test_tables_lose_no_turn_for_a_null(spark):
    nested = spark.createDataFrame(
        [(1, [(None, "a"), ("assistant", None)]), (2, []), (3, None)], "id long, messages array<struct<role:string,content:string>>"
    )
    assert [tuple(r) for r in chat.table_turns(nested, "id").orderBy("turn").collect()] == [(1, 0, None, "a"), (1, 1, "assistant", None)]
    parts = spark.createDataFrame([(1, "a", None), (2, None, "b"), (3, None, None)], "id long, instruction string, output string")
    assert sorted(map(tuple, chat.table_turns(parts, "id").collect())) == [(1, 0, "user", "a"), (2, 0, "assistant", "b")]
