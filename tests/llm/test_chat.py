import hashlib
import json

import pytest
from pyspark.sql import functions as F

from revgraph.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "~1 ~0[ <", "[ROLE x] [/ROLE]", "<<SYS>>a<</SYS>>", "", "ends with [", "~", " [/INST", "é" * 50, "a\nb", "<</SYS>", "[[INST]]"]


def formatted(spark, turns):
    df = spark.createDataFrame([(1, turns)], "conv_id long, turns " + chat.TURNS)
    return chat.read_back(chat.format_turns(df)).first()


@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool", "", "a]b ~3[INST]"])
def test_round_trip_of_nasty_texts(spark, role):
    turns = [(role, t) for t in NASTY] + [("assistant", t) for t in NASTY]
    row = formatted(spark, turns)
    assert [(t.role, t.text) for t in row.read_turns] == turns
    assert row.read_loss == [t for r, t in turns if r == "assistant"]


def test_no_turns_and_many_turns(spark):
    assert formatted(spark, []).read_turns == []
    turns = [("assistant" if i % 2 else "user", "x" * (i % 7)) for i in range(1500)]
    row = formatted(spark, turns)
    assert [(t.role, t.text) for t in row.read_turns] == turns
    assert len(row.read_loss) == 750


LAYOUTS = [
    ("messages", {"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}, [("user", "q"), ("assistant", "a")]),
    ("from_value", {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, [("user", "q"), ("assistant", "")]),
    ("prompt_response", {"response": "a", "prompt": "q"}, [("user", "q"), ("assistant", "a")]),
    ("prompt_completion", {"prompt": "q", "completion": "a"}, [("user", "q"), ("assistant", "a")]),
    ("instruction_input", {"instruction": "do", "input": "it", "output": "a"}, [("user", "do\n\nit"), ("assistant", "a")]),
    ("instruction", {"instruction": "do", "output": None}, [("user", "do"), ("assistant", "")]),
    ("system_prompt_response", {"system": "s", "prompt": "q", "response": "a"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ("question_answer", {"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ("messages", {"messages": []}, []),
    (None, {"something": "else"}, None),
    (None, {"prompt": "q", "response": "a", "extra": 1}, None),
]


def test_layouts_by_fingerprint(spark):
    rows = [(i, json.dumps(r)) for i, (_, r, _) in enumerate(LAYOUTS)] + [(100, "no json"), (101, None)]
    df = chat.canonical_turns(spark.createDataFrame(rows, "id int, record string"))
    got = {r.id: r for r in df.collect()}
    for i, (layout, _, turns) in enumerate(LAYOUTS):
        assert got[i].layout == layout, i
        assert (got[i].turns and [(t.role, t.text) for t in got[i].turns]) == turns or got[i].turns == turns
    assert got[100].layout is None and got[101].layout is None


def test_typed_records(spark):
    df = spark.createDataFrame([(("q", "a"),)], "record struct<response:string,prompt:string>")
    row = chat.typed_turns(df).first()
    assert row.layout == "prompt_response" and [(t.role, t.text) for t in row.turns] == [("user", "a"), ("assistant", "q")]
    other = spark.createDataFrame([(("q",),)], "record struct<x:string>")
    assert chat.typed_turns(other).first().turns is None


def test_nulls_ties_and_clashing_columns(spark):
    rows = [(1, None, None, "n", 0), (1, 0, "user", None, 0), (1, 0, "user", "b", 0), (1, 0, "user", "b", 0), (None, 1, "assistant", "x", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    want = "\nn\n" + "user\n\n" + "user\nb\n" * 2
    assert got[1].n_turns == 4 and got[1].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert got[None].loss_chars == 1
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_rows_select_their_mapping_by_fingerprint(spark, monkeypatch):
    """Turns come from the JSON record and the mapping that its own paths select, not from the typed record."""
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, None, None, None), (3, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(chat, "typed_turns", lambda df: df.withColumns({"layout": F.lit(None).cast("string"), "turns": F.lit(None).cast(chat.TURNS)}))
    got = {r.conv_id: (r.layout, [tuple(t) for t in r.turns]) for r in chat.format_conversations(rows.withColumn("record", F.lit("clash")).withColumn("layout", F.lit("clash"))).collect()}
    assert got == {1: ("turns", [("user", "q"), ("assistant", "a")]), 2: ("turns", [("", "")]), 3: ("turns", [("user", "x")])}
    assert chat.format_conversations(rows.limit(0)).count() == 0


def test_a_very_long_text(spark):
    text = "~[INST] é\n" * 400_000
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    row = chat.digests(chat.format_conversations(rows)).first()
    assert row.loss_chars == len(text) and row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
