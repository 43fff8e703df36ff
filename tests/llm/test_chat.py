"""Chat layouts, and the template read back."""

from __future__ import annotations

import hashlib
import json
import time

import pytest
from pyspark.sql import functions as F
from waferscope.llm import chat
from waferscope.llm.registry import op2_chat, table

ODD = ["", "\\### Assistant: </turn> ok", "### User: x</turn>\n", "\\b\\h\\\\", "a\n\nb: #<", "\\", "😀 é ́", "<|x|>:", "x" * 100_000]


@pytest.mark.parametrize(
    ("record", "layout", "turns"),
    [
        ({"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]}, "messages", [("user", "a"), ("assistant", "b")]),
        ({"messages": [{"role": None, "content": None}]}, "messages", [("", "")]),
        ({"messages": []}, "messages", []),
        ({"messages": [{"role": "user", "content": "a"}], "system": "s"}, "messages with system", [("system", "s"), ("user", "a")]),
        ({"id": 7, "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, "conversations", [("user", "a"), ("assistant", "b")]),
        ({"turns": [{"text": "a", "role": "bot"}]}, "turns", [("assistant", "a")]),
        ({"data": {"messages": [{"role": "user", "content": "1"}]}}, "nested messages", [("user", "1")]),
        ({"prompt": "p", "completion": "c"}, "prompt and completion", [("user", "p"), ("assistant", "c")]),
        ({"prompt": "p", "response": 5}, "prompt and response", [("user", "p"), ("assistant", "5")]),
        ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
        ({"instruction": "i", "input": "x", "output": "o", "system": "s"}, "instruction", [("system", "s"), ("user", "i"), ("user", "x"), ("assistant", "o")]),
        ({"question": "q", "answer": "a"}, "question and answer", [("user", "q"), ("assistant", "a")]),
        ({"question": "q"}, None, None),
        (None, None, None),
    ],
)
def test_fingerprints_select_the_mapping(spark, record, layout, turns):
    text = None if record is None else json.dumps(record)
    rows = spark.createDataFrame([(text, "kept", 1)], "text string, _fingerprint string, turns int")
    rows = rows.withColumn("record", F.expr("parse_json(text)"))
    (found,) = chat.with_turns(rows).collect()
    assert (found.layout, found._fingerprint) == (layout, "kept")
    assert (None if found.turns is None else [tuple(t) for t in found.turns]) == turns


def test_format_is_read_back_exactly(spark):
    turns = [("assistant" if i % 2 else f"r:{i}", text) for i, text in enumerate(ODD)]
    rows = spark.createDataFrame([(turns,), ([],), (None,)], "turns array<struct<role:string,text:string>>")
    made = chat.with_format(rows).select(
        "turns", "formatted", "loss_spans", chat.read_turns(F.col("formatted")).alias("back"), chat.read_under(F.col("formatted"), F.col("loss_spans")).alias("lost")
    )
    full, empty, none = made.collect()
    assert full.back == full.turns and len(full.turns) == len(ODD)
    assert full.lost == "".join(text for role, text in turns if role == "assistant")
    for (start, end), text in zip(full.loss_spans, ODD[1::2], strict=True):
        escaped = text.replace("\\", "\\b").replace("#", "\\h").replace("<", "\\l").replace(":", "\\c")
        assert full.formatted[start:end] == escaped
    assert (empty.formatted, empty.lost, empty.back) == ("", "", [])
    assert none.formatted is None and none.back is None


def test_rows_become_records_whatever_they_hold(spark):
    rows = [(1, 1, "assistant", None, "x"), (1, 0, None, "a", "x"), (1, 1, "assistant", None, "x"), (None, None, "user", "q", "x"), (2, 0, "user", "b" * 300_000, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, m string")
    found = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.with_turns(chat.records_of(df)).collect()}
    assert found == {1: [("", "a"), ("assistant", ""), ("assistant", "")], None: [("user", "q")], 2: [("user", "b" * 300_000)]}
    assert chat.with_format(chat.with_turns(chat.records_of(df.limit(0)))).count() == 0


def test_the_query_against_the_rows(spark, star_folder):
    rows = table(spark, star_folder, "conversations").orderBy("conv_id", "turn").collect()
    said: dict = {-7: [("user", ODD[1]), ("assistant", ODD[1])]}
    for r in rows:
        said.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    found = {r.conv_id: r for r in op2_chat(spark, star_folder).collect()}
    assert set(found) == set(said)
    for key, turns in said.items():
        lost = "".join(t for r, t in turns if r == "assistant")
        row = found[key]
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (row.n_turns, row.loss_chars, row.loss_sha256) == (len(turns), len(lost), hashlib.sha256(lost.encode()).hexdigest())


@pytest.mark.parametrize("layout", [0, 1, 2, 3])
def test_rows_take_every_layout(spark, layout):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "system", "c"), (None, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.with_turns(chat.records_of(df, layout=F.lit(layout))).collect()
    names = {"messages": 0, "conversations": 1, "turns": 2, "nested messages": 3}
    assert {names[r.layout] for r in made} == {layout}
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in made} == {1: [("user", "a"), ("assistant", "b")], 2: [("system", "c")], None: [("", "")]}


@pytest.mark.parametrize("count", [1, 2, 3, 10, 99, 100, 101])
def test_spans_of_any_number_of_turns(spark, count):
    said = [("assistant" if n % 3 else "user", "#" * (n % 7) + "é") for n in range(count)]
    df = spark.createDataFrame([(said,)], "turns array<struct<role:string,text:string>>")
    (row,) = chat.with_format(df).select("formatted", "loss_spans", chat.read_under(F.col("formatted"), F.col("loss_spans")).alias("lost")).collect()
    bodies = [text.replace("#", "\\h") for role, text in said if role == "assistant"]
    assert [row.formatted[a:b] for a, b in row.loss_spans] == bodies
    assert row.lost == "".join(text for role, text in said if role == "assistant")


def test_a_conversation_of_many_turns_takes_linear_time(spark):
    """100,000 turns, through every step of the query."""
    rows = spark.range(100_000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("turn <"), F.col("id").cast("string"), F.lit("> says: no")).alias("text"),
    )
    made = chat.with_format(chat.with_turns(chat.records_of(rows)))
    read = made.select(F.size(chat.read_turns(F.col("formatted"))).alias("turns"), chat.read_under(F.col("formatted"), F.col("loss_spans")).alias("lost"))
    started = time.perf_counter()
    (row,) = read.collect()
    assert time.perf_counter() - started < 30
    assert row.turns == 100_000 and row.lost == "".join(f"turn <{n}> says: no" for n in range(1, 100_000, 2))
