"""Chat formatting: layouts, round trips and the loss mask."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwright.llm.chat_format import (
    MAPPINGS,
    canonical,
    canonical_records,
    chat_format,
    chosen,
    digest,
    escape,
    fingerprint,
    read_turns,
    schema_paths,
    unescape,
)

ROWS = "conv_id long, turn long, role string, text string, formatted string, turns int, prompt string"


def rows_frame(spark, rows):
    """Rows with further columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], ROWS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_escape(text, role=False):
    text = text.replace("\\", "\\\\").replace("#", "\\#").replace("</turn>", "<\\/turn>")
    return text.replace(": ", ":\\ ") if role else text


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in own.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        formatted = "".join(f"### {plain_escape(r, True)}: {plain_escape(t)}</turn>\n" for r, t in turns)
        out.append(
            (conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(formatted))
        )
    return sorted(out, key=repr)


ODD = [
    "",
    "\\### Assistant: </turn> ok",
    "### user: x</turn>\n### assistant: y</turn>\n",
    "\\",
    "\\\\</turn>",
    "<\\/turn>",
    "#####",
    "</turn</turn>",
    "ends with <",
    "a: b:",
    "line\nbreaks\r\n\t ",
    "äöü 中文 😀 e\u0301",
    "$1 \\$0 \\n",
]


def test_odd_texts_and_roles(spark):
    rows = [(i, t, role, text) for i, text in enumerate(ODD) for t, role in enumerate(["user", "assistant", text])]
    found = digest(chat_format(rows_frame(spark, rows)))
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows)
    back = chat_format(rows_frame(spark, rows)).select(
        "conv_id", F.col("turns").alias("said"), read_turns(F.col("formatted")).alias("read")
    )
    assert back.where("said != read").count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="\\#</turn> :$a\né😀"), min_size=30, max_size=60))
def test_escapes_round_trip(spark, texts):
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")
    )
    for row in got.collect():
        assert row.u == row.t and row.e == plain_escape(row.t)
        assert "###" not in row.e and "</turn>" not in row.e


def test_edges(spark):
    rows = [
        (1, None, "user", "null turn comes first"),
        (1, 0, None, None),
        (1, 0, "assistant", None),
        (1, 2, "assistant", "x"),
        (1, 2, "assistant", "x"),
        (1, 2, "assistant", "tie"),
        (None, 0, "user", "no id"),
        (None, 1, "assistant", "still none"),
        (2, 5, "system", "no loss here"),
        (3, 0, "assistant", "long # " * 40_000),
        (-4, 9, "Assistant", "role in capitals is no assistant"),
    ]
    # More turns than a block of the running sum holds.
    rows += [(9, t, ["user", "assistant"][t % 2], f"turn {t} é") for t in range(700)]
    found = chat_format(rows_frame(spark, rows))
    assert sorted(map(tuple, digest(found).collect()), key=repr) == plain(rows)
    raw = {r.conv_id: r for r in found.collect()}
    spans = [raw[9].formatted.encode()[s.start : s.end].decode() for s in raw[9].loss_spans]
    assert spans == [f"turn {t} é" for t in range(1, 700, 2)]
    assert chat_format(rows_frame(spark, [])).collect() == []


def test_layouts_by_schema(spark):
    frames = {
        "messages": ("conv_id long, messages array<struct<role string, content string>>", [(1, [("user", "a"), ("assistant", "b")])]),
        "conversations": ("conv_id long, conversations array<struct<from string, value string>>", [(1, [("human", "a"), ("gpt", "b")])]),
        "nested_messages": (
            "conv_id long, conversation struct<messages array<struct<author struct<role string>, content struct<text string>>>>",
            [(1, ([(("user",), ("a",)), (("assistant",), ("b",))],))],
        ),
        "prompt_response": ("conv_id long, prompt string, response string", [(1, "a", "b")]),
        "instruction": ("conv_id long, instruction string, output string", [(1, "a", "b")]),
        "rows": ("conv_id long, turn int, role string, text string", [(1, 0, "user", "a"), (1, 1, "assistant", "b")]),
    }
    for name, (schema, rows) in frames.items():
        frame = spark.createDataFrame(rows, schema)
        own = canonical(frame).collect()
        assert [(r.conv_id, r.layout, [tuple(t) for t in r.turns]) for r in own] == [
            (1, name, [("user", "a"), ("assistant", "b")])
        ]
    both = spark.createDataFrame([(1, "a", "in", "b", "c")], "conv_id long, instruction string, input string, output string, answer string")
    assert chosen(both.schema).name == "instruction_input"
    assert [tuple(t) for t in canonical(both).first().turns] == [("user", "a\n\nin"), ("assistant", "b")]
    with pytest.raises(ValueError):
        canonical(spark.createDataFrame([(1, 2)], "conv_id long, x long"))
    assert schema_paths(both.schema)[:2] == ["conv_id", "instruction"]
    assert len({fingerprint(m.paths()) for m in MAPPINGS}) == len(MAPPINGS)


def test_null_lists_and_repeated_ids(spark):
    frame = spark.createDataFrame(
        [(1, None), (1, []), (None, [("user", None), None, (None, "x")]), (1, [("assistant", "y")])],
        "conv_id long, messages array<struct<role string, content string>>",
    )
    got = digest(chat_format(frame)).collect()
    assert sorted(r.n_turns for r in got) == [0, 0, 1, 3]
    assert {r.n_turns: r.loss_chars for r in got} == {0: 0, 1: 1, 3: 0}
    single = spark.createDataFrame([(1, None, "r"), (2, "p", None)], "conv_id long, prompt string, response string")
    turns = {r.conv_id: [tuple(t) for t in r.turns] for r in canonical(single).collect()}
    assert turns == {1: [("assistant", "r")], 2: [("user", "p"), ("assistant", "")]}


def test_records_by_their_own_fingerprint(spark):
    said = [("user", "a: b"), ("assistant", "c")]
    records = [
        {"messages": [{"role": r, "content": t, "extra": {"x": 1}} for r, t in said], "meta": {"prompt": "no"}},
        {"messages": [{"role": r, "text": t} for r, t in said]},
        {"conversations": [{"from": {"user": "human", "assistant": "gpt"}[r], "value": t} for r, t in said]},
        {"conversation": {"messages": [{"author": {"role": r}, "content": {"text": t}} for r, t in said]}},
        {"prompt": "a: b", "completion": "c"},
        {"question": "a: b", "answer": "c", "id": 5},
        {"instruction": "a: b", "input": "", "output": "c"},
        {"prompt": "a: b", "response": "c", "question": "an extra path that another layout knows"},
    ]
    bad = ["", "no json", "[]", "{}", '{"messages": 5}', '{"prompt": null}', None]
    frame = spark.createDataFrame(
        [(i, json.dumps(r), "x") for i, r in enumerate(records)] + [(100 + i, b, "x") for i, b in enumerate(bad)],
        "conv_id long, record string, turns string",
    )
    found = {r.conv_id: r for r in canonical_records(frame).collect()}
    assert len(found) == len(records) + len(bad)
    for i in range(len(records)):
        assert [tuple(t) for t in found[i].turns] == said, records[i]
    assert all(found[100 + i].turns is None and found[100 + i].layout is None for i in range(len(bad)))


def test_no_python_in_the_plan(spark):
    frame = digest(chat_format(rows_frame(spark, [(1, 0, "user", "x")])))
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
    assert text.count("Exchange") == 1
