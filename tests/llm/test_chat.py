"""Layouts against their expected turns, and the template against an exact round trip."""

import json
import random

import pytest
from pyspark.sql import functions as F

from assay.llm import chat

TALK = [("user", "a"), ("assistant", "b")]


def records(spark, values):
    rows = [(i, None if v is None else v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "conv long, raw string").select("conv", F.expr("try_parse_json(raw)").alias("record"))


def turns_of(spark, values):
    found = {}
    rows = chat.canonical_turns(records(spark, values), "conv", "record").collect()
    for r in sorted(rows, key=lambda r: (r.conversation, r.position)):
        found.setdefault(r.conversation, []).append((r.role, r.text))
    return found


CASES = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, TALK),
    ({"id": 7, "tags": {"x": [1]}, "messages": [{"content": "a", "role": "user"}, {"role": "assistant", "content": "b", "w": 1}]}, TALK),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}]}, {"role": "assistant", "content": [{"type": "text", "text": "b"}]}]}, TALK),
    ({"messages": [{"role": "user", "content": [{"type": "t", "text": "a"}, {"type": "t", "text": "c"}]}, {"role": "tool", "content": "s"}]}, [("user", "ac"), ("tool", "s")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, TALK),
    ({"instruction": "a", "output": "b"}, TALK),
    ({"instruction": "a", "input": "", "output": "b"}, TALK),
    ({"instruction": "a", "input": "i", "output": "b", "system": "s"}, [("system", "s"), ("user", "a\n\ni"), ("assistant", "b")]),
    ({"prompt": "a", "completion": "b"}, TALK),
    ({"prompt": "a", "response": "b"}, TALK),
    ({"question": "a", "answer": None, "context": "c"}, [("system", "c"), ("user", "a"), ("assistant", "")]),
    ({"turn": 0, "role": None, "text": None}, [("", "")]),
    ({"messages": [{"role": None, "content": 3}, {"role": "user", "content": None}]}, [("", "3"), ("user", "")]),
]
LOST = [{"prompt": "a"}, {"prompt": "a", "completion": "b", "messages": []}, [1], "null", None, {}, {"messages": "x"}]


def test_layouts(spark):
    values = [v for v, _ in CASES] + LOST + [{"messages": []}]
    assert turns_of(spark, values) == {i: want for i, (_, want) in enumerate(CASES)}


def test_records_that_fit_no_layout_are_listed(spark):
    found = {tuple(r.paths): r.records for r in chat.unmapped(records(spark, [CASES[0][0], *LOST, LOST[0]]), "record").collect()}
    assert found == {
        ("prompt",): 2, ("completion", "messages[]", "prompt"): 1, ("[]",): 1, (): 2, ("",): 1, ("messages",): 1,
    }


def test_paths_of_odd_names(spark):
    value = {"a b": {"x:y": 1, "z`": [[1, {"k": 2}]]}, "e<f>, g": True, "o": {}, "l": [{"m": 1}, {"n": None}, None]}
    (row,) = records(spark, [value]).select(chat.field_paths("record").alias("p")).collect()
    assert sorted(row.p) == ["a b.x:y", "a b.z`[][]", "e<f>, g", "l[].m", "l[].n"]


def test_two_layouts_with_the_same_paths_are_an_error(spark):
    twice = (*chat.LAYOUTS, chat.Layout("again", chat.Fields((("user", ("prompt",)),)), ("completion", "prompt")))
    with pytest.raises(ValueError, match="the same paths"):
        chat.layout_of("record", twice)


def test_round_trip_of_hostile_texts(spark):
    source = random.Random(3)
    parts = [*chat.CONTROLS, "\\", "\\\\", "<", "<|", "|>", "\n", "é😀", "word", "[INST", "im_start", "", " ", "n", "s>"]
    rows = []
    for conv in range(60):
        for turn in range(source.randrange(1, 6)):
            role = source.choice(["user", "assistant", "system", "to ol\n<|im_end|>%\\", "", None])
            text = None if source.random() < 0.1 else "".join(source.choices(parts, k=source.randrange(12)))
            rows.append((conv if conv else None, turn if turn else None, role, text))
    rows += [(1000, 0, "assistant", "<|im_start|>" * 20_000)] + [(1001, 0, "user", "twice")] * 2
    df = spark.createDataFrame(rows, "conversation long, position long, role string, text string").repartition(5)
    formatted = chat.format_conversations(df)
    want = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1] or -1)):
        want.setdefault(conv, []).append((role or "", text or ""))
    for r in chat.read_back(formatted).collect():
        assert [tuple(t) for t in r.turns] == want[r.conversation]
        assert r.loss == [text for role, text in want[r.conversation] if role == "assistant"]
    for r in formatted.collect():
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(r.turns)
        assert not any(c in r.formatted for c in chat.CONTROLS[2:])
        assert r.turns[0].start == 0 and r.turns[-1].end == len(r.formatted)
        for t in r.turns:
            piece = r.formatted[t.start : t.end]
            assert piece.startswith("<|im_start|>") and piece.endswith("<|im_end|>\n")
            assert (t.loss_start is not None) == piece.startswith("<|im_start|>assistant\n")
            if t.loss_start is not None:
                assert r.formatted[t.start : t.loss_start] == "<|im_start|>assistant\n"
                assert r.formatted[t.loss_end : t.end] == "<|im_end|>\n"


def test_templates_that_could_be_misread_are_refused():
    for controls in (("<a>",), ("<|im_start|>", "<|im_end|>", "x<"), ("<|im_start|>", "<|im_end|>", "a\\b")):
        with pytest.raises(ValueError):
            chat.Template(controls=controls)


def test_empty(spark):
    empty = spark.createDataFrame([], "conversation long, position long, role string, text string, head int, piece int")
    assert chat.format_conversations(empty).count() == 0
    assert chat.canonical_turns(records(spark, []), "conv", "record").count() == 0
