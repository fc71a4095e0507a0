import json
import random

import pytest

from corvane.llm.chat import CONTROL, LAYOUTS, as_records, canonical, escape, fingerprint, format_records, parse, read_back, render, unescape

PIECES = [*CONTROL, "\\", "<", "|", ">", "[", "]", "/", "INST", "<|turn|>", "<|text|>", "<|end|>", "é", "\n", " ", "s"]


def test_round_trip():
    rnd = random.Random(2)
    for _ in range(4000):
        turns = [("".join(rnd.choices(PIECES, k=rnd.randrange(3))), "".join(rnd.choices(PIECES, k=rnd.randrange(9)))) for _ in range(rnd.randrange(4))]
        turns += [("assistant", "".join(rnd.choices(PIECES, k=5)))]
        text, spans = render(turns)
        assert parse(text) == turns
        assert [unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
        for _, t in turns:
            assert unescape(escape(t)) == t and not any(c in escape(t) for c in CONTROL)


def test_layouts_differ_and_are_mapped():
    assert len({fingerprint(x.example) for x in LAYOUTS}) == len(LAYOUTS)
    two = [("user", "hi"), ("assistant", "yo")]
    records = [
        {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]},
        {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}], "id": 7},
        {"prompt": "hi", "completion": "yo", "source": {"url": "x"}},
        {"instruction": "hi", "input": "", "output": "yo"},
        {"dialog": ["hi", "yo"]},
        {"question": "hi", "answer": "yo"},
    ]
    for r in records:
        assert canonical(r) == two
    assert canonical({"instruction": "a", "input": "b", "output": None}) == [("user", "a\n\nb"), ("assistant", "")]
    assert canonical({"system": "be", "conversations": [{"from": "human", "value": "hi"}]}) == [("system", "be"), ("user", "hi")]
    assert canonical({"foo": 1}) is None and canonical(None) is None and canonical([]) is None


def test_records(spark):
    rows = [(1, json.dumps({"prompt": "</s>", "response": "[INST]"})), (2, "no json"), (3, None), (4, "{}"), (1, json.dumps({"prompt": "a", "response": "b"}))]
    df = format_records(spark.createDataFrame([(*r, 0) for r in rows], "conv_id int, record string, layout int"))
    out = df.orderBy("conv_id", "formatted").collect()
    assert [r.conv_id for r in out] == [1, 1, 2, 3, 4] and [r.formatted is None for r in out] == [False, False, True, True, True]
    assert read_back(df).count() == 2
    assert format_records(spark.createDataFrame([], "conv_id int, record string")).collect() == []


@pytest.mark.parametrize("long", [300_000])
def test_turn_rows(spark, long):
    rows = [(5, 1, "assistant", "b"), (5, 0, "user", None), (5, 2, None, "x"), (None, 0, "user", "q"), (6, 0, "assistant", "é" * long), (6, None, "system", "s"), (6, 0, "assistant", "a")]
    got = {r.conv_id: r for r in read_back(format_records(as_records(spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, record int")))).collect()}
    assert {k: (v.n_turns, v.loss_chars) for k, v in got.items()} == {5: (3, 1), None: (1, 0), 6: (3, long + 1)}


def test_history(spark):
    record = {"instruction": "q3", "input": "more", "output": "a3", "history": [["q1", "a1"], ["q2", "a2"]]}
    want = [("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("assistant", "a2"), ("user", "q3\n\nmore"), ("assistant", "a3")]
    assert canonical(record) == want and canonical({**record, "id": 7}) == want
    assert canonical({**record, "history": []}) == canonical({**record, "history": None}) == want[4:]
    assert canonical({**record, "history": ["q1", "a1"]}) is None and canonical({"prompt": "q", "response": "a", "history": ["q1"]}) is None
    out = format_records(spark.createDataFrame([(1, json.dumps(record))], "conv_id int, record string")).collect()
    assert parse(out[0].formatted) == want and len(out[0].mask) == 3


def test_varied_layouts_say_the_same(spark):
    rnd = random.Random(4)
    text = lambda: rnd.choice(["", "a\n\nb", "\n\nx", "x\n\n", "a\n\nb\n\nc", "é", "</s>", "q \\ r"])
    rows = []
    for conv in range(300):
        roles = rnd.choice([["user", "assistant"], ["user", "assistant"] * 2, ["user"], ["system", "user", "assistant"], ["assistant"], ["User", "model"], [None, "user"], ["system"], ["user", "assistant", "user"]])
        rows += [(conv, i, role, rnd.choice([text(), None])) for i, role in enumerate(roles)]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, spoken int")
    records = as_records(turns, varied=True)
    out = format_records(records).collect()
    assert len({r.layout for r in out}) >= 7 and all(r.formatted is not None for r in out)
    want = {c: [(r or "", t or "") for i, _, r, t in rows if i == c] for c in range(300)}
    assert {r.conv_id: parse(r.formatted) for r in out} == want
    assert as_records(turns.limit(0), varied=True).collect() == []


def test_odd_items_and_roles():
    assert canonical({"messages": [{"role": "user", "content": "a"}, "b"]}) is None and canonical({"messages": ["a"]}) is None
    assert canonical({"turns": [{"role": "Human", "text": "a"}]}) == [("Human", "a")]
    assert canonical({"messages": [{"role": "Human", "content": "a"}]}) == [("user", "a")]


@pytest.mark.parametrize("depth", [500, 3_000, 100_000])
def test_deeply_nested_records(spark, depth):
    rows = [(1, "[" * depth + "]" * depth), (2, '{"a":' * depth + "1" + "}" * depth), (3, '{"prompt":"p","completion":"c"}')]
    got = {r.conv_id: r for r in format_records(spark.createDataFrame(rows, "conv_id long, record string")).collect()}
    assert got[1].formatted is None and got[2].formatted is None and got[3].formatted
