"""Linking, order and canonical JSON of tool calls on hand-made conversations."""

from __future__ import annotations

import functools
import json
import random

import numpy as np
import pytest

from sensorframe.llm import tool_calls

TOOLS = {"add": {"type": "object", "required": ["x"], "additionalProperties": False, "properties": {"x": {}, "n": {"type": "integer", "minimum": 1, "maximum": 5}, "mode": {"type": "string", "enum": ["a", "b"]}}}}


def call(own, refs=(), **arguments):
    return "<tool_call>" + json.dumps({"name": "add", "id": own, "arguments": {"x": [{"$ref": r} for r in refs], **arguments}}) + "</tool_call>"


def result(own, content=1):
    return json.dumps({"tool_call_id": own, "content": content})


def linked(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    return tool_calls.link_tool_calls(df, TOOLS, **options).collect()


#: All conversations within tasks, those of more than 60 references by doubled steps, all by doubled steps.
WAYS = pytest.mark.parametrize("own_edges", [tool_calls.OWN_EDGES, 60, 0])


@WAYS
def test_status_and_order(spark, own_edges):
    rows = [
        (1, 0, "user", "hello"), (1, 1, "assistant", call("a") + " and " + call("b", ["c"])), (1, 2, "assistant", call("c", ["a"])), (1, 3, "tool", result("c")), (1, 4, "tool", result("a")),
        (1, 5, "assistant", call("d", ["b", "c"])), (1, 6, "tool", result("zzz")), (1, 7, "assistant", call("a")), (1, 8, "tool", result("a")), (1, 9, "assistant", call("e", ["nowhere"])),
        (2, 0, "assistant", call("p", ["q"]) + call("q", ["p"]) + call("r", ["q"]) + call("s", ["s"])), (2, 1, "assistant", call("t", n=9, mode="c", y=1)), (2, 2, "assistant", "<tool_call>{oops</tool_call>"), (2, 3, "tool", "not json"),
        (None, 0, "assistant", call("a")), (None, 1, "tool", result("a")), (3, None, "assistant", None), (3, 1, None, call("a")),
    ]
    out = linked(spark, rows, own_edges=own_edges)
    status = {(r["conv_id"], r["turn"], r["seq"]): r["status"] for r in out}
    assert status[1, 1, 0] == "linked" and status[1, 1, 1] == "unanswered" and status[1, 2, 0] == "linked"
    assert status[1, 6, 0] == "orphan" and status[1, 7, 0] == "duplicate" and status[1, 8, 0] == "duplicate" and status[1, 9, 0] == "invalid"
    assert [status[2, 0, i] for i in range(4)] == ["cycle"] * 4
    assert status[2, 1, 0] == "invalid" and status[2, 2, 0] == "invalid" and status[2, 3, 0] == "orphan" and status[None, 0, 0] == "linked"
    errors = next(r["errors"] for r in out if (r["conv_id"], r["turn"]) == (2, 1))
    assert errors == "arguments.mode: not one of the values; arguments.n: over 5; arguments.y: unknown"
    calls = [r for r in out if r["conv_id"] == 1 and r["kind"] == "call" and r["status"] != "duplicate"]
    order = [r["call_id"] for r in sorted(calls, key=lambda r: (r["ready_turn"], r["ready_seq"], r["wait"], r["call_turn"], r["call_seq"]))]
    assert order == ["a", "c", "b", "d", "e"]


def test_long_chains_of_either_direction(spark):
    back = [(1, i, "assistant", call(f"k{i}", [f"k{i - 1}"] if i else [])) for i in range(60)]
    ahead = [(2, i, "assistant", call(f"k{i}", [f"k{i + 1}"] if i < 5 else [])) for i in range(6)]
    out = linked(spark, back + ahead)
    place = {(r["conv_id"], r["call_id"]): (r["ready_turn"], r["ready_seq"], r["wait"]) for r in out}
    assert all(place[1, f"k{i}"] > place[1, f"k{i - 1}"] for i in range(1, 60))
    assert all(place[2, f"k{i}"] > place[2, f"k{i + 1}"] for i in range(5))
    assert {r["status"] for r in out} == {"unanswered"}


@WAYS
def test_levels_and_waits_by_brute_force(spark, own_edges):
    rng, rows, refs = random.Random(5), [], {}
    for c in range(6):
        rank = rng.sample(range(40), 40)  # references go to calls of less rank, before or after
        for i in range(40):
            below = [j for j in range(40) if rank[j] < rank[i]]
            refs[c, i] = rng.sample(below, min(len(below), rng.choice([0, 1, 1, 2])))
            rows.append((c, i // 2, i, call(f"k{i}", [f"k{j}" for j in refs[c, i]])))
    chain = [(9, i, 0, call(f"k{i}", [f"k{i - 1}"] if i else [])) for i in range(70)]
    refs |= {(9, i): [i - 1] if i else [] for i in range(70)}
    texts = {}
    for c, turn, _, text in rows + chain:
        texts[c, turn] = texts.get((c, turn), "") + text
    out = linked(spark, [(c, turn, "assistant", text) for (c, turn), text in texts.items()], own_edges=own_edges)
    place = {(r["conv_id"], r["call_id"]): (r["call_turn"], r["call_seq"]) for r in out}

    @functools.cache
    def want(c, i):
        own, below = place[c, f"k{i}"], [want(c, j) for j in refs[c, i]]
        ready, wait = max(((b[1], b[2]) for b in below), default=(own, 0))
        return max((b[0] for b in below), default=-1) + 1, max(own, ready), wait + 1 if ready > own else 0

    got = {(r["conv_id"], int(r["call_id"][1:])): (r["level"], (r["ready_turn"], r["ready_seq"]), r["wait"]) for r in out}
    assert got == {key: want(*key) for key in refs} and got[9, 69][0] == 69


def test_deep_odd_and_long_arguments(spark):
    deep = "[" * 900 + "]" * 900
    nest = lambda n: '<tool_call>{"name":"add","id":"d%d","arguments":{"x":%s}}</tool_call>' % (n, "[" * n + '{"$ref":"a"}' + "]" * n)
    rows = [(1, 0, "assistant", call("a")), *((1, n, "assistant", nest(n)) for n in (900, 5000, 20000, 200000)), (1, 2, "tool", '{"tool_call_id":"a","content":%s}' % deep)]
    rows += [(2, i, "assistant", f'<tool_call>{{"name":"add","id":"n{i}","arguments":{{"x":{x}}}}}</tool_call>') for i, x in enumerate(("NaN", "-Infinity", "1e999", "1e300", '"' + "y" * 3_000_000 + '"'))]
    out = {(r["conv_id"], r["turn"]): r for r in linked(spark, rows)}
    assert out[1, 900]["level"] == 1 and out[1, 900]["status"] == "unanswered" and out[1, 2]["status"] == "linked"
    for n in (5000, 20000, 200000):  # read, or refused as a whole, but never a failure
        assert out[1, n]["level"] == 1 or out[1, n]["errors"] == "not a JSON object"
    assert [out[2, i]["errors"] for i in range(5)] == ["not a JSON object"] * 3 + ["", ""]
    assert json.loads(out[2, 3]["json"])["arguments"]["x"] == 1e300 and len(out[2, 4]["json"]) > 3_000_000


def test_types_of_a_schema():
    kinds = {"type": ["string", "null"]}
    assert tool_calls.violations(None, kinds) == [] == tool_calls.violations("a", kinds) == tool_calls.violations(3, {"type": "unheard of"})
    assert tool_calls.violations(3, kinds) == ["arguments: not of type string or null"] and tool_calls.violations(True, {"type": "integer"}) == ["arguments: not of type integer"]


def test_ten_thousand_calls_of_fifty_references():
    n, each, rng = 10_000, 50, np.random.default_rng(3)
    rank = rng.permutation(n)
    at = np.argsort(rank)
    source = np.repeat(np.arange(n), each)
    target = at[(rng.random(n * each) * rank[source]).astype(np.int64)]
    source, target = source[rank[source] > 0], target[rank[source] > 0]
    place = rng.permutation(n)
    level, ready, wait = tool_calls.sorted_calls(source, target, place)
    want = {int(at[0]): (0, int(place[at[0]]), 0)}
    refs = [set(x.tolist()) for x in np.split(target, np.searchsorted(source, np.arange(1, n)))]
    for i in at[1:].tolist():
        below = [want[j] for j in refs[i]]
        latest, waits = max((b[1], b[2]) for b in below)
        want[i] = max(b[0] for b in below) + 1, max(latest, int(place[i])), waits + 1 if latest > place[i] else 0
    assert [(int(level[i]), int(ready[i]), int(wait[i])) for i in range(n)] == [want[i] for i in range(n)]


def test_cycles_and_what_is_behind_them():
    source, target = np.array([0, 1, 2, 3, 5, 6]), np.array([1, 0, 0, 4, 5, 3])
    assert tool_calls.sorted_calls(source, target, np.arange(7))[0].tolist() == [-1, -1, -1, 1, 0, -1, 2]


def test_chain_of_a_thousand_steps(spark):
    n = 1000
    rows = [(1, 0, "assistant", "".join(call(f"k{i}", [f"k{i + 1}"] if i + 1 < n else []) for i in range(n)))]
    out = {r["call_id"]: r for r in linked(spark, rows)}
    assert all(out[f"k{i}"]["level"] == n - 1 - i and out[f"k{i}"]["ready_seq"] == n - 1 and out[f"k{i}"]["wait"] == n - 1 - i for i in range(n))


def test_canonical_json():
    assert tool_calls.canonical({"b": [1, 2.5, None], "a": "é\n\""}) == '{"a":"é\\n\\"","b":[1,2.5,null]}'
    assert tool_calls.canonical("\ud800") == '"\\ud800"'
    for value in ({"z": {"y": [True, {"x": ""}]}}, [], "", 0):
        assert json.loads(tool_calls.canonical(value)) == value


def test_empty_table_and_extra_columns(spark):
    assert linked(spark, []) == []
    df = spark.createDataFrame([(1, 1, "assistant", call("a"), "x", 3)], "conv_id long, turn long, role string, text string, status string, level int")
    assert [r["status"] for r in tool_calls.link_tool_calls(df, TOOLS).collect()] == ["unanswered"]


def test_conversations_of_any_type(spark):
    call = '<tool_call>{"id": "a", "name": "search", "arguments": {"query": "x", "turn": 1}}</tool_call>'
    rows = [("conv-1", 0, "assistant", call), ("conv-1", 1, "tool", '{"tool_call_id": "a", "content": "y"}'), (None, 0, "assistant", call), ("conv-2", 0, "tool", '{"tool_call_id": "a", "content": "y"}')]
    out = tool_calls.link_tool_calls(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"), tool_calls.TOOLS)
    assert out.schema["conv_id"].dataType.simpleString() == "string"
    assert sorted((str(r["conv_id"]), r["kind"], r["status"]) for r in out.collect() if r["status"] != "invalid") == [("None", "call", "unanswered"), ("conv-1", "call", "linked"), ("conv-1", "result", "linked"), ("conv-2", "result", "orphan")]
