from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from meterline.llm import tool_calls as t

LOG = "conv_id long, turn long, kind string, call_id string, after string, name string, arguments string, content string, json string, level int"


def log(spark, rows):
    full = [(r.get("conv", 1), r["turn"], r["kind"], r.get("id"), r.get("after"), r.get("name"), r.get("arguments"), r.get("content"), "x", 9) for r in rows]
    return spark.createDataFrame(full, LOG)


def call(turn, id, after=None, name="lookup", arguments='{"key":"k"}', **more):
    return {"turn": turn, "kind": "call", "id": id, "after": after, "name": name, "arguments": arguments, **more}


def result(turn, id, **more):
    return {"turn": turn, "kind": "result", "id": id, **more}


def test_order_puts_dependencies_first(spark):
    # Logged in reverse: c waits for b, b for a.
    rows = [call(1, "c", "b"), result(2, "c"), call(3, "b", "a"), result(4, "b"), call(5, "a"), result(6, "a"), {"turn": 0, "kind": "message"}]
    got = t.link(log(spark, rows)).orderBy("place", "level", "turn").collect()
    order = [(r["kind"], r["call_id"]) for r in got]
    assert order[0] == ("message", None)
    place = {x: k for k, x in enumerate(order)}
    for id in "abc":
        assert place["call", id] < place["result", id]
    assert place["call", "a"] < place["call", "b"] < place["call", "c"]


def test_repeated_calls_wait_for_all_their_calls(spark):
    # c is logged twice; the call it waits for first, a, comes late and waits itself.
    rows = [call(1, "c", "a"), call(2, "c", "b"), call(3, "b"), call(5, "a", "z"), call(6, "z"), result(4, "c")]
    got = t.link(log(spark, rows)).orderBy("place", "level", "turn").collect()
    assert [(r["kind"], r["call_id"]) for r in got] == [("call", x) for x in "bzacc"] + [("result", "c")]
    assert {r["level"] for r in got if r["call_id"] == "c"} == {4, 5}


def test_repeated_calls_by_brute_force(spark):
    # Calls 0 to 119 wait for up to three earlier ones; 120 to 122 for each other, 123 for one of them and for 5.
    waits = {k: {max(0, k - 1 - (k * s) % 9) for s in (0, 5, 7)[:k % 4]} for k in range(1, 120)} | {0: set(), 120: {121}, 121: {122, 3}, 122: {120}, 123: {121, 5}}
    turn = {k: k * 37 % 124 for k in waits}
    rows = [call(turn[k], f"n{k:03}", None if after is None else f"n{after:03}") for k in waits for after in (waits[k] or {None})]
    level, place = {}, {}
    for k in range(120):
        level[k] = max((level[a] + 1 for a in waits[k]), default=0)
        place[k] = max([turn[k], *(place[a] for a in waits[k])])
    got = {int(r["call_id"][1:]): r for r in t.levels(log(spark, rows)).collect()}
    assert {k: (got[k]["level"], got[k]["place"]) for k in range(120)} == {k: (level[k], place[k]) for k in range(120)}
    assert [got[k]["level"] for k in range(120, 124)] == [None] * 4 and len(got) == 124


def test_long_chains_cycles_and_a_hot_call(spark):
    chain = [call(k, f"n{k}", f"n{k - 1}" if k else None, conv=1) for k in range(700)]
    hot = [call(k, f"h{k}", "h0" if k else None, conv=2) for k in range(500)]
    cycle = [call(0, "x", "y", conv=3), call(1, "y", "x", conv=3), call(2, "z", "y", conv=3), result(3, "z", conv=3)]
    got = {(r["conv_id"], r["kind"], r["call_id"]): r for r in t.link(log(spark, chain + hot + cycle)).collect()}
    assert [got[1, "call", f"n{k}"]["level"] for k in (0, 1, 350, 699)] == [0, 2, 700, 1398]
    assert {got[2, "call", f"h{k}"]["level"] for k in range(1, 500)} == {2}
    assert [got[3, "call", x]["level"] for x in "xyz"] == [None] * 3
    assert got[3, "result", "z"]["status"] == "linked"


def test_links(spark):
    rows = [call(0, "a"), result(1, "a"), result(2, "a"), call(3, "b"), result(4, "lost"), call(5, None), result(6, None),
            call(0, "a", conv=None), call(7, "d", "nowhere"), call(8, "a")]
    got = t.link(log(spark, rows)).collect()
    status = sorted((r["turn"], r["kind"], r["status"]) for r in got)
    assert status == [(0, "call", "answered"), (0, "call", "unanswered"), (1, "result", "linked"), (2, "result", "linked"),
                      (3, "call", "unanswered"), (4, "result", "orphan"), (5, "call", "unanswered"), (6, "result", "orphan"),
                      (7, "call", "unanswered"), (8, "call", "answered")]
    assert [r["errors"] for r in got if r["turn"] == 7] == [["after: unknown call"]]


@pytest.mark.parametrize("name, arguments, errors", [
    ("search", '{"query":"x","limit":3}', []),
    ("search", '{"query":"x","limit":0}', ["limit: below 1"]),
    ("search", '{"query":"x","limit":51}', ["limit: above 50"]),
    ("search", '{"query":7,"limit":"3"}', ["limit: not integer", "query: not string"]),
    ("search", '{"limit":2.5}', ["limit: not integer", "query: missing"]),
    ("search", '{"query":null,"limit":1,"zz":1,"aa":2}', ["query: not string", "aa: unknown", "zz: unknown"]),
    ("convert", '{"unit":"mile","value":-1}', ["unit: not allowed", "value: below 0"]),
    ("convert", '{"unit":"word","value":123456789012345678901234}', []),
    ("lookup", '{"key":"k"}', []),
    ("lookup", '{"key":"k","strict":"yes"}', ["strict: not boolean"]),
    ("other", "{}", ["unknown tool"]),
    (None, "{}", ["unknown tool"]),
    ("search", "[1]", ["arguments: not an object"]),
    ("search", "{broken", ["arguments: not an object"]),
    ("search", None, ["arguments: not an object"]),
    ("lookup", '{"key":"a","key":"b"}', ["arguments: not an object"]),
])
def test_validation(spark, name, arguments, errors):
    row = t.link(log(spark, [call(0, "a", name=name, arguments=arguments)])).first()
    assert (row["errors"], row["valid"]) == (errors, not errors)


def test_canonical_json(spark):
    rows = [call(0, "a", arguments='{ "key" : "é\\n\\"", "a": {"z":1, "b":[true, null]} }', content=None), call(1, "b", arguments="{no"), result(2, "a", content="")]
    a, b, r = (x["json"] for x in t.link(log(spark, rows)).orderBy("turn").collect())
    assert a == '{"arguments":{"a":{"b":[true,null],"z":1},"key":"é\\n\\""},"call_id":"a","name":"lookup","role":"call"}'
    assert json.loads(b)["arguments"] == "{no" and r == '{"call_id":"a","content":"","role":"result"}'
    for text in (a, b, r):
        assert text == json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def test_derived_log_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string, name string"
    turns = [(1, 0, "user", "hi", "n"), (1, 1, "assistant", None, "n"), (1, 2, "user", "", "n"), (1, 3, "assistant", 'say "é" \\ now', "n"),
             (None, 1, "assistant", "x", "n"), (2, None, "user", "x", "n"), (2, 1, None, "x", "n"), (1, 3, "assistant", 'say "é" \\ now', "n")]
    got = t.link(t.derive(spark.createDataFrame(turns, schema)))
    assert got.count() == len(turns)
    assert got.filter(F.col("json").isNull()).count() == 0
    assert t.link(t.derive(spark.createDataFrame([], schema))).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
