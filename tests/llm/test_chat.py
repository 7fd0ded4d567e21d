"""Linking, ordering and validating tool calls."""

from __future__ import annotations

import json

import pytest

from quaylake.llm import chat

CALLS = "conv_id long, call_id string, name string, arguments string, turn long, parent_id string"
RESULTS = "call_id string, content string, turn long"
TOOLS = [
    chat.Tool("add", (chat.Argument("a", "integer", minimum=0), chat.Argument("b", "number", required=False, maximum=9))),
    chat.Tool("say", (chat.Argument("text", "string", max_length=3), chat.Argument("loud", "boolean", required=False))),
    chat.Tool("now", ()),
]


@pytest.fixture()
def run(spark):
    def go(calls, results=()):
        got = chat.format_calls(spark.createDataFrame(list(calls), CALLS), spark.createDataFrame(list(results), RESULTS), TOOLS)
        rows = got.collect()
        assert sum(r["n_rows"] for r in rows) == len(calls) + len(results)
        return {r["call_id"]: r for r in rows if r["status"] != "repeat"}

    return go


def test_links_and_levels(run):
    chain = [(1, f"c{i}", "now", "{}", i, f"c{i - 1}" if i else None) for i in range(20)]
    odd = [(2, "x", "now", "{}", 0, "y"), (2, "y", "now", "{}", 1, "x"), (2, "z", "now", "{}", 2, "y"), (2, "w", "now", "{}", 3, "gone")]
    got = run(chain + odd, [("c3", "late", 9), ("c3", "first", 4), ("lost", None, 1)])
    assert [got[f"c{i}"]["level"] for i in range(20)] == list(range(20))
    assert {k: got[k]["status"] for k in "xyzw"} == {"x": "cycle", "y": "cycle", "z": "cycle", "w": "pending"}
    assert (got["c3"]["status"], got["c3"]["n_results"], json.loads(got["c3"]["json"])["result"]) == ("linked", 2, "first")
    assert (got["lost"]["status"], got["lost"]["conv_id"], got["lost"]["valid"]) == ("orphan", None, False)
    assert None not in got and len(got) == 25


@pytest.mark.parametrize(
    ("name", "arguments", "wrong"),
    [
        ("add", '{"a": 1, "b": 2.5}', ""),
        ("add", '{"b": 10, "a": -1}', "a: below 0; b: above 9"),
        ("add", '{"a": "1", "c": 2}', "a: not of kind integer; c: unknown"),
        ("add", '{"a": null}', "a: missing"),
        ("say", '{"text": "abcd", "loud": 1}', "text: longer than 3; loud: not of kind boolean"),
        ("say", "[1]", "arguments: not an object"),
        ("say", "{broken", "arguments: not JSON"),
        ("say", None, "arguments: missing"),
        ("now", "{}", ""),
        ("fly", "{}", "tool: unknown"),
        (None, "{}", "tool: unknown"),
    ],
)
def test_errors(run, name, arguments, wrong):
    row = run([(1, "c", name, arguments, 0, None)])["c"]
    assert (row["errors"], row["valid"]) == (wrong, wrong == "")


def test_canonical_json(run):
    row = run([(1, "c", "add", ' {"b" : 2 ,\n"a":1, "é": "\\u00e9\\n\\"" }', 0, None)])["c"]
    assert row["json"] == (
        '{"arguments":{"a":1,"b":2,"é":"é\\n\\""},"errors":["é: unknown"],"id":"c","level":0,"name":"add","result":null,"status":"pending"}'
    )


def test_every_row_is_in_the_result(spark):
    calls = [(1, "c", "now", "{}", 5, None), (1, "c", "add", "{}", 2, None), (1, "c", "now", "{}", 5, None), (1, None, "now", "{}", 0, None)]
    results = [("c", "one", 1), ("c", "two", 2), ("c", "two", 2), (None, "lost", 1), (None, "lost", 1), (None, None, None)]
    frames = spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS)
    rows = [(r["call_id"], r["status"], r["name"], json.loads(r["json"])["result"], r["n_calls"], r["n_results"], r["n_rows"])
            for r in chat.format_calls(*frames, TOOLS).collect()]
    assert sorted(rows, key=repr) == sorted(
        [
            ("c", "linked", "add", "one", 3, 3, 2),
            ("c", "repeat", "now", None, 2, 0, 2),
            ("c", "repeat", None, "two", 0, 2, 2),
            (None, "unlinked", "now", None, 1, 0, 1),
            (None, "unlinked", None, "lost", 0, 2, 2),
            (None, "unlinked", None, None, 0, 1, 1),
        ],
        key=repr,
    )


def test_empty(run):
    assert run([]) == {}


def test_conversations(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "hello " * 20, "x"), (1, 1, "assistant", "hi", "x"), (1, 2, "user", None, "x"), (None, 0, "user", "?", "x"), (1, None, "user", "?", "x"), (2, 1, "assistant", "?", "x"),
         (1, 0, "system", "be kind", "x"), (5, None, None, "?", "x"), (5, None, None, "?", "x")],
        "conv_id long, turn long, role string, text string, content string",
    )
    got = chat.format_calls(
        chat.conversation_calls(turns), chat.conversation_results(turns), chat.REPLY_TOOLS, context=chat.conversation_context(turns)
    ).collect()
    assert sum(r["n_rows"] for r in got) == turns.count()
    got = {(r["call_id"], r["status"]): (r["conv_id"], r["level"], r["errors"], r["name"]) for r in got}
    assert got == {
        ("1:0", "linked"): (1, 0, "", "reply"),
        ("1:2", "pending"): (1, 1, "chars: missing; prompt: missing", "reply"),
        ("2:0", "orphan"): (None, None, "call: missing", None),
        ("1:0", "context"): (1, None, "", "system"),
        (None, "context"): (5, None, "", None),
        (None, "unlinked"): got[None, "unlinked"],
    }


def test_very_long_texts_and_a_hot_identifier(spark):
    long = "word " * 200_000
    turns = [(1, 0, "user", long), (1, 1, "assistant", long + "!")] + [(7, 0, "user", f"ask {i % 50} " * 10) for i in range(3000)]
    turns += [(7, 1, "assistant", "same")] * 2000
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)
    rows = chat.format_calls(chat.conversation_calls(df), chat.conversation_results(df), chat.REPLY_TOOLS).collect()
    assert sum(r["n_rows"] for r in rows) == len(turns) and len(rows) == 51
    first = {r["call_id"]: r for r in rows if r["status"] == "linked"}
    assert json.loads(first["1:0"]["json"])["result"] == long + "!" and first["1:0"]["errors"] == "prompt: longer than 400"
    assert (first["7:0"]["n_calls"], first["7:0"]["n_results"], first["7:0"]["n_rows"]) == (3000, 2000, 2060)
