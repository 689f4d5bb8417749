import json

from reportlake.operators import chatlog
from reportlake.sources.parquet import table
from conftest import SF


def test_flatten_tool_calls(spark):
    msgs = [
        {"role": "system", "content": "sys"},
        {"role": "user", "content": "how many?"},
        {"role": "assistant", "content": None, "tool_calls": [
            {"id": "c1", "type": "function", "function": {"name": "count", "arguments": "{}"}},
            {"id": "c2", "type": "function", "function": {"name": "schema", "arguments": "{\"t\": 1}"}},
            {"id": "c3", "type": "function", "function": {"name": "never", "arguments": "{}"}}]},
        {"role": "tool", "tool_call_id": "c2", "content": "cols"},
        {"role": "tool", "tool_call_id": "c1", "content": "42"},
        {"role": "assistant", "content": ""},
        {"role": "assistant", "content": "42 rows"},
    ]
    df = spark.createDataFrame([("s1", json.dumps(msgs))], "session_id string, messages string")
    out = chatlog.flatten_messages(df).orderBy("pos", "sub").collect()
    assert [(r["role"], r["content"], r["tool_name"]) for r in out] == [
        ("user", "how many?", None), ("tool", "42", "count"), ("tool", "cols", "schema"),
        ("tool", "", "never"), ("assistant", "42 rows", None)]


def test_titles(spark):
    conv = table(spark, SF, "conversations")
    t = chatlog.session_titles(conv)
    assert t.where("length(title) > 50").count() == 0
    idx = chatlog.session_index(conv).collect()
    assert [r["conv_id"] for r in idx] == sorted((r["conv_id"] for r in idx), reverse=True)


def test_results_go_to_the_latest_open_call(spark):
    """Against the reference's rule played through on a list: sessions of random calls and results, some results empty."""
    import random

    rnd = random.Random(5)
    sessions, want = [], {}
    for s in range(12):
        msgs, cards = [], []
        for i in range(rnd.randrange(0, 60)):
            if rnd.random() < 0.55:
                calls = [{"id": f"{s}-{i}-{k}", "type": "function", "function": {"name": f"f{i}", "arguments": f"{k}"}} for k in range(rnd.randrange(0, 4))]
                msgs.append({"role": "assistant", "content": None, "tool_calls": calls})
                cards += [[i, k, ""] for k in range(len(calls))]
            else:
                content = rnd.choice(["", None, f"r{i}", f"r{i}", f"r{i}"])
                msgs.append({"role": "tool", "tool_call_id": "c", "content": content})
                for card in reversed(cards):
                    if not card[2]:
                        card[2] = content or ""
                        break
        sessions.append((f"s{s}", json.dumps(msgs)))
        want |= {(f"s{s}", i, k): c for i, k, c in cards}
    df = spark.createDataFrame(sessions, "session_id string, messages string")
    got = {(r["session_id"], r["pos"], r["sub"]): r["content"] for r in chatlog.flatten_messages(df, pairing="latest").collect()}
    assert got == want
    used = [c for c in got.values() if c]
    assert len({(k[0], c) for k, c in got.items() if c}) == len(used)  # each result once


def test_repeated_result_ids_do_not_multiply_rows(spark):
    msgs = [{"role": "assistant", "tool_calls": [{"id": "a", "type": "function", "function": {"name": "f", "arguments": ""}}]},
            {"role": "tool", "tool_call_id": "a", "content": "first"}, {"role": "tool", "tool_call_id": "a", "content": "again"}]
    df = spark.createDataFrame([("s", json.dumps(msgs))], "session_id string, messages string")
    assert [r["content"] for r in chatlog.flatten_messages(df).collect()] == ["first"]
