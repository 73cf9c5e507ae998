import json

from cellframe.llm import chat


def call(i, name="search", **args):
    return {"id": i, "name": name, "arguments": args}


def turns():
    a = lambda *calls, content=None: json.dumps({"content": content, "tool_calls": list(calls)})
    r = lambda i, content="ok": json.dumps({"tool_call_id": i, "content": content})
    return [
        (1, 0, "user", "Wetter? ünï"), (1, 1, "assistant", a(call("c2", query="$ref:c1"), call("c1", query="x", limit=3))), (1, 2, "tool", r("c2")), (1, 3, "tool", r("c1")),
        (1, 4, "tool", r("c1", "again")), (1, 5, "tool", r("zz")), (1, 6, "assistant", a(call("c3", limit="no"), call("c4", "nope"), call("c5", query="late"), call(None, query="q"), call("c1", query="x"))),
        (2, 0, "assistant", a(call("p", query="$ref:q"), call("q", query="$ref:p"), call("s", query="$ref:p"), call("t", query="$ref:gone"))), (2, 1, "tool", r("p")),
        (3, 0, "tool", r("e")), (3, 1, "assistant", a(call("e", query="early"))), (4, None, None, None), (None, 1, "tool", r("n")), (5, 0, "assistant", "{broken"), (5, 1, "user", ""),
    ]


def test_links_order_and_faults(spark):
    rows = chat.linked(spark.createDataFrame(turns(), "conv_id long, turn long, role string, text string")).collect()
    by = {}
    for r in rows:
        by.setdefault(r["conv_id"], []).append(r)
    for rs in by.values():
        rs.sort(key=lambda r: r["position"])
        assert [r["position"] for r in rs] == list(range(len(rs)))
    one = [(r["kind"], r["call_id"], r["status"]) for r in by[1]]
    assert one.index(("call", "c1", "ok")) < one.index(("result", "c1", "ok")) and one.index(("call", "c1", "ok")) < one.index(("call", "c2", "ok")) < one.index(("result", "c2", "ok"))
    assert ("result", "c1", "repeated_result") in one and ("result", "zz", "orphan") in one and ("call", "c1", "repeated_id") in one
    assert ("call", "c3", "invalid: $.query: missing") in one and ("call", "c4", "invalid: unknown tool") in one and ("call", "c5", "no_result") in one
    assert ("call", None, "invalid: no identifier") in one
    two = {r["call_id"]: r for r in by[2] if r["kind"] == "call"}
    assert [two[x]["status"] for x in "pqst"] == ["cycle", "cycle", "cycle", "no_result"] and two["t"]["depth"] == 0
    assert [(r["kind"], r["status"]) for r in by[3]] == [("message", "ok"), ("call", "ok"), ("result", "ok")]
    assert json.loads(by[1][0]["json"]) == {"content": "Wetter? ünï", "role": "user"} and "ünï" in by[1][0]["json"]
    assert by[4][0]["json"] == '{"content":null,"role":null}' and by[None][0]["status"] == "orphan"


def test_deep_chain(spark):
    calls = [call("d0", query="x")] + [call(f"d{i}", query=f"$ref:d{i - 1}") for i in range(1, 5)]
    text = json.dumps({"content": "", "tool_calls": calls[::-1]})
    rows = chat.linked(spark.createDataFrame([(1, 0, "assistant", text, "x")], "conv_id long, turn long, role string, text string, status string")).orderBy("position").collect()
    assert [r["call_id"] for r in rows] == [None, "d0", "d1", "d2", "d3", "d4"] and [r["depth"] for r in rows] == [0, 0, 1, 2, 3, 4]


def test_conversations(spark, sf):
    source = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    rows = chat.op6_chat(spark, sf).collect()
    want = {}
    for r in sorted(source, key=lambda r: (r["conv_id"], r["turn"])):
        want.setdefault(r["conv_id"], []).append(json.dumps({"content": r["text"], "role": r["role"]}, ensure_ascii=False, sort_keys=True, separators=(",", ":")))
    got = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["position"])):
        got.setdefault(r["conv_id"], []).append(r["json"])
    assert got == want


def test_many_turns_and_empty(spark):
    many = spark.range(3000).selectExpr("1L as conv_id", "id as turn", "'user' as role", "'t' as text")
    assert [r["position"] for r in chat.linked(many).orderBy("turn").collect()] == list(range(3000))
    assert chat.linked(many.limit(0)).count() == 0


def test_hot_keys_are_cut(spark):
    """One conversation of most rows, without an id, and one identifier that is called and answered over and over."""
    a = json.dumps({"content": None, "tool_calls": [call("again", query="x")]})
    rows = [(None, i % 7, "user", f"t{i % 50}") for i in range(900)] + [(3, i % 5, "assistant", a) for i in range(300)] + [(3, i % 5, "tool", json.dumps({"tool_call_id": "again", "content": i % 9})) for i in range(300)] + [(i, 0, "user", "x") for i in range(100, 140)]
    got = chat.linked(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)).collect()
    by = {}
    for r in got:
        by.setdefault(r["conv_id"], []).append(r)
    for rs in by.values():
        rs.sort(key=lambda r: r["position"])
        assert [r["position"] for r in rs] == list(range(len(rs)))
    assert [(r["turn"], r["json"]) for r in by[None]] == sorted((t, chat.canonical({"content": x, "role": "user"})) for c, t, _, x in rows if c is None)
    status = [r["status"] for r in by[3] if r["kind"] == "call"], [r["status"] for r in by[3] if r["kind"] == "result"]
    assert [s.count("ok") for s in status] == [1, 1] and status[0].count("repeated_id") == status[1].count("repeated_result") == 299


def test_schema_faults():
    schema = {"type": "object", "required": ["a"], "properties": {"a": {"type": "array", "items": {"type": "integer"}}, "b": {"enum": [1, 2]}}}
    assert chat.fault_of({"a": [1, 2]}, schema) is None
    assert chat.fault_of({"a": [1, True]}, schema) == "$.a[1]: not integer"
    assert chat.fault_of({"a": [], "b": 3}, schema) == "$.b: not in enum" and chat.fault_of([], schema) == "$: not object" and chat.fault_of({"a": "$ref:x"}, schema) is None
