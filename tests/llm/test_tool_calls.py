import json
import random

from tidemark.llm import tool_calls

CALL = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>, level string"
RESULT = "conv_id long, call_id string, turn long, content string, json string"


def schemas(spark):
    return spark.createDataFrame([(*t, 1) for t in tool_calls.TOOLS] + [("ask", "q", "string", True, 1), ("ask", "o", "object", False, 1),
                                  ("ask", "n", "number", False, 1)],
                                 "name string, param string, type string, required boolean, level int")


def run(spark, calls, results):
    c = spark.createDataFrame([(*x, "l") for x in calls], CALL)
    r = spark.createDataFrame([(*x, "j") for x in results], RESULT)
    return tool_calls.link(c, r, schemas(spark)).collect()


CALLS = [
    (1, "a", 1, "ask", '{"q":"x","o":{"z":1,"b":[{"d":1,"c":"é\\n"}]},"n":1.5}', []),
    (1, "b", 2, "ask", '{"n":"1","p":2}', ["a"]),
    (1, "c", 3, "ask", '{"q":null}', ["a", "b", "b"]),
    (1, "d", 4, "ask", "{broken", ["nowhere"]),
    (1, "e", 5, "ask", "[1]", None),
    (1, "f", 6, "other", '{"q":"x"}', ["g"]), (1, "g", 7, "ask", '{"q":"x"}', ["f"]), (1, "h", 8, "ask", '{"q":"x"}', ["g"]),
    (2, "a", 1, "ask", '{"q":"second"}', ["c"]), (2, "a", 1, "ask", '{"q":"second"}', ["c"]),
    (2, "k", 1, "ask", '{"q":"one"}', []), (2, "k", 2, "ask", '{"q":"two"}', []),
    (None, "a", 1, "ask", '{"q":"no conversation"}', []), (3, None, 1, "ask", '{"q":"x"}', []), (3, None, 1, "ask", '{"q":"x"}', []),
    (3, "n", None, None, None, None), (4, "long", 1, "ask", json.dumps({"q": "w " * 100_000}), []),
]
RESULTS = [(1, "a", 2, "late"), (1, "a", 1, 'early "quoted"\n'), (1, "zz", 9, "lost"), (2, "a", 1, None), (None, "a", 1, "r"),
           (5, None, 1, "nobody's"), (4, "long", 2, "done")]


def test_defined_cases(spark):
    out = run(spark, CALLS, RESULTS)
    assert len(out) == 17
    by = {(r["conv_id"], r["call_id"]): r for r in out if r["call_id"] is not None}
    a = by[1, "a"]
    assert (a["place"], a["step"], a["status"], a["errors"], a["n_results"]) == (1, 0, "ok", "", 2)
    assert a["json"] == ('{"arguments":{"n":1.5,"o":{"b":[{"c":"é\\n","d":1}],"z":1},"q":"x"},"id":"a","name":"ask",'
                         '"result":"early \\"quoted\\"\\n"}')
    assert (by[1, "b"]["place"], by[1, "b"]["errors"]) == (2, "missing:q,type:n,unknown:p")
    assert (by[1, "c"]["place"], by[1, "c"]["errors"], by[1, "c"]["status"]) == (3, "type:q", "invalid")
    assert by[1, "d"]["errors"] == "dependency,json" and json.loads(by[1, "d"]["json"])["arguments"] == "{broken"
    assert by[1, "e"]["errors"] == "json" and by[1, "e"]["step"] == 0
    assert [by[1, x]["errors"] for x in "fgh"] == ["cycle,tool", "cycle", ""]
    assert by[2, "a"]["errors"] == "dependency" and json.loads(by[2, "a"]["json"])["result"] is None
    assert by[2, "k"]["errors"] == "conflict" and json.loads(by[2, "k"]["json"])["arguments"] == {"q": "one"}
    assert by[2, "k"]["status"] == "invalid"
    assert by[None, "a"]["status"] == "ok"
    assert by[3, "n"]["errors"] == "tool" and by[3, "n"]["place"] == 0
    assert by[1, "zz"]["status"] == "orphan_result" and json.loads(by[1, "zz"]["json"])["result"] == "lost"
    assert len(json.loads(by[4, "long"]["json"])["arguments"]["q"]) == 200_000
    loose = [r for r in out if r["call_id"] is None]
    assert sorted((r["conv_id"], r["status"], r["errors"]) for r in loose) == [
        (3, "invalid", "id"), (3, "invalid", "id"), (5, "orphan_result", "")]


def test_long_chains_need_no_rounds(spark, monkeypatch):
    calls = [(1, f"c{i}", i, "ask", '{"q":"x"}', [f"c{i - 1}"] if i else []) for i in range(300)]
    rounds = []
    real = tool_calls.materialize
    monkeypatch.setattr(tool_calls, "materialize", lambda df, tag: rounds.append(tag) or real(df, tag))
    out = {r["call_id"]: r for r in run(spark, calls, [])}
    assert [(out[f"c{i}"]["place"], out[f"c{i}"]["step"]) for i in range(300)] == [(i, 0) for i in range(300)]
    assert {r["status"] for r in out.values()} == {"no_result"} and len(rounds) < 8


def test_forward_chains_need_few_rounds(spark, monkeypatch):
    n = 200
    # a depends on later turns, b on calls of its own turn, c on earlier turns down to one that waits for the last turn
    calls = [(1, f"c{i}", i, "ask", '{"q":"x"}', [f"c{i + 1}"] if i < n else []) for i in range(n + 1)]
    calls += [(2, f"c{i}", 5, "ask", '{"q":"x"}', [f"c{i + 1}"] if i < n else []) for i in range(n + 1)]
    calls += [(3, f"c{i}", i, "ask", '{"q":"x"}', [f"c{i - 1}"] if i else ["last"]) for i in range(n + 1)]
    calls += [(3, "last", 1000, "ask", '{"q":"x"}', [])]
    rounds = []
    real = tool_calls.materialize
    monkeypatch.setattr(tool_calls, "materialize", lambda df, tag: rounds.append(tag) or real(df, tag))
    out = {(r["conv_id"], r["call_id"]): (r["place"], r["step"]) for r in run(spark, calls, [])}
    for i in range(n + 1):
        assert out[1, f"c{i}"] == (n, n - i) and out[2, f"c{i}"] == (5, n - i) and out[3, f"c{i}"] == (1000, i + 1)
    assert rounds.count("tool-places") <= 12 and rounds.count("tool-state") <= 12


def test_a_long_cycle_ends(spark):
    calls = [(1, f"c{i}", 3, "ask", '{"q":"x"}', [f"c{(i + 1) % 7}"]) for i in range(7)]
    calls += [(1, "behind", 3, "ask", '{"q":"x"}', ["c0", "free"]), (1, "free", 3, "ask", '{"q":"x"}', []),
              (1, "self", 3, "ask", '{"q":"x"}', ["self"])]
    out = {r["call_id"]: (r["place"], r["step"]) for r in run(spark, calls, [])}
    assert out.pop("free") == (3, 0) and set(out.values()) == {(3, None)}


def test_calls_and_results_meet_in_a_hash_join(spark):
    c = spark.createDataFrame([(*x, "l") for x in CALLS], CALL)
    r = spark.createDataFrame([(*x, "j") for x in RESULTS], RESULT)
    plan = tool_calls.link(c, r, schemas(spark))._jdf.queryExecution().executedPlan().toString()
    assert any("ShuffledHashJoin" in line and "FullOuter" in line for line in plan.splitlines())


def test_any_graph_is_ordered_topologically(spark):
    rng = random.Random(7)
    calls = []
    for conv in range(30):
        n = rng.randrange(1, 12)
        for i in range(n):
            deps = [f"c{rng.randrange(n)}" for _ in range(rng.randrange(3))]
            if conv % 3:  # no cycles: dependencies of a random order
                deps = [d for d in deps if (int(d[1:]) * 7 + conv) % 13 < (i * 7 + conv) % 13]
            calls.append((conv, f"c{i}", rng.choice([i, 3]), "ask", '{"q":"x"}', deps))
    out = {(r["conv_id"], r["call_id"]): r for r in run(spark, calls, [])}
    for conv, call, turn, _, _, deps in calls:
        me = out[conv, call]
        if conv % 3:
            assert "cycle" not in me["errors"]
        for d in deps:
            if me["step"] is not None and out[conv, d]["step"] is not None:
                key = lambda r: (r["place"], r["step"], r["turn"], r["call_id"])
                assert key(out[conv, d]) < key(me)
    # the longest chain of dependencies at the same place
    for conv in range(30):
        if conv % 3 == 0:
            continue
        own = {c: set(d) for k, c, _, _, _, d in calls if k == conv}
        turns = {c: t for k, c, t, _, _, _ in calls if k == conv}

        def place(c):
            return max([turns[c], *map(place, own[c])])

        def step(c):
            return max([0, *(step(d) + 1 for d in own[c] if place(d) == place(c))])

        assert all((out[conv, c]["place"], out[conv, c]["step"]) == (place(c), step(c)) for c in own)
    # a call has no step if and only if it is in a cycle or behind one at its place
    for conv in range(0, 30, 3):
        own = {c: set(d) for k, c, _, _, _, d in calls if k == conv}
        in_cycle = set()
        for c in own:
            seen, todo = set(), list(own[c])
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += own[x]
            if c in seen:
                in_cycle.add(c)
        none = {c for c in own if out[conv, c]["step"] is None}
        assert in_cycle <= none and (in_cycle or not none)


def test_json_is_canonical(spark):
    for r in run(spark, CALLS, RESULTS):
        parsed = json.loads(r["json"])
        assert json.dumps(parsed, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r["json"]


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    assert [r["status"] for r in run(spark, [], [(1, "a", 1, "x")])] == ["orphan_result"]
    assert [r["status"] for r in run(spark, [(1, "a", 1, "ask", '{"q":"x"}', [])], [])] == ["no_result"]


def test_native_plan(spark):
    c, r = spark.createDataFrame([], CALL), spark.createDataFrame([], RESULT)
    plan = tool_calls.link(c, r, schemas(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
