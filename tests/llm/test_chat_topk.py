from __future__ import annotations

import json
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalog, chat, topk
from tests.compare import compare, connect

TOOL = {"t": {"type": "object", "properties": {"x": {"type": "number", "maximum": 1000}}, "required": ["x"]}}
CALLS = "conv bigint, call string, name string, arguments string, after array<string>"
RESULTS = "conv bigint, call string, content string"


def linked(spark, calls, results=()):
    rows = chat.link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(list(results), RESULTS), TOOL).collect()
    return {(r.conv_id, r.call_id): r for r in rows}


def test_calls_are_linked_ordered_and_checked(spark):
    got = linked(
        spark,
        [(1, "a", "t", '{"x":1.50,"b":"é"}', None), (1, "b", "t", '{"x":2}', ["a"]), (1, "c", "t", '{"x":"q"}', ["b"]), (1, "d", "t", '{"x":1e2}', ["a", "c"]),
         (1, "e", "t", "[1]", ["d"]), (1, "f", "t", '{"x":NaN}', ["d", "a"]), (1, "g", "u", "{}", []), (1, "h", "t", None, ["zz"]), (1, "i", "t", '{"x":5000}', ["i"]),
         (2, "a", "t", '{"x":1}', ["b"]), (2, "b", "t", '{"x":1}', ["a"]), (2, "c", "t", '{"x":1}', ["b"]), (2, "j", "t", '{"x":1}', ["a", "k"]), (2, "k", "t", '{"x":1}', []),
         (None, "a", "t", "{}", None), (2, None, "t", "{}", None)],
        [(1, "a", "later"), (1, "a", "first"), (1, "d", None), (9, "z", "orphan")],
    )
    assert {k: r.step for k, r in got.items()} == {
        (1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (1, "d"): 3, (1, "e"): 4, (1, "f"): 4, (1, "g"): 0, (1, "h"): 0, (1, "i"): 0,
        (2, "a"): None, (2, "b"): None, (2, "c"): None, (2, "j"): None, (2, "k"): 0,
    }
    assert {k: r.status for k, r in got.items() if k[0] == 1} == {
        (1, "a"): "ok", (1, "b"): "unanswered", (1, "c"): "invalid", (1, "d"): "ok", (1, "e"): "invalid", (1, "f"): "invalid",
        (1, "g"): "invalid", (1, "h"): "invalid", (1, "i"): "invalid",
    }
    assert got[1, "a"].record == '{"after":[],"arguments":{"b":"é","x":1.5},"id":"a","name":"t","result":"first","step":0}'
    assert got[1, "h"].problems == ["arguments: no JSON", "after: no call zz"]
    assert got[1, "i"].problems == ["$.x: above 1000", "after: the call itself"]
    assert {got[2, c].status for c in "abcj"} == {"cycle"}


def test_long_chains_with_joints(spark):
    calls = [(1, str(i), "t", '{"x":1}', [str(i - 1)] if i else []) for i in range(200)]
    calls[150] = (1, "150", "t", '{"x":1}', ["149", "3"])
    calls[170] = (1, "170", "t", '{"x":1}', ["150", "169"])
    got = linked(spark, calls)
    assert all(got[1, str(i)].step == i for i in range(200))


def test_empty_and_repeated_calls(spark):
    assert linked(spark, []) == {}
    got = linked(spark, [(1, "a", "t", '{"x":2}', None), (1, "a", "t", '{"x":1}', None), (1, "a", "t", '{"x":1}', None)])
    assert json.loads(got[1, "a"].record)["arguments"] == {"x": 1}


def test_canonical_json():
    text = '{"b":[1.0,2.50,1e30,1E-9,true,null],"a":"\\u00e9\\n"}'
    assert chat.canonical(json.loads(text, parse_float=Decimal)) == '{"a":"é\\n","b":[1,2.5,1e30,1e-9,true,null]}'
    assert chat.problems([1, "x"], {"type": "array", "items": {"type": "integer"}}) == ["$[1]: not of type integer"]
    assert chat.problems(True, {"type": "integer"}) and not chat.problems(None, {"type": ["null", "string"]})


def test_arguments_that_no_worker_may_stumble_over(spark):
    deep = '{"x":1,"y":' + "[" * 3000 + "]" * 3000 + "}"
    quoted = '{"x":1,"y":"' + "[" * 3000 + '\\""}'
    rows = {
        "deep": deep, "open": '{"x":' * 5000, "quoted": quoted, "lone": '{"x":1,"\\ud800":"\\udfff!"}', "pair": '{"x":1,"y":"\\ud83d\\ude42"}',
        "power": '{"x":1e99999999999999999999}', "digits": '{"x":1' + "0" * 6000 + "}", "level": '{"x":1,"y":' + "[" * 99 + "]" * 99 + "}",
    }
    got = {k: r for (_, k), r in linked(spark, [(1, k, "t", v, None) for k, v in rows.items()]).items()}
    assert {k: r.problems for k, r in got.items()} == {
        "deep": ["arguments: more than 100 levels"], "open": ["arguments: more than 100 levels"], "quoted": [], "lone": [], "pair": [],
        "power": ["arguments: number out of range"], "digits": ["$.x: above 1000"], "level": [],
    }
    for name in ("deep", "open", "power"):
        assert json.loads(got[name].record)["arguments"] == rows[name]
    for name in ("quoted", "lone", "pair", "level"):
        assert json.loads(got[name].record)["arguments"] == json.loads(rows[name])
    assert "🙂" in got["pair"].record and "\\ud800" in got["lone"].record
    assert json.loads(got["digits"].record, parse_float=Decimal)["arguments"]["x"] == Decimal("1e6000")


def test_numbers_keep_all_digits_and_equal_ones_are_written_alike():
    write = lambda text: chat.canonical(json.loads(text, parse_float=Decimal))
    assert write("0.1234567890123456789012345678901") != write("0.1234567890123456789012345678902")
    for group in (["100", "1e2", "100.0", "1.00E+2"], ["0", "-0.0", "0e9"], ["0.000001", "1e-6", "10e-7"], ["1e21", "1" + "0" * 21], ["-12.5", "-125e-1"], ["0.00000012", "1.2e-7"]):
        assert len({write(g) for g in group}) == 1
        assert all(Decimal(write(group[0])) == Decimal(g) for g in group)


def naive(calls, results):
    """Steps by recursion over one dictionary, answers by lookup."""
    known = {(c, i): [b for b in after or [] if b != i] for c, i, _, _, after in calls}
    answers = {}
    for c, i, content in results:
        answers[c, i] = min(answers.get((c, i), content), content)

    def step(c, i, above=()):
        if i in above:
            return None
        before = [step(c, b, (*above, i)) for b in known[c, i] if (c, b) in known]
        return None if None in before else 1 + max(before, default=-1)

    return {(c, i): (step(c, i), answers.get((c, i))) for c, i in known}


def test_random_calls_equal_a_naive_linker(spark):
    rng = np.random.default_rng(31)
    calls, results = [], []
    for conv in range(60):
        count = int(rng.integers(1, 12))
        for i in range(count):
            # Mostly earlier calls, some unknown, a few later ones, which may close cycles.
            before = [str(b) for b in rng.integers(0, max(i, 1) if rng.random() < 0.9 else count + 2, int(rng.integers(0, 4)))]
            calls.append((conv, str(i), "t", '{"x":1}', before))
            results += [(conv, str(i), f"r{rng.integers(9)}") for _ in range(int(rng.integers(0, 3)))]
    want = naive(calls, results)
    got = {k: (r.step, json.loads(r.record)["result"]) for k, r in linked(spark, calls, results).items()}
    assert got == want and any(s is None for s, _ in got.values())


def test_query_covers_every_user_turn(spark):
    sf = "/root/testdata/sf0.001"
    got = catalog.QUERIES["op9_chat"](spark, sf).collect()
    turns = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    texts = {(t.conv_id, t.turn): t for t in turns}
    users = {k for k, t in texts.items() if t.role == "user"}
    assert {(r.conv_id, int(r.call_id[5:])) for r in got} == users
    for r in got:
        turn = int(r.call_id[5:])
        record, answer = json.loads(r.record), texts.get((r.conv_id, turn + 1))
        assert record["arguments"]["prompt"] == texts[r.conv_id, turn].text
        assert record["result"] == (answer.text if answer and answer.role == "assistant" else None)
        steps = 0
        while (r.conv_id, turn - 2) in users:
            steps, turn = steps + 1, turn - 2
        assert r.step == steps


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score int")


def best(rows, k=10, every=10):
    kept = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.setdefault((i, tuple(float(np.float32(x)) for x in v)))
    points = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in kept]
    out = []
    for q, a in points:
        if q % every == 0:
            scored = sorted(((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in points if i != q))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_top_k_equals_brute_force(spark, lists):
    rng = np.random.default_rng(lists)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 7).round(1 if i % 2 else 0)], 1) for i in range(400)]
    rows += [(401, None, 1), (402, [1.0, None], 1), (403, [float("nan")] * 7, 1), (410, [float("inf")] * 7, 1), (5, rows[5][1], 1), (None, rows[5][1], 1)]
    got = topk.top_k(vectors(spark, rows).repartition(5), F.col("id") % 10 == 0, lists=lists).collect()
    assert sorted(map(tuple, got)) == best(rows)


def test_few_and_huge_and_uneven_vectors(spark):
    rows = [(0, [1e9, 1.0], 1), (1, [3.5e3, -2.0], 1), (2, [0.0], 1), (10, [], 1), (20, [-1.0, 5.0, 9.0], 1)]
    got = topk.top_k(vectors(spark, rows), F.col("id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == best(rows)
    assert topk.top_k(vectors(spark, rows).limit(0), F.col("id") % 10 == 0).count() == 0
    assert topk.top_k(vectors(spark, rows[1:3]), F.col("id") % 10 == 0).count() == 0


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_components_and_products_beyond_a_long(spark, lists):
    rng = np.random.default_rng(70 + lists)
    size = [1.0, 1e5, 1e9, 8e12]
    rows = [(i, [float(size[rng.integers(4)] * s) for s in rng.choice([-1.0, 0.0, 0.5, 1.0], 6)], 1) for i in range(160)]
    rows = [(i, [float(np.float32(x)) for x in v], s) for i, v, s in rows]
    extra = [(200, [1e30] + [0.0] * 5, 1), (201, [0.0] * 5 + [-3e38], 1)]
    kept = {i: [int(np.floor(1024 * x)) for x in v] for i, v, _ in rows}
    want = []
    for q in [i for i in kept if i % 10 == 0]:
        scored = [(-sum(x * y for x, y in zip(kept[q], v, strict=True)), i) for i, v in kept.items() if i != q]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(x for x in scored if abs(x[0]) < 1 << 63)[:10])]
    got = topk.top_k(vectors(spark, rows + extra).repartition(3), F.col("id") % 10 == 0, lists=lists).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_blocks_by_bytes_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "BYTES_AT_ONCE", 400)
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 5)], 1) for i in range(150)]
    got = topk.top_k(vectors(spark, rows).repartition(2), F.col("id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == best(rows)


def test_top_k_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    count, problem = compare(catalog.QUERIES["op10_topk"](spark, sf), connect(sf), catalog.ORACLES["op10_topk"])
    assert not problem and count == 50
