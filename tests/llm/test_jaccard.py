from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import combinations

import pytest

from tests.compare import compare, connect
from tidemark.llm import catalog, jaccard
from tidemark.llm.joins import components


def shingles(text: str | None) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows: list[tuple]) -> dict:
    """Number of shingles and least linked id per row, by comparing all pairs that share one."""
    sets, lists, shared = {i: shingles(t) for i, t in rows}, defaultdict(list), defaultdict(int)
    for i, one in sets.items():
        for s in one:
            lists[s].append(i)
    for found in lists.values():
        for a, b in combinations(found, 2):
            shared[a, b] += 1
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), common in shared.items():
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited(rng: random.Random, count: int) -> list[tuple]:
    rows: list[tuple] = []
    for i in range(count):
        if rows and rng.random() < 0.7:
            words = rng.choice(rows[-60:])[1].split()
            for _ in range(rng.randrange(0, 3)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice("abcdefgH")
        else:
            words = [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 60 if rng.random() < 0.4 else 14))]
        rows.append((3 * i + 7, "\t".join(words)))
    return rows


def test_components_equal_brute_force(spark):
    rows = edited(random.Random(3), 500)
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, n int, key int").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_components(frame).collect()}
    assert got == brute(rows)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_components(frame).collect()}
    assert got == brute(rows)


def test_nulls_repeated_rows_and_shared_ids(spark):
    text = "one two three four five six seven eight nine"
    rows = [(5, text), (5, text), (2, text.upper()), (7, None), (8, ""), (8, "other words here"), (9, "OTHER words here"), (None, text), (4, "a b")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jaccard.join_components(frame).collect())
    assert got == sorted([(-1, 5, None), (2, 5, 2), (5, 5, 2), (5, 5, 2), (7, 0, 7), (8, 0, 8), (8, 1, 8), (9, 1, 8), (4, 1, 4)], key=lambda x: (x[0], x[1]))
    assert jaccard.join_components(frame.limit(0)).count() == 0


def test_texts_of_a_shared_id_link_whatever_else_it_has(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = b.replace("b20", "other")
    rows = [(3, a), (7, a), (7, b), (9, near), (11, c), (12, c), (12, near + " more")]
    for parts in (1, 4):
        frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
        assert {(r.doc_id, r.component_id) for r in jaccard.join_components(frame).collect()} == {(i, 3) for i, _ in rows}


def test_shared_ids_equal_brute_force(spark):
    rng = random.Random(19)
    rows = [(rng.randrange(120), text) for _, text in edited(rng, 300)]
    # Rows of one id are linked: a pair of rows that share an id, or are similar.
    found = brute([(i, t) for i, (_, t) in enumerate(rows)])
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for row, (size, other) in found.items():
        if size:
            low, high = sorted((root(rows[row][0]), root(rows[other][0])))
            parent[high] = low
    want = sorted((i, found[n][0], root(i) if found[n][0] else i) for n, (i, _) in enumerate(rows))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert sorted(tuple(r) for r in jaccard.join_components(frame).collect()) == want


@pytest.mark.parametrize("boundary", [0, 5, 9])
def test_small_and_large_meet_at_any_boundary(spark, monkeypatch, boundary):
    monkeypatch.setattr(jaccard, "choose_boundary", lambda sizes: boundary)
    rows = edited(random.Random(11), 250)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_components(frame).collect()} == brute(rows)


def test_boundary_weighs_both_costs():
    assert jaccard.choose_boundary({}) == 0
    assert jaccard.choose_boundary({5: 100, 6: 100}) >= 6
    assert jaccard.choose_boundary({12: 100}) < 12


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 40)}}


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    count, problem = compare(catalog.QUERIES["op8_jaccard"](spark, sf), connect(sf), catalog.ORACLES["op8_jaccard"])
    assert not problem and count == 200
