from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.compare import compare, connect
from tests.conftest import SF_DIR
from tidemark.llm import catalog, lexical

DOCS = "doc_id bigint, text string, key int, score bigint, item_id int"
ITEMS = "item_id bigint, text string, place int, doc_id int"


def terms(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs: list[tuple], items: list[tuple], k: int) -> list[tuple]:
    counts = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, length = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for (doc, c), n in zip(counts, sizes, strict=True):
            score = 0
            for term, times in Counter(terms(text)).items():
                if c[term]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * weight * (1000000000 * c[term] // (1000 * c[term] + 12 * (75 + 25 * n * n_docs // length)))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def check(spark, docs: list[tuple], items: list[tuple], k: int = 20, parts: int = 4, **kwargs) -> list[tuple]:
    frame = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], DOCS).repartition(parts)
    asked = spark.createDataFrame([(*i, 1, 2) for i in items], ITEMS)
    got = sorted((tuple(r) for r in lexical.search(frame, asked, k, **kwargs).collect()), key=str)
    assert got == brute(docs, items, k)
    return got


def test_query_equals_sql(spark):
    count, problem = compare(catalog.QUERIES["op13_lexical"](spark, SF_DIR), connect(SF_DIR), catalog.ORACLES["op13_lexical"])
    assert count and not problem


def corpus(rng: random.Random, count: int) -> list[tuple]:
    words = [f"w{i}" for i in range(200)]
    shares = [1 / (i + 1) for i in range(200)]
    return [(i, " ".join(rng.choices(words, shares, k=rng.choice([3, 20, 200])))) for i in range(count)]


@pytest.mark.parametrize("segment", [1, 500, 1 << 20])
def test_scores_equal_brute_force(spark, segment):
    rng = random.Random(7)
    docs = corpus(rng, 400)
    items = [(i, " ".join(f"w{rng.randrange(200)}" for _ in range(rng.randrange(1, 30)))) for i in range(25)]
    check(spark, docs, items, segment=segment)
    check(spark, docs, items[:3], k=1, segment=segment)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 40)
    rng = random.Random(8)
    check(spark, corpus(rng, 60), [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(15))) for i in range(9)])


def test_nulls_ties_and_letters(spark):
    docs = [
        (None, "Ärger über x1"), (5, "ärger"), (3, "a-b_c A.B c"), (4, None), (6, ""), (7, " !?"), (9, "x1 x1 X1"), (9, "x1 x1 X1"),
        (2, "x1 x1 X1"), (8, "é\U00010348z"), (10, "tail " * 50_000 + "x1"), (None, "x1 x1 X1"),
    ]
    items = [(1, "X1"), (1, "X1"), (None, "b c"), (2, None), (3, ""), (4, "nowhere"), (5, "É é\U00010348z ärger Ärger x1 x1"), (6, "c"), (7, "tail")]
    check(spark, docs, items)
    check(spark, docs, items, k=2)


def test_equal_scores_go_by_id(spark):
    docs = [(i, "same words here") for i in range(300, 0, -1)] + [(1000 + i, f"other {i}") for i in range(300)]
    got = check(spark, docs, [(1, "same here")], parts=7, segment=10)
    assert sorted(r[2] for r in got) == list(range(1, 21))


def test_empty_tables(spark):
    check(spark, [], [(1, "a")])
    check(spark, [(1, "a"), (2, "b")], [])
    check(spark, [(1, None)], [(1, "a")])


@pytest.mark.parametrize("depth", [1, 3])
def test_reading_by_turns_equals_reading_all(monkeypatch, depth):
    monkeypatch.setattr(lexical, "DEPTH", depth)
    rng = np.random.default_rng(depth)
    for trial in range(60):
        docs, count = int(rng.integers(1, 80)), int(rng.integers(1, 9))
        held = np.argwhere(rng.random((docs, count)) < rng.random(count))
        impacts = rng.integers(1, 6 if trial % 2 else 1000, len(held))
        missing = rng.random(docs) < 0.1
        keys = np.where(missing, 0, rng.permutation(docs))
        segment = lexical.Segment(keys, missing, held[:, 0], held[:, 1], impacts, count)
        terms_, weights, k = np.flatnonzero(rng.random(count) < 0.8), rng.integers(0, 5, count), int(rng.integers(1, 8))
        full = np.zeros(docs, dtype=np.int64)
        for (d, t), x in zip(held, impacts, strict=True):
            full[d] += weights[t] * x if t in terms_ else 0
        order = [d for d in np.lexsort((keys, missing, -full)) if full[d] > 0][:k]
        kth = int(full[order[-1]]) if len(order) == k else 0
        for bar in {0, kth}:
            found, scores = segment.best(terms_, weights[terms_], k, bar)
            assert [(int(keys[d]), int(s)) for d, s in zip(found, scores, strict=True)] == [(int(keys[d]), int(full[d])) for d in order]


def test_slices_that_only_share_a_hash_are_no_terms(monkeypatch):
    vocabulary = lexical.Vocabulary([b"one", b"three"])
    data = np.frombuffer(b"onetwothree", dtype=np.uint8)
    starts, lengths = np.array([0, 3, 6]), np.array([3, 3, 5])
    assert vocabulary.find(data, starts, lengths).tolist() == [0, -1, 1]
    monkeypatch.setattr(lexical, "slice_hashes", lambda d, s, n: np.full(len(s), vocabulary.hashes[0]))
    first = int(vocabulary.order[0])
    assert vocabulary.find(data, starts, lengths).tolist() == [0 if first == 0 else -1, -1, 1 if first == 1 else -1]
