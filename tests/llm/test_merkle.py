from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tests.compare import compare, connect
from tests.conftest import SF_DIR
from tidemark.llm import catalog, merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, tree int"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def steps(tree: list[list[str]], place: int) -> list[tuple[str, str]]:
    out = []
    for level in tree[:-1]:
        run = place // 16 * 16
        out.append(("".join(level[run:place]), "".join(level[place + 1 : run + 16])))
        place //= 16
    return out


def brute(rows: list[tuple]) -> list[tuple]:
    sources: dict = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in names}
    crown = levels([trees[s][-1][0] for s in names])
    out = []
    for at, name in enumerate(names):
        for place, (_, _, own, row) in enumerate(sorted(sources[name], key=lambda x: x[:3])):
            way = steps(trees[name], place) + steps(crown, at)
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            top = leaf((*row[:4], text))
            for left, right in way:
                top = digest(left + top + right)
            out.append((row[0], own, trees[name][-1][0], crown[-1][0], digest("".join(a + b for a, b in way)), top, top == crown[-1][0]))
    return out


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=str)


def check(spark, rows: list[tuple], parts: int = 3) -> list[tuple]:
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    got = ordered(merkle.verify(frame).collect())
    assert got == ordered(brute(rows))
    return got


def test_query_equals_sql(spark):
    count, problem = compare(catalog.QUERIES["op11_merkle"](spark, SF_DIR), connect(SF_DIR), catalog.ORACLES["op11_merkle"])
    assert count and not problem


def test_runs_of_every_length(spark):
    rng = random.Random(1)
    sizes = [*range(1, 18), 32, 33, 256, 257, 300]
    rows = [(i * 1000 + k, f"s{i}", "en", k, f"Text {rng.random()} É") for i, n in enumerate(sizes) for k in range(n)]
    rng.shuffle(rows)
    got = check(spark, rows)
    assert {r[-1] for r in got} == {True, False}


def test_nulls_empty_texts_ties_and_repeats(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (1, None, "en", 0, ""), (1, None, "en", 0, None),
        (1, "b", "en", 3, "ABC"), (1, "b", "en", 3, "ABC"), (1, "b", "en", 3, "abc"), (2, "", "-", 1, "-"), (3, "É", "", 2, "x" * 200_000),
        (-5, "z", "fr", 9, "\U00010348 Z"), (10, "B", None, 2, "Q"),
    ]
    check(spark, rows)
    check(spark, rows[4:5])
    check(spark, rows[-1:] * 40)


def test_one_source_and_no_rows(spark):
    check(spark, [(i, "only", "en", 1, "T" * i) for i in range(40)])
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.verify(empty).count() == 0
    assert merkle.build(empty.withColumn("d", merkle.F.col("text")), "doc_id", "source", "d").root is None


def test_a_forged_sibling_is_found(spark):
    rows = [(i, "ab"[i % 2], "en", i, f"t{i}") for i in range(50)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    digests = frame.select("doc_id", "source", merkle.leaf({c: merkle.F.col(c) for c in merkle.FIELDS}).alias("own"))
    made = merkle.build(digests, "doc_id", "source", "own")
    found = made.proofs.where("key = 7").first()
    top = found.leaf
    for step in found.path:
        top = digest(step.left + top + step.right)
    assert top == made.root
    assert digest(found.path[0].right + found.leaf + found.path[0].left) != digest(found.path[0].left + found.leaf + found.path[0].right)
    assert {r.source: r.size for r in made.sources.collect()} == {"a": 25, "b": 25}


@pytest.mark.parametrize("name", ["left", "right"])
def test_steps_hold_no_more_than_a_run(spark, name):
    frame = spark.range(100).selectExpr("id AS doc_id", "'s' AS source", "sha2(cast(id AS string), 256) AS own")
    made = merkle.build(frame, "doc_id", "source", "own")
    assert made.proofs.selectExpr(f"max(array_max(transform(path, x -> length(x.{name}))))").first()[0] <= 64 * (merkle.ARITY - 1)
