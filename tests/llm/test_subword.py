from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pytest

from tests.conftest import SF_DIR
from tidemark.llm import catalog, subword
from tidemark.llm.ragged import mix, slice_hashes


def arrays(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)])


def hashed(text: str) -> np.uint64:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return slice_hashes(data, np.array([0]), np.array([len(data)]))[0]


def naive(text: str) -> list[list[int]]:
    """Buckets of words, pairs and runs of characters, one by one."""
    bucket = lambda value, kind: int(mix(np.array([value + np.uint64(kind)]))[0] >> np.uint64(64 - subword.BITS))
    with np.errstate(over="ignore"):
        words = [hashed(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
        runs = [hashed(text[i : i + n]) for n in subword.RUNS for i in range(len(text) - n + 1)]
        return [[bucket(w, 1) for w in words], [bucket(b - a, 2) for a, b in zip(words, words[1:], strict=False)], [bucket(r, 3) for r in runs]]


TEXTS = ["", "one", "one one two", "Äpfel über\tÖl \U00010348", " ", "a b c d e", "x", "héé\n\nhéé", "one one"]


def test_features_equal_naive():
    data, offsets = arrays(TEXTS)
    for kind, (bucket, owner) in enumerate(subword.features(data, offsets)):
        for i, text in enumerate(TEXTS):
            assert sorted(bucket[owner == i].tolist()) == sorted(naive(text)[kind])


def test_scores_equal_naive_softmax():
    rng = np.random.default_rng(1)
    vectors, layer, bias = rng.normal(size=(1 << subword.BITS, 4)), rng.normal(size=(2, 4)), rng.normal(size=2)
    model = subword.Model(vectors @ (layer[1] - layer[0]), bias[1] - bias[0])
    got = model.scores(*arrays(TEXTS))
    for score, text in zip(got, TEXTS, strict=True):
        hidden = sum((np.mean(vectors[b], axis=0) if b else np.zeros(4)) for b in naive(text)) / 3
        line = np.exp(layer @ hidden + bias)
        assert score == pytest.approx(line[1] / line.sum(), abs=1e-9)


def test_repeats_share_a_pair():
    pair = lambda text: naive(text)[1][0]
    assert pair("this this") == pair("that that") != pair("this that")
    assert pair("this that") != pair("that this")


def test_one_step_follows_the_gradient(monkeypatch):
    monkeypatch.setattr(subword, "EPOCHS", 1)
    monkeypatch.setattr(subword, "DECAY", 0.0)
    one = (np.array([3, 9], dtype="<i4"), np.array([0.75, 0.25], dtype="<f4"))
    monkeypatch.setattr(subword, "RATE", 0.0)
    start = subword.train([one, one], np.array([0, 1]))
    monkeypatch.setattr(subword, "RATE", 1e-3)
    end = subword.train([one], np.array([1]))
    hidden = one[1] @ start[0][one[0]]
    line = np.exp(start[1] @ hidden + start[2])
    error = line / line.sum() - np.array([0, 1])
    step = 1e-3 * 0.5
    assert end[1] - start[1] == pytest.approx(-step * np.outer(error, hidden), abs=1e-7)
    assert end[2] - start[2] == pytest.approx(-step * error, abs=1e-7)
    back = error @ start[1]
    assert end[0][one[0]] - start[0][one[0]] == pytest.approx(-step * np.outer([1, 1 / 3], back), abs=1e-7)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(rng.randrange(8, 90))]
        junk = i % 4
        if junk == 0:
            words = [words[0]] * len(words) if i % 8 else [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), "a"))
        labels.append((i, int(junk != 0), "b"))
    return spark.createDataFrame(rows, "doc_id bigint, text string, score string").repartition(3), spark.createDataFrame(labels, "doc_id bigint, quality int, text string")


@pytest.fixture(scope="module")
def model(tables):
    return subword.fit(*tables)


def test_held_out_documents_are_told_apart(tables, model):
    truth = {r.doc_id: r.quality for r in tables[1].collect()}
    got = subword.score(tables[0], model).collect()
    assert len(got) == 600
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_documents_teach_nothing(tables, model):
    docs, labels = tables
    turned = labels.withColumn("quality", subword.F.when(subword.held_out(), 1 - subword.F.col("quality")).otherwise(subword.F.col("quality")))
    again = subword.fit(docs, turned)
    assert again.bias == model.bias and np.array_equal(again.parts, model.parts)


def test_the_end_of_a_long_text_counts(spark, model):
    clean = " ".join("".join(random.Random(i).choice("abcdefgh") for _ in range(5)) for i in range(30_000))
    frame = spark.createDataFrame([(1, clean), (2, clean + " " + "GGG!! " * 60_000), (3, None), (4, ""), (5, " \n"), (None, clean)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in subword.score(frame, model).collect()}
    assert got[2].score < got[1].score == got[None].score and not got[None].held_out
    assert got[3].score == got[4].score and math.isfinite(got[5].score)
    assert subword.score(frame.limit(0), model).count() == 0


def test_without_labels_every_score_is_one(tables):
    docs, labels = tables
    assert subword.fit(docs, labels.limit(0)) is None
    assert subword.fit(docs, labels.where("quality = 1")) is None
    assert subword.fit(docs.limit(0), labels) is None
    assert subword.score(docs, None).where("score = 1 AND predicted = 1").count() == 600


def test_repeated_rows_and_labels_change_nothing(tables, model):
    docs, labels = tables
    again = subword.fit(docs.unionByName(docs), labels.unionByName(labels))
    assert again.bias == model.bias and np.array_equal(again.parts, model.parts)


def test_query_covers_the_table(spark):
    got = catalog.QUERIES["op12_quality_classifier"](spark, SF_DIR)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == catalog.table(spark, SF_DIR, "documents").count()
