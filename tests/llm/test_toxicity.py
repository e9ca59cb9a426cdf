from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tidemark.llm import gru, toxicity

RUDE = ("clodpate", "numskull", "poltroon")


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(gru, "LEAST_DOCUMENTS", 1)
    batch = gru.batch_of(["a clown b c d", "e f g", "idiot x y z w q", "one"])
    model = gru.initial(*gru._known({0: batch}, np.arange(4)))
    model = {k: v if k.endswith("_at") else v.astype(np.float64) for k, v in model.items()}
    labels, weights = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 1])
    _, grad = gru.gradients(model, *batch, labels, weights)
    for name, value in grad.items():
        at = np.unravel_index(np.argmax(np.abs(value)), value.shape)
        kept, losses = model[name][at], []
        for move in (1e-3, -1e-3):
            model[name][at] = kept + move
            losses.append(gru.gradients(model, *batch, labels, weights)[0])
        model[name][at] = kept
        assert value[at] == pytest.approx((losses[0] - losses[1]) / 2e-3, rel=2e-2, abs=1e-6)


def test_windows_cover_every_word():
    counts = np.array([0, 1, 24, 25, 100, 3])
    first, lengths, text = gru.windows(counts)
    base = np.cumsum(counts) - counts
    for i, n in enumerate(counts.tolist()):
        mine = [(f - base[i], s) for f, s, t in zip(first.tolist(), lengths.tolist(), text.tolist(), strict=True) if t == i]
        assert {w for f, s in mine for w in range(f, f + s)} == set(range(n))
        assert all(b - a <= gru.STRIDE for (a, _), (b, _) in zip(mine, mine[1:], strict=False))


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(500):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(rng.randrange(10, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(1 + len(words) // 25):
                words[rng.randrange(len(words))] = rng.choice(RUDE) + rng.choice(["", ",", "."])
        rows.append((i, " ".join(words), "a"))
        labels.append((i, int(toxic), "b"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int, text string")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables)


def test_held_out_documents_are_told_apart(tables, model):
    truth = {r.doc_id: r.toxic for r in tables[1].collect()}
    got = toxicity.score(tables[0], model).collect()
    assert len(got) == 500
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.93 * len(held)


def test_labels_of_held_out_documents_teach_nothing(tables, model):
    docs, labels = tables
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    again = toxicity.fit(docs, turned)
    assert again.coefficients == model.coefficients


def test_a_rude_word_late_in_a_long_text_counts(spark, model):
    calm = "abab cdcd efef ghgh " * 3000
    frame = spark.createDataFrame([(1, calm), (2, calm + " ".join(RUDE)), (3, None), (4, ""), (5, " \n"), (None, calm)], "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in toxicity.score(frame, model).collect()}
    assert got[2] > got[1] and got[3] == got[4] == got[5] < 0.5 and got[None] == got[1]
    assert toxicity.score(frame.limit(0), model).count() == 0


def test_without_labels_nothing_is_toxic(tables):
    docs, labels = tables
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert toxicity.fit(docs, labels.where("toxic = 0")) is None
    assert toxicity.score(docs, None).where("predicted = 1").count() == 0
    assert toxicity.drop_toxic(docs, None).count() == 500


def test_dropping_keeps_all_columns(tables, model):
    left = toxicity.drop_toxic(tables[0], model)
    bad = {r.doc_id for r in toxicity.score(tables[0], model).where("predicted = 1").collect()}
    assert left.columns == tables[0].columns
    assert {r.doc_id for r in left.collect()} == set(range(500)) - bad
