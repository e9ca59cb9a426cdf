"""The pipeline over a small table with planted cases, stage by stage and as a whole."""

from __future__ import annotations

import random
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import catalog, gru, jaccard, ragged
from tests.llm.test_jaccard import brute
from tests.llm.test_toxicity import RUDE

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    passage = " ".join(word() for _ in range(60))
    texts, kinds = {}, {}
    for i in range(600):
        words = [word() for _ in range(rng.randrange(70, 160))]
        kind = "plain"
        if i % 5 == 1:
            kind = "toxic"
            for at in range(0, len(words), 18):
                words[at] = rng.choice(RUDE)
        elif i % 30 == 2:
            kind, words = "junk", [w + "%%%" for w in words]
        elif i % 30 == 3:
            kind = "repeat"
            words.insert(7, passage)
        elif i % 30 == 4 and i > 30:
            kind, words = "copy", texts[i - 4].split()
            words[3] = word()
        texts[i], kinds[i] = " ".join(words), kind
    return texts, kinds, passage


@pytest.fixture(scope="module")
def home(spark, tmp_path_factory):
    texts, kinds, _ = corpus()
    folder = Path(tmp_path_factory.mktemp("corpus"))
    docs = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in texts.items()] + [(900, None, None, None, None), (901, "", "en", "s0", 0)]
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(i, int(k == "toxic"), 1) for i, k in kinds.items()], "doc_id bigint, toxic int, quality int").write.parquet(str(folder / "labels.parquet"))
    return str(folder)


@pytest.fixture(scope="module")
def stages(spark, home):
    """What each stage returns on what its predecessor returned."""
    docs, out = catalog.table(spark, home, "documents"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, home).write.parquet(f"{home}/stage{i}")
        docs = spark.read.parquet(f"{home}/stage{i}")
        out.append(docs)
    return out


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_stages_keep_the_columns(spark, home, stages):
    for frame in stages[:-1]:
        assert sorted(frame.dtypes) == sorted(catalog.table(spark, home, "documents").dtypes)


def test_each_stage_removes_what_it_should(stages):
    texts, kinds, passage = corpus()
    toxic = {i for i, k in kinds.items() if k == "toxic"}
    left = ids(stages[0])
    assert len(toxic & left) <= 2 and len(set(texts) - toxic - left) <= 6
    junk = {i for i, k in kinds.items() if k == "junk"}
    rest = ids(stages[1])
    assert left - rest == (junk & left) | ({900, 901} & left)
    classes = brute([(r.doc_id, r.text) for r in stages[1].collect()])
    assert ids(stages[2]) == {component for _, component in classes.values()}
    held = [r for r in stages[3].collect() if r.text and passage in r.text]
    assert len(held) == 1 and ids(stages[3]) == ids(stages[2])
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())
    assert ids(stages[4]) == ids(stages[3])


def test_the_whole_equals_its_stages(spark, home, stages):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    total = lambda frame: (frame.selectExpr("sum(length)").first()[0], frame.select("doc_id", "doc_tokens").distinct().count())
    whole = corpus_pipeline.run(spark, home)
    assert set(key) < set(whole.columns) and total(whole) == total(stages[4])


def test_rows_that_share_an_id_or_lack_one(spark, home):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (None, text, "en", "s", 1), (2, text + " x", None, "s", 1), (3, None, "en", "s", None), (3, "other text", "en", "s", 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    left = corpus_pipeline.drop_near_copies(spark, docs, home).collect()
    assert sorted((r.doc_id or 0) for r in left) == [0, 1, 3]
    assert corpus_pipeline.drop_outliers(spark, docs, home).where("text IS NULL").count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), home).count() == 0


def most_mb(run):
    """Most MB that numpy's and Python's objects took at once."""
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return most


def test_memory_of_the_workers_that_stages_share():
    rng = np.random.default_rng(3)
    projected, tokens = rng.standard_normal((1000, 6 * gru.STATE)).astype(np.float32), rng.integers(0, 1000, (gru.WINDOW, 4096))
    model = gru.initial(np.zeros(4, np.int32), np.zeros(4, np.int32))
    assert most_mb(lambda: gru.forward(model, projected, tokens, np.ones(tokens.shape, bool))) < 40
    text = " ".join("abcdefghi"[: 1 + i % 9] + str(i * i % 10) for i in range(4000))
    count = 2_000_000 // len(text)
    batch = pa.RecordBatch.from_arrays([pa.array(range(count)), pa.array([f"{i} {text}" for i in range(count)])], ["doc_id", "text"])
    ragged._powers.clear()
    assert most_mb(lambda: list(jaccard._scan_sets(iter([batch])))) < 85
