from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tidemark.llm import chunks, ragged


def planted(seed: int, count: int):
    rng = random.Random(seed)
    words = lambda n: ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 9))) for _ in range(n)]
    passages = [" ".join(words(rng.randrange(51, 70))) for _ in range(30)]
    short = [" ".join(words(40)) for _ in range(5)]
    rows, held = [], {}
    for i in range(count):
        body, held[i] = words(rng.randrange(20, 200)), []
        for _ in range(rng.randrange(0, 3)):
            held[i].append(rng.randrange(30))
            body.insert(rng.randrange(len(body)), passages[held[i][-1]])
        if rng.random() < 0.3:
            body.insert(3, rng.choice(short))
        rows.append((i, " ".join(body)))
    return rows, held, passages


def test_passages_are_cut_from_all_but_the_first_document(spark):
    rows, held, passages = planted(4, 150)
    frame = spark.createDataFrame([(*r, len(r[1]), "m") for r in rows], "doc_id bigint, text string, n_chars bigint, mark string").repartition(3)
    out = {r.doc_id: r for r in chunks.repeats(frame).collect()}
    seen, later = set(), set()
    for i, _ in rows:
        for p in held[i]:
            if p in seen:
                later.add(i)
                assert passages[p] not in out[i].text
        seen |= set(held[i])
    assert set(out) == later
    left = {r.doc_id: r for r in chunks.dedup(frame).collect()}
    assert len(left) == 150 and all(r.n_chars == len(r.text) and r.mark == "m" for r in left.values())
    for i, text in rows:
        assert left[i].text == (out[i].text if i in out else text)
        assert all(k < i for k in out[i].kept_in) if i in out else True


def test_nulls_shared_ids_copies_and_huge_words(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text), (1, text), (2, text), (3, None), (None, text), (4, ""), (5, "x" * 90000), (6, "x" * 90000), (7, "Ünicode " + text + " über"), (2, "other " + text)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = sorted(((r.doc_id or 0), r.text) for r in chunks.dedup(frame).collect() if r.text is not None)
    assert left == sorted([(1, text), (1, text), (2, ""), (0, text), (4, ""), (5, "x" * 90000), (6, "x" * 90000), (7, "Ünicode über"), (2, "other ")])
    assert chunks.repeats(frame).count() == 3
    assert chunks.repeats(frame.limit(0)).count() == 0 and chunks.dedup(frame.limit(0)).count() == 0


def test_cuts_resist_insertions():
    rng = np.random.default_rng(1)
    text = " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 9))) for _ in range(400)).encode()
    def pieces(raw):
        data = np.frombuffer(raw, dtype=np.uint8)
        starts, lengths, _, _ = chunks.chunk_places(data, np.array([0, len(data)]))
        return [raw[s : s + n] for s, n in zip(starts, lengths, strict=True)]
    whole, moved = pieces(text), pieces(b"something else before " + text[:700] + b"in between " + text[700:])
    assert b" ".join(whole) == text
    assert len(set(whole) - set(moved)) <= 8 < len(whole)


def test_gear_hash_covers_its_window():
    data = np.random.default_rng(2).integers(0, 256, 300).astype(np.uint8)
    want = [sum(int(chunks._GEAR[data[i - j]]) << j for j in range(min(i + 1, chunks.GEAR_WINDOW))) % (1 << 32) for i in range(300)]
    assert chunks.gear_hashes(data).tolist() == want


def test_text_without_spans():
    assert chunks.cut_text(b"a b c d", [(2, 3)]) == b"a d"
    assert chunks.cut_text(b"a b c d", [(2, 3), (4, 3)]) == b"a "
    assert chunks.cut_text(b"abc", [(0, 3)]) == b""


def repeated_words(rows):
    """For each document, the words in windows of LEAST_WORDS that an earlier document has too."""
    first, out = {}, {}
    split = {i: text.split(" ") for i, text in rows}
    each = lambda i: [(j, tuple(split[i][j : j + chunks.LEAST_WORDS])) for j in range(len(split[i]) - chunks.LEAST_WORDS + 1)]
    for i in sorted(split):
        for _, window in each(i):
            first.setdefault(window, i)
        out[i] = {k for j, window in each(i) if first[window] < i for k in range(j, j + chunks.LEAST_WORDS)}
    return out


def removed_words(frame, rows):
    out = {i: set() for i, _ in rows}
    text = dict(rows)
    for r in chunks.repeats(frame).collect():
        for start, size in r.removed:
            before = len(text[r.doc_id][:start].split())
            out[r.doc_id] |= set(range(before, before + len(text[r.doc_id][start : start + size].split())))
    return out


def test_passages_whose_parts_stand_in_earlier_documents(spark):
    rng = random.Random(11)
    words = lambda n: ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 9))) for _ in range(n)]
    rows = []
    for k in range(30):
        passage = words(rng.randrange(50, 64))
        half, third = len(passage) // 2, len(passage) // 3
        parts = [passage[:half], passage[half:]] if k % 2 else [passage[:third], passage[third : 2 * third], passage[2 * third :]]
        if k % 3 == 0:  # keepers that alternate every few words
            parts += [passage[j : j + 3] for j in range(0, len(passage), 2)]
        rng.shuffle(parts)
        for n, part in enumerate(parts + [passage, passage]):
            rows.append((100 * k + n, " ".join(words(30) + part + words(30))))
    want = repeated_words(rows)
    assert sum(map(bool, want.values())) == 30
    assert removed_words(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), rows) == want


def test_passages_that_touch_in_the_later_document_only(spark):
    rng = random.Random(12)
    words = lambda n: ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 9))) for _ in range(n)]
    rows = []
    for k in range(60):
        a, b, apart = words(60), words(70), words(20)
        rows.append((10 * k, " ".join(a + apart * (k % 2) + b)))
        rows.append((10 * k + 1, " ".join((a + a, b + a, a + b)[k % 3])))
    assert removed_words(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), rows) == repeated_words(rows)


def test_texts_without_cuts(spark):
    text = " ".join("x" * (1 + i % 3) for i in range(120))
    rows = [(1, "ab " * 70 + "end"), (2, "other ab " + "ab " * 60 + "more"), (3, text), (4, "q " + text + " r"), (5, "y" * 70000 + " " + text[:40] + " z"), (6, "y" * 70000 + " " + text[:40] + " z" * 60), (7, "y" * 70000 + " " + text[:40] + " z" * 60)]
    assert removed_words(spark.createDataFrame(rows, "doc_id bigint, text string"), rows) == repeated_words(rows)


def test_columns_of_any_name_stay(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{x} {passage} {x}", "m", i, 2.5, "d") for i, x in enumerate("abc")]
    kind = "doc_id bigint, text string, `_mark` string, `_spans` bigint, `_Doc` double, `a.b c` string"
    got = sorted(chunks.dedup(spark.createDataFrame(rows, kind)).collect())
    assert [tuple(r) for r in got] == [rows[0]] + [(i, f"{x} {x}", "m", i, 2.5, "d") for i, x in ((1, "b"), (2, "c"))]
    assert got[0].__fields__ == ["doc_id", "text", "_mark", "_spans", "_Doc", "a.b c"]


def traced(batch, run):
    """Most MB that a task's arrays took at once while it made all its rows from the batch."""
    ragged._powers.clear()
    tracemalloc.start()
    made = sum(b.num_rows for b in run(iter([batch])))
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return made, most


def test_memory_of_a_task_does_not_follow_its_batch():
    rng = random.Random(13)
    text = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 9))) for _ in range(4000))
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    count = 8_000_000 // len(text)
    windows = pa.array([[{"first": 0, "last": 3950}]] * count, kind)
    batch = pa.RecordBatch.from_arrays([pa.array(range(count)), pa.array([0] * count), windows, pa.array([text] * count)], ["doc", "mark", "windows", "text"])
    made, most = traced(batch, chunks._windows)
    assert made == count * 3951 and most < 32
    assert len(ragged._powers["up"]) <= 1 << 20
