from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tidemark.llm import quality
from tidemark.llm.ragged import pieces


def brute(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if found[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_brute_force():
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "b", " ", "\n", "é", "#", "\r", "a b a b a b a b\n"]) for _ in range(rng.randrange(80))) for _ in range(1500)]
    texts += ["", "\n", "a", " ", "\n\na\na\n"]
    got = []
    for _, data, offsets in pieces(pa.record_batch({"text": pa.array(texts)}), size=900):
        counts = quality.text_statistics(data, offsets)
        got += list(zip(*(counts[c].tolist() for c in quality._COUNTS[:5]), strict=True))
    assert got == [brute(t) for t in texts]


def documents(count: int):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 10)))
    rows = []
    for i in range(count):
        words = [word() for _ in range(rng.randrange(40, 200))]
        bad = i % 20 == 0
        rows.append((i, " ".join(w + "%%%" for w in words) if bad else " ".join(words), ("en", "fr", None)[i % 3], f"s{i % 2}", "x"))
    return rows


def test_outliers_go_and_others_stay(spark):
    rows = documents(900)
    frame = spark.createDataFrame(rows + [(1000, None, "en", "s0", "x"), (1001, "too short", "en", "s0", "x"), (1002, "a b c d e f g h " * 9, None, None, "x")], "doc_id bigint, text string, lang string, source string, kept string")
    got = {r.doc_id: r for r in quality.judge(frame).collect()}
    assert len(got) == 903
    for i, *_ in rows:
        assert not got[i].base_failed and got[i].kept == (i % 20 != 0)
    assert got[1000].n_words == 0 and got[1000].base_failed and not got[1000].kept
    assert got[1001].base_failed and got[1002].base_failed


def test_small_groups_are_pooled_and_few_rows_are_not_judged(spark):
    rows = documents(240)
    schema = "doc_id bigint, text string, lang string, source string, kept string"
    spread = spark.createDataFrame([(i, t, l, f"s{i % 60}", x) for i, t, l, _, x in rows], schema)
    assert {r.doc_id for r in quality.judge(spread).where("NOT kept").collect()} == {i for i in range(0, 240, 20)}
    few = quality.judge(spread.limit(30)).collect()
    assert all(r.distance is None and r.kept for r in few)
    assert quality.judge(spread.limit(0)).count() == 0


def test_small_leftovers_are_judged_by_their_language_or_all(spark):
    rows = [(i, t, "en", "web", x) for i, t, _, _, x in documents(400)]
    more = [t for _, t, *_ in documents(60)]
    rows += [(1000 + i, t, "en", "blog", "x") for i, t in enumerate(more[:21])]
    rows += [(2000 + i, t, "de", None, "x") for i, t in enumerate(more[20:42])]
    # Null source and language stay apart from the pool of a language.
    rows += [(3000 + i, t, "en", None, "x") for i, t in enumerate([t for _, t, *_ in documents(120)])]
    schema = "doc_id bigint, text string, lang string, source string, kept string"
    got = quality.judge(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows) and all(r.distance is not None for r in got if not r.base_failed)
    assert {r.doc_id for r in got if not r.kept} == {i for i, t, *_ in rows if "%%%" in t}


def test_estimate_is_near_that_of_the_clean_rows(spark):
    rng = np.random.default_rng(4)
    size = len(quality.DRAWS)
    clean = rng.normal(0.5, 3, (800, size))
    dirty = rng.normal(50, 1, (150, size))
    rows = spark.createDataFrame([(i, "g", False, x.tolist()) for i, x in enumerate(np.r_[clean, dirty])], "doc_id bigint, g string, base_failed boolean, x array<double>")
    got = quality.estimates(rows).first()
    assert np.abs(np.array(got.m) - clean.mean(axis=0)).max() < 0.5
    inverse = np.array(got.w).reshape(size, size)
    assert np.abs(np.linalg.inv(inverse) - np.cov(clean.T)).max() < 1.5


def naive_estimate(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = x.shape[1]
    far = lambda m, w: np.einsum("ni,ij,nj->n", x - m, w, x - m)

    def moments(rows):
        cover = np.cov(rows.T, bias=True)
        cover[np.diag_indices(size)] = 1.001 * np.maximum(np.diag(cover), 1)
        return rows.mean(axis=0), cover

    m = np.quantile(x, 0.5, axis=0, method="inverted_cdf")
    s = np.maximum(1.4826 * np.quantile(np.abs(x - m), 0.5, axis=0, method="inverted_cdf"), 1)
    z = (x - m) / s
    found = []
    for start in range(3):
        moved = (None, m + s * np.tanh(z), m + s * z * np.sqrt(size) / np.linalg.norm(z, axis=1)[:, None])[start]
        centre, cover = (m, np.diag(s**2)) if moved is None else moments(moved)
        for _ in range(quality.STEPS):
            d = far(centre, np.linalg.inv(cover))
            centre, cover = moments(x[d <= np.quantile(d, quality.SUPPORT, method="inverted_cdf")])
        found.append((np.linalg.det(cover), start, centre, cover))
    _, _, centre, cover = min(found, key=lambda f: f[:2])
    d = far(centre, np.linalg.inv(cover))
    wide = max(1, np.quantile(d, 0.5, method="inverted_cdf") / quality.chi_square(0.5, size))
    return moments(x[d <= quality.chi_square(0.975, size) * wide])


def test_estimate_equals_a_naive_one(spark):
    rng = np.random.default_rng(9)
    size, rows, want = len(quality.DRAWS), [], {}
    for g in "ab":
        x = rng.normal(0, 2, (400, size)) @ rng.normal(0, 1, (size, size))
        x[:90] = rng.normal(12, 1, (90, size))
        x[:, 1] *= g == "b"
        want[g] = naive_estimate(x)
        rows += [(i, g, False, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "doc_id bigint, g string, base_failed boolean, x array<double>")
    for r in quality.estimates(frame).collect():
        assert np.allclose(r.m, want[r.g][0]) and np.allclose(np.linalg.inv(np.array(r.w).reshape(size, size)), want[r.g][1])


def test_gross_outliers_in_tight_statistics_are_rejected(spark):
    """No clean document has a symbol or an equal line; a few have very many."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(3, 9)))
    line = lambda: " ".join(word() for _ in range(6))
    rows = [(i, "\n".join(line() for _ in range(rng.randrange(20, 90)))) for i in range(400)]
    for i in range(400, 410):
        # Short lines, equal ones apart, so that windows of eight words do not repeat.
        lines = [f"{word()} {word()} {word()} {word()} {word()}" for _ in range(32)]
        same = [word()] * 58
        rows.append((i, "\n".join(x for pair in zip(lines + [line() for _ in range(26)], same) for x in pair)))
    for i in range(410, 420):
        words = [word() for _ in range(300)]
        rows.append((i, "\n".join(" ".join(w + "%" * (k % 6 == 0) for k, w in enumerate(words[j : j + 6])) for j in range(0, 300, 6))))
    # One symbol, or one line twice in a short text, is chance.
    rows.append((420, "\n".join([line() for _ in range(30)] + ["a%b " + line()])))
    rows.append((421, "\n".join([*(line() for _ in range(9)), "and so", "and so"])))
    frame = spark.createDataFrame([(i, t, "en", "web") for i, t in rows], "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judge(frame).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == set(range(400, 420))


def test_quantiles_of_chi_square():
    assert abs(quality.chi_square(0.975, 6) - 14.449) < 0.05 and abs(quality.chi_square(0.5, 6) - 5.348) < 0.02
