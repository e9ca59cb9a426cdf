"""Encoding, decoding, counting and packing against the public libraries."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Regex, Tokenizer, pre_tokenizers

from tidemark.llm import packing, pretoken, token_counts, tokenize
from tidemark.llm.bytebpe import TokenizerFile
from tidemark.llm.ragged import pieces

RANKS = TokenizerFile.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
MERGES = TokenizerFile.read(public_tokenizers.path("byte_bpe_50k.json"))
LETTERS = "ab 'stmdrevl\n\t 12!?é漢　́ſ<|endoftext|>½Ⅷ🙂\x1c\x85\xa0LlRE"
SPECIAL = ["<|endoftext|>", "a<|endoftext|>  <|endoftext|>b's", "", " ", "\n\n", "a" * 3000, "  " * 300 + "x", "'ll'lll", " 'll x 're\n're", "''s", "a'", "%*&" * 900]


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


@pytest.fixture(scope="module")
def merges():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def texts(count: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return SPECIAL + ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(60))) for _ in range(count)]


def encoded(encoder, some: list[str], size: int = 1 << 20) -> list[list[int]]:
    out = []
    for _, data, offsets in pieces(pa.record_batch({"text": pa.array(some, pa.string())}), size=size):
        ids, counts = encoder.encode(data, offsets)
        out += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    return out


def test_ids_equal_those_of_the_libraries(ranks, merges):
    some = texts(3000, 1)
    assert encoded(RANKS.encoder(), some) == [ranks.encode_ordinary(t) for t in some]
    assert encoded(MERGES.encoder(), some, size=500) == [e.ids for e in merges.encode_batch(some, add_special_tokens=False)]


@given(st.lists(st.text(max_size=40), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_ids_and_counts_of_any_text(some):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not hasattr(test_ids_and_counts_of_any_text, "library") else test_ids_and_counts_of_any_text.library
    test_ids_and_counts_of_any_text.library = library
    want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    encoder = MERGES.encoder()
    assert encoded(encoder, some) == want
    (_, data, offsets), = pieces(pa.record_batch({"text": pa.array(some, pa.string())}))
    machine = token_counts._machine(encoder)
    assert token_counts.count_texts(machine, data, offsets).tolist() == [len(w) for w in want]


def test_classes_of_all_code_points(ranks):
    some = ["a" + chr(c) + "1" + chr(c) + " !" + chr(c) for c in range(0, 0x110000, 31) if not 0xD800 <= c < 0xE000]
    assert encoded(RANKS.encoder(), some) == [ranks.encode_ordinary(t) for t in some]


def test_slices_of_all_code_points_are_those_of_the_library():
    """Three contexts per code point, compared slice by slice, as ids may hide a wrong class."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    split = pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated")
    for form in ("a{}b", "1{}2", "!{} {}?"):
        for start in range(0, len(points), 50_000):
            text = "\n".join(form.replace("{}", c) for c in points[start : start + 50_000])
            want = np.array([len(p.encode()) for p, _ in split.pre_tokenize_str(text)])
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            got = pretoken.slices(data, np.array([0, len(data)]))[0]
            assert (got == np.r_[0, np.cumsum(want)[:-1]]).all()


def test_ids_of_random_texts_over_all_planes(ranks, merges):
    rng = random.Random(21)
    new = [c for first, last in (*pretoken.NEW_LETTERS, *pretoken.NEW_NUMBERS) for c in (first, last)]

    def point() -> str:
        plane = rng.random()
        c = rng.choice(new) if plane < 0.2 else rng.randrange(0x3000) if plane < 0.5 else rng.randrange(0x20000) if plane < 0.8 else rng.randrange(0x110000)
        return chr(c) if not 0xD800 <= c < 0xE000 else " "

    some = ["".join(point() for _ in range(rng.randrange(1, 16))) for _ in range(50_000)]
    assert encoded(RANKS.encoder(), some) == [ranks.encode_ordinary(t) for t in some]
    assert encoded(MERGES.encoder(), some) == [e.ids for e in merges.encode_batch(some, add_special_tokens=False)]


def test_scan_does_not_depend_on_the_chunk_length(monkeypatch):
    data = "".join(texts(300, 2)).encode()
    raw, offsets = np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)])
    whole = pretoken.slices(raw, offsets)[0]
    for rows in (1, 3, 64):
        monkeypatch.setattr(pretoken, "ROWS", rows)
        assert (pretoken.slices(raw, offsets)[0] == whole).all()


def test_a_full_cache_and_a_full_machine_start_anew(monkeypatch, merges):
    some = texts(400, 3)
    want = [e.ids for e in merges.encode_batch(some, add_special_tokens=False)]
    monkeypatch.setattr("tidemark.llm.bytebpe.CACHE_SLICES", 10)
    monkeypatch.setattr(token_counts, "MAX_STATES", 10)
    assert encoded(MERGES.encoder(), some, size=300) == want
    machine = token_counts.CountTransducer(MERGES.encoder())
    got = [n for _, d, o in pieces(pa.record_batch({"text": pa.array(some, pa.string())}), size=300) for n in token_counts.count_texts(machine, d, o).tolist()]
    assert got == [len(w) for w in want]


def test_hash_collisions_do_not_change_ids(monkeypatch, ranks):
    monkeypatch.setattr("tidemark.llm.bytebpe.slice_hashes", lambda data, starts, lengths: (starts % 7).astype(np.uint64))
    some = texts(40, 4)
    assert encoded(type(RANKS.encoder())(RANKS), some) == [ranks.encode_ordinary(t) for t in some]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1, "It's 1 <|endoftext|> text", "x", 1), (2, None, None, None), (2, None, None, None), (None, "", "y", 2), (3, "long " * 30000, "z", 3)]
    return spark.createDataFrame(data, "doc_id bigint, text string, ids string, n_tokens int")


def test_round_trip_of_a_table(rows, ranks):
    got = {(r.doc_id, r.n_tokens): r for r in tokenize.round_trip(rows, RANKS).collect()}
    for text, key in (("It's 1 <|endoftext|> text", 1), ("", 2), ("", None), ("long " * 30000, 3)):
        ids = ranks.encode_ordinary(text)
        row = got[key, len(ids)]
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert tokenize.round_trip(rows, RANKS).count() == 5
    assert tokenize.round_trip(rows.limit(0), RANKS).count() == 0


def test_encode_keeps_offsets_and_decode_gives_the_bytes(rows):
    encoded_rows = tokenize.encode(rows, RANKS)
    first = encoded_rows.where("doc_id = 1").first()
    assert first.ends[-1] == len("It's 1 <|endoftext|> text") and len(first.ends) == len(first.ids)
    back = sorted((r.doc_id or 0, bytes(r.bytes).decode()) for r in tokenize.decode(encoded_rows, RANKS).collect())
    assert back == sorted((r.doc_id or 0, r.text or "") for r in rows.collect())


def test_counts_of_a_table(rows, merges):
    got = token_counts.token_counts(rows, MERGES, 512).collect()
    for r in got:
        text = {1: "It's 1 <|endoftext|> text", 3: "long " * 30000}.get(r.doc_id, "")
        n = len(merges.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text), n, n > 512)
    assert len(got) == 5 and token_counts.token_counts(rows.limit(0), MERGES, 5).count() == 0


def check_packing(pieces_, documents: dict, merges, capacity: int, most_open: int) -> None:
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for p in pieces_:
        by_sequence[p.sequence_id].append(p)
        by_document[p.doc_id].append(p)
    assert set(by_document) == set(documents)
    for document, parts in by_document.items():
        ids = np.array(merges.encode(documents[document], add_special_tokens=False).ids + [0], dtype="<u4")
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    partial = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        partial += at < capacity
    assert partial <= most_open


def test_packing_of_a_table(spark, merges):
    rng = random.Random(5)
    documents = {i: " ".join(rng.choice(["word", "über", "x", "1234"]) for _ in range(rng.randrange(0, 300))) for i in range(150)}
    documents[150] = ""
    frame = spark.createDataFrame([(k, v if v else None, "d") for k, v in documents.items()], "doc_id bigint, text string, length string").repartition(3)
    got = packing.pack(frame, MERGES, capacity=128).collect()
    check_packing(got, documents, merges, 128, 3)
    assert packing.pack(frame.limit(0), MERGES).count() == 0
    assert packing.pack(frame.where("doc_id = 150").union(frame.where("doc_id = 150")), MERGES).count() == 2


def test_a_remainder_goes_where_the_sum_of_squares_is_least():
    rng = np.random.default_rng(1)
    for _ in range(300):
        packer = packing.Packer(12)
        packer.levels[1:12] = rng.integers(0, 4, 11)
        size = int(rng.integers(1, 12))

        def total(level):
            after = packer.levels.copy()
            if level:
                after[level] -= 1
            after[level + size] += level + size < 12
            return int((after[1:12] ** 2).sum())

        choices = [0, *(h for h in range(1, 13 - size) if packer.levels[h])]
        best = packer.best_level(size)
        assert best in choices and total(best) == min(map(total, choices))
