"""Packing: every id in exactly one place, against the tokenizer's own ids, and padding."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roomgrid.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, doc string, start string, length long, ids string, number long"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def words():
    return P.WordIds(PATH)


def _ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes()


NASTY = [
    "", " ", "Hello, World!", "it's we'LL I'd 'tis", "ÉCOLE straße ΑΣ ΑΣΑ İ ǅ", "é ́a á", "12 3.4x5 ①", "a\tb\r\nc\x0bd\x1ce f g",
    "<|endoftext|> x<|startoftext|>y <|end", "漢字かな \U0001f600\U0001f600 ñ", "œuvre ŒUVRE ªº µ", "a--b ((x)) ''' \"q\"", "x" * 5000, "﻿bom ​zero", "!!! ... ,,, |",
]


def test_words_give_the_ids_of_the_text(tokenizer, words):
    for text in [*NASTY, " ".join(NASTY), "\n".join(NASTY)]:
        assert words.encode([text])[0] + b"\x01\0\0\0" == _ids(tokenizer, text), text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert _WORDS.encode([text])[0] + b"\x01\0\0\0" == _ids(_TOKENIZER, text)


_WORDS, _TOKENIZER = P.WordIds(PATH), Tokenizer.from_file(PATH)


def test_a_full_cache_is_emptied(tokenizer, monkeypatch):
    monkeypatch.setattr(P, "_CACHE", 8)
    small = P.WordIds(PATH)
    texts = [f"one two{k} three{k % 3} four five six seven eight nine ten{k}" for k in range(30)]
    assert [x + b"\x01\0\0\0" for x in small.encode(texts)] == [_ids(tokenizer, t) for t in texts]


def test_a_tokenizer_that_looks_across_blanks():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, words = Tokenizer.from_file(path), P.WordIds(path)
    texts = ["one two", " lead", *NASTY, None]
    assert words.encode(texts) == [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


def check(rows, texts, tokenizer, window):
    """texts: bag of (doc, text). Returns the padded share."""
    want = defaultdict(list)
    for doc, text in texts:
        want[doc, len(_ids(tokenizer, text)) // 4].append(_ids(tokenizer, text))
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
    assert set(pieces) == set(want)
    for key, got in pieces.items():
        n = key[1]
        cover = np.zeros(n, dtype=int)
        for start, length, _ in got:
            cover[start : start + length] += 1
        assert (cover == len(want[key])).all()
        possible = [{zlib.crc32(ids[4 * s : 4 * (s + length)]) for ids in want[key]} for s, length, _ in got]
        assert all(crc in some for (_, _, crc), some in zip(got, possible))
    padded = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        total += at
        padded += 0 if at & (at - 1) == 0 else window - at
    return padded / max(1, total)


@pytest.mark.parametrize("window", [64, 2048])
def test_documents(spark, tokenizer, window):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(900_000 + i, t) for i, t in enumerate(NASTY)] + [(None, "no id"), (7, None), (7, None), (8, "twice"), (8, "twice"), (950_000, "long text " * 9000)]
    docs += [(800_000 + i, "the same copy of a text") for i in range(200)]
    df = spark.createDataFrame([(*d, "a", "b", 1, "c", 2) for d in docs], SCHEMA)
    rows = P.pack(df, PATH, window=window, rows_per_bucket=50).collect()
    assert check(rows, docs, tokenizer, window) < 0.001


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_solution_meets_a_histogram_that_can_be_met():
    rng = np.random.default_rng(0)
    combos = P.combinations(np.arange(1, 65), 64)
    assert (combos.sum(axis=1) == 64).all() and len({tuple(c) for c in combos.tolist()}) == len(combos)
    truth = rng.integers(0, 50, len(combos)).astype(float)
    histogram = np.bincount(combos.T.ravel(), weights=np.tile(truth, 3), minlength=65)
    histogram[0] = 0
    x = P.least_squares(combos, histogram)
    met = np.bincount(combos.T.ravel(), weights=np.tile(x, 3), minlength=65)[1:]
    assert (x >= 0).all() and np.abs(met - histogram[1:]).sum() < 0.02 * histogram.sum()
    plan = P.make_plan(histogram.astype(int), 64)
    assert sum(n * k for n, k in plan.taken.items()) > 0.9 * (histogram * np.arange(65)).sum()
