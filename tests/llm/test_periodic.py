"""Periodic runs against a plain search of every period."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from roomgrid.llm import periodic as P

SCHEMA = "doc_id long, text string, id string, runs int, collapsed long, n_words string"
SPACES = " \t\n\x0b\x0c\r"


def _words(text):
    out = [""]
    for c in text or "":
        if c in SPACES:
            out.append("")
        else:
            out[-1] += c
    return [w for w in out if w]


def _plain(w):
    """(start, length, period) by trying every period."""
    least = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                least.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((x, n, q) for (x, n), q in least.items()), key=lambda r: (r[0], r[2]))


def _collapsed(w, runs):
    gone = {i for x, n, q in runs for i in range(x + q, x + n)}
    return " ".join(v for i, v in enumerate(w) if i not in gone)


def _damaged(doc, text):
    w = _words(text)
    if doc is None or not w:
        return w
    h = zlib.crc32(str(doc).encode())
    if h % 10:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def _found(lists):
    ids = np.array([x for w in lists for x in w], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum([len(w) for w in lists])]).astype(np.int64)
    out = [[] for _ in lists]
    if len(ids):
        for t, x, n, q in zip(*(c.tolist() for c in P.find_runs(ids, first))):
            out[t].append((x - int(first[t]), n, q))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_against_every_period(seed):
    rng = random.Random(seed)
    lists = [[], [0], [0] * 5, [0] * 6, [0] * 100, [0, 1] * 40 + [0], [0, 1, 2] * 3]
    for _ in range(400):
        letters = rng.choice([1, 2, 2, 3, 6])
        w = [rng.randrange(letters) for _ in range(rng.randrange(60))]
        while rng.random() < 0.6:
            v = [rng.randrange(4) for _ in range(rng.randrange(1, 12))] * rng.randrange(2, 9)
            w[rng.randrange(len(w) + 1) :] = v[: len(v) - rng.randrange(len(v))] + w[:20]
        lists.append(w)
    assert _found(lists) == [_plain(w) for w in lists]


def test_few_squares_at_a_time_and_misleading_hashes(monkeypatch):
    rng = random.Random(7)
    lists = [[rng.randrange(2) for _ in range(200)] for _ in range(20)] + [[0, 1, 1] * 300]
    want = [_plain(w) for w in lists]
    monkeypatch.setattr(P, "_SLAB", 7)
    assert _found(lists) == want
    real = P._Hashes

    class Wrong(real):
        def __init__(self, ids, seed):
            super().__init__(ids if seed else ids * 0, seed)  # the first numbers tell no words apart

    monkeypatch.setattr(P, "_Hashes", Wrong)
    assert _found(lists) == want


def test_nested_repeats_and_a_long_text():
    inner = [1, 1, 1, 1, 1, 1, 2]
    text = inner * 50 + [9] + list(range(10, 4000)) + [5] * 30_000
    assert _found([text])[0] == _plain(inner * 50 + [9]) + [(350 + 1 + 3990, 30_000, 1)]


def test_edges(spark):
    long_text = "lang " * 50_000 + "ende"
    texts = [None, "", " \n\t", "a", "a a a a a a", "a a a a a", "A a A a A a A a", "x x " * 6, "é é " * 5, long_text, "b\x0bb\x0cb\rb\tb\nb  c"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "q q q q q q q"), (None, None), (4, "a a a a a a"), (4, "z")]
    df = spark.createDataFrame([(k, t, "x", 1, 2, None) for k, t in rows], SCHEMA)
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in P.periodic_runs(df).collect()), key=repr)
    want = []
    for k, t in rows:
        w = _words(t)
        runs = _plain(w) if len(w) < 1000 else [(0, 50_000, 1)]
        want.append((k, len(w), runs, _collapsed(w, runs)))
    assert got == sorted(want, key=repr)
    assert P.periodic_runs(df.limit(0)).collect() == []


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_against_every_period(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in P.op13_periodic_runs(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(rows)
    some = 0
    for r in rows:
        w = _damaged(r["doc_id"], r["text"])
        if len(w) > 4000:
            continue
        runs = _plain(w)
        some += bool(runs)
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2])) if runs else (None,) * 3
        milli = 1000 * best[1] // best[2] if runs else None
        want = (len(runs), *best, milli, _sha("".join(f"{x},{n},{q}\n" for x, n, q in runs)), _sha(_collapsed(w, runs)))
        assert got[r["doc_id"]] == want
    assert some > 5


def test_with_repeats_of_odd_rows(spark):
    texts = [None, "", " ", "a", "a b c d e f g h i j k l", "ü ß x y z"]
    rows = [(k, t) for k in [None, *range(60)] for t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = df.select("doc_id", "text", P.with_repeats(df.doc_id, df.text).alias("after")).collect()
    assert len(got) == len(rows)
    assert all(_words(r["after"]) == _damaged(r["doc_id"], r["text"]) for r in got)
