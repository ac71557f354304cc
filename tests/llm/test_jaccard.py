"""The n-gram Jaccard join against brute force, its plan of keys, and edge cases."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from roomgrid.llm import jaccard as J
from roomgrid.llm import shingles as S

SCHEMA = "doc_id long, text string, node long, n long, key string, doc string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA)


def _set(text, size=3):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def _expected(rows, percent, size=3):
    sets = [_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(s), least.get(find(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)


def _check(spark, rows, percent=90, size=3):
    got = J.jaccard_components(_frame(spark, rows), size=size, percent=percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == _expected(rows, percent, size)


def _edited(rng, words, rate):
    return [w if rng.random() > rate else f"e{rng.randint(0, 10**6)}" for w in words]


def test_groups_of_near_copies(spark):
    rng = random.Random(3)
    rows, doc = [], 0
    for n in (3, 9, 11, 14, 25, 40, 90, 200, 700):
        for _ in range(5):
            base = [f"w{rng.randint(0, 5000)}" for _ in range(n)]
            for rate in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1):
                rows.append((doc, " ".join(_edited(rng, base, rate))))
                doc += 1
    # a common passage in texts that differ otherwise, and a chain of small steps
    common = " ".join(f"c{k}" for k in range(60))
    rows += [(doc + k, common + " " + " ".join(f"x{k}_{i}" for i in range(k % 12))) for k in range(60)]
    doc += 60
    words = [f"z{k}" for k in range(120)]
    for k in range(30):
        rows.append((doc + k, " ".join(words)))
        words[3 * k : 3 * k + 1] = [f"y{k}"]
    rng.shuffle(rows)
    _check(spark, rows)
    _check(spark, rows, 80, 5)


def test_without_near_copies(spark):
    a, b = " ".join(f"a{k}" for k in range(100)), " ".join(f"b{k}" for k in range(100))
    rows = [
        (5, a), (3, a + " more"), (None, a), (9, b), (9, b), (9, a + " less"), (7, None), (7, None), (8, ""), (None, "alone without"), (None, "alone  WITHOUT"), (None, "alone without"),
        (20, "q r s"), (20, "t u v"),
    ]
    schema = "doc_id long, text string, node long, h long, row string, root int, first int, times string, own int, `a b` int"
    df = spark.createDataFrame([(*r, 1, 2, "x", 3, 4, "y", 5, 6) for r in rows], schema)
    kept = J.without_near_copies(df)
    assert kept.schema == df.schema
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    by_hash = {t for d, t in got if d is None}
    assert len(by_hash) == 1 and by_hash < {"alone without", "alone  WITHOUT"}
    assert [g for g in got if g[0] is not None] == sorted([(3, a + " more"), (9, b), (7, None), (8, ""), (20, "q r s"), (20, "t u v")], key=str)
    assert J.without_near_copies(df.limit(0)).collect() == []


def test_lists_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "_BLOCK", 5)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(100)]
    rows = [(k, " ".join(_edited(rng, base, rng.choice([0.004, 0.01, 0.02, 0.04])))) for k in range(150)]
    _check(spark, rows)


def test_edges(spark):
    long = " ".join(f"v{k}" for k in range(150_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "two words"), (7, "TWO\twords"), (8, "È É"), (9, "è é"),
        (10, "a b c d"), (10, "a b c d"), (10, "something else entirely here"), (11, "something else  entirely here"), (None, "a b c d"),
        (None, "only without an id"), (None, "only without an id"), (12, long), (13, long + " more"), (14, "x" * 600_000), (15, "X" * 600_000),
    ]
    _check(spark, rows)


def test_empty_table(spark):
    assert J.jaccard_components(_frame(spark, [])).count() == 0
    assert J.jaccard_components(_frame(spark, [(1, None)])).collect() == [(1, 0, 1)]


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_share_a_key_under_any_scheme(percent):
    rng = np.random.default_rng(4)
    bounds = J.size_bands(percent, 400)
    for choice in range(0, 120, 7):
        plan = []
        for b in [0, *bounds[1:].tolist(), 500]:
            h = J.most_different(percent, b)
            all_ = J.schemes(h)
            plan.append(all_[choice % len(all_)] if h else J.Scheme())
        for _ in range(12):
            n = int(rng.integers(10, 380))
            x = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
            y = x.copy()
            while True:  # as many changes as the similarity allows
                z = np.unique(np.concatenate([y[rng.permutation(len(y))[1:]], rng.integers(0, 1 << 62, int(rng.integers(0, 2)), dtype=np.uint64)]))
                common = len(np.intersect1d(x, z))
                if 100 * common < percent * (len(x) + len(z) - common):
                    break
                y = z
            keys, owner = J.set_keys(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), bounds, plan)
            assert np.array_equal(x, y) or set(keys[owner == 0]) & set(keys[owner == 1])
            turns = [J.set_keys(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), bounds, plan, k, 3) for k in range(3)]
            assert sorted(zip(keys, owner)) == sorted((k, o) for t in turns for k, o in zip(*t))


def test_every_scheme_tolerates_the_difference():
    for different in (1, 2, 5, 11, 44, 300):
        found = J.schemes(different)
        assert all(s.tolerated() >= different for s in found)
        assert any(s.deletions for s in found) and any(s.drop > 1 for s in found) == (different > 1)


def test_allocation_weighs_keys_against_pairs():
    for percent in (80, 90):
        for bound in (15, 50, 1000):
            some = [J.allocation(percent, bound, sets) for sets in (100, 10**6, 10**12)]
            assert all(s.tolerated() >= J.most_different(percent, bound) for s in some)
            assert [s.keys(bound) for s in some] == sorted(s.keys(bound) for s in some)
            assert [s.shared(bound) for s in some] == sorted((s.shared(bound) for s in some), reverse=True)
    assert J.allocation(90, 300, 100).drop == 0 and J.allocation(80, 300, 10**6).drop > 0


def test_unrelated_sets_share_keys_as_reckoned():
    """The number of pairs that the cost expects is about the one that comes."""
    rng = np.random.default_rng(6)
    for percent, size in ((80, 100), (80, 300), (90, 200)):
        bounds = J.size_bands(percent, size + 50)
        cls = int(np.searchsorted(bounds, size))
        for scheme in J.schemes(J.most_different(percent, int(bounds[cls]))):
            plan = [J.Scheme()] * (len(bounds) + 1)
            plan[cls] = scheme
            n = 400
            sets = np.sort(rng.integers(0, 1 << 63, (n, size), dtype=np.uint64), axis=1).ravel()
            keys, owner = J.set_keys(sets, np.arange(n + 1) * size, bounds, plan)
            assert 0.7 * scheme.keys(size) <= len(keys) / n <= 1.3 * scheme.keys(size)
            _, times = np.unique(keys, return_counts=True)
            pairs, want = (times * (times - 1) / 2).sum(), 0.5 * n * n * scheme.shared(size / (1 - J.SHARED_ELEMENTS))
            if want > 200:
                assert want / 3 <= pairs <= want * 3


def test_sketches_of_any_size_differ_by_no_more_than_the_sets():
    rng = np.random.default_rng(9)
    for n in (1, 3, 100, 2047, 2048, 2049, 4097, 9000):
        x = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: int(0.93 * len(x))], rng.integers(0, 1 << 62, n // 20, dtype=np.uint64)]))
        far = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        sketches = J._parities(np.concatenate([x, y, far]), np.cumsum([0, len(x), len(y), len(far)])).to_pylist()
        size = min(map(len, sketches))
        a, b, c = J._folded(sketches, size)
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))
        # unrelated sets differ in more buckets than similar ones may
        assert n < 3 or np.bitwise_count(a ^ c).sum() > 0.3 * n


def test_lists_do_not_depend_on_batches():
    rng = np.random.default_rng(1)
    key = np.sort(rng.integers(0, 40, 300))
    rows = np.array(sorted(zip(key, rng.integers(0, 4, 300))))
    want = sorted({(k, n, min(rows[rows[:, 0] == k][:, 1])) for k, n in map(tuple, rows) if len(set(rows[rows[:, 0] == k][:, 1])) > 1})
    for step in (1, 2, 3, 7, 50, 300):
        batches = [pa.RecordBatch.from_arrays([pa.array(rows[i : i + step, c]) for c in (0, 1)], ["key", "node"]) for i in range(0, 300, step)]
        got = [tuple(r.values()) for b in J._shared_keys(iter(batches)) for r in b.to_pylist()]
        assert sorted(set(got)) == want, step


def test_words_and_shingles_by_hash():
    rng = random.Random(2)
    pool = ["Abc", "aBc", "é", "x\x0by", "foo", "a", "b", "Ünï", " q"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None, "", "q" * 700_000 + " a b " + "z" * 300_000]
    data, offsets = S.text_bytes(pa.array(texts))
    seen = {}
    for a, b in S.chunks(offsets, 5000):
        sets, first = S.shingle_sets(data, offsets[a : b + 1], 3)
        for k in range(b - a):
            own = tuple(sets[first[k] : first[k + 1]].tolist())
            assert len(own) == len(_set(texts[a + k]))
            assert seen.setdefault(frozenset(_set(texts[a + k])), own) == own
    assert len(set(seen.values())) == len(seen)
