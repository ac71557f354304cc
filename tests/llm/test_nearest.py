"""Nearest neighbours against comparing all."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomgrid.llm import nearest as N

SCHEMA = "vec_id long, embedding array<double>, vec int, v string, h1 long, q1 int, score string"


def _frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", 2, 3, "y") for i, v in rows], SCHEMA)


def _brute(rows, every, k=5):
    """(query, [(score, id), ...]) of each query row."""
    v = [None if x is None or any(c is None for c in x) else np.array(x, dtype=float) for _, x in rows]
    good = [x is not None and len(x) > 0 and bool(np.isfinite(x).all() and x.any()) for x in v]
    u = [x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if g else None for x, g in zip(v, good)]
    out = []
    for a, (i, _) in enumerate(rows):
        if good[a] and i is not None and i % every == 0:
            near = [(-round(float(u[a] @ u[b]), 12), rows[b][0] is None, rows[b][0] or 0) for b in range(len(rows)) if b != a and good[b] and len(u[a]) == len(u[b])]
            out.append((i, [(s, None if none else j) for s, none, j in sorted(near)[:k]]))
    return sorted(out, key=repr)


def _got(df):
    lists = {}
    for r in df.collect():
        lists.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for found in lists.values():
        assert sorted(r for r, *_ in found) == list(range(1, len(found) + 1))
    return sorted(((q, [(-round(s, 12), j) for _, j, s in sorted(x)]) for q, x in lists.items()), key=repr)


def _same(got, want):
    assert [(q, [j for _, j in near]) for q, near in got] == [(q, [j for _, j in near]) for q, near in want]
    assert np.allclose([s for _, near in got for s, _ in near], [s for _, near in want for s, _ in near], rtol=0, atol=1e-11)


def test_chi_square_bound():
    assert N.chi_square_bound(2, 0.95) == pytest.approx(-2 * math.log(0.05))
    assert N.chi_square_bound(16, 0.95) == pytest.approx(26.296, abs=1e-3)
    assert N.chi_square_bound(1, 0.99) == pytest.approx(6.635, abs=1e-3)


def _rows(rng, n, dim):
    centres = rng.normal(size=(20, dim))
    m = np.concatenate([centres[rng.integers(0, 20, n // 2)] + 0.3 * rng.normal(size=(n // 2, dim)), rng.normal(size=(n - n // 2, dim))])
    return list(zip(rng.permutation(n).tolist(), m))


def test_a_sure_test_finds_all(spark):
    rng = np.random.default_rng(3)
    rows = _rows(rng, 1500, 12)
    # a third are copies, dealt over blocks
    rows += [(2000 + i, rows[0][1]) for i in range(700)]
    got = _got(N.nearest(_frame(spark, rows), F.col("vec") % 20 == 0, confidence=1 - 1e-12, block=150, sample=400))
    _same(got, _brute(rows, 20))


def test_recall(spark):
    rng = np.random.default_rng(4)
    rows = _rows(rng, 4000, 48)
    want = dict(_brute(rows, 10))
    got = dict(_got(N.nearest(_frame(spark, rows), F.col("vec") % 10 == 0, block=500, sample=1000)))
    assert set(got) == set(want) and all(len(x) == 5 for x in got.values())
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)
    scores = {(q, j): s for q, x in _brute(rows, 10, 4000) for s, j in x}
    assert all(abs(scores[q, j] - s) < 1e-11 for q, x in got.items() for s, j in x)


def test_a_floor_stops_the_search():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    far = rng.normal(size=(3000, 8)) * 0.01 + np.eye(8)[0]
    near = rng.normal(size=(300, 8)) * 0.01 + np.eye(8)[1]
    m = np.concatenate([far, near])
    n = len(m)
    rows = pa.table({"vec": np.arange(n), "h1": np.arange(n), "h2": np.arange(n), "v": pa.array(m.tolist())})
    query = pa.table({"q1": [-1], "q2": [-1], "v": pa.array([near[0].tolist()]), "floor": [-2.0]})
    found = N._search_block(query, rows, 6, 4, N.chi_square_bound(4, 0.98))
    assert found.num_rows == 6 and min(found.column("vec").to_pylist()) >= 3000
    # with a floor that nothing reaches no row comes out
    assert N._search_block(query.set_column(3, "floor", [[1.1]]), rows, 6, 4, N.chi_square_bound(4, 0.98)).num_rows == 0


def test_edges(spark):
    rows = [
        (0, [1, 0, 0]), (50, [2, 0, 0]), (50, [2, 0, 0]), (100, [0, 1, 0]), (100, [0, 0, 1]), (3, [1, 0, 0]), (4, None), (150, None), (5, []), (200, [0, 0, 0]),
        (250, [1, None, 0]), (300, [float("nan"), 1, 0]), (9, [float("inf"), 1, 0]), (350, [1, 0]), (400, [-1, 0, 0]), (None, [1, 0, 0]), (None, [0, 5, 0]),
        (450, [1e300, 1e300, 0]), (13, [1e-300, 1e-300, 0]), (500, [-0.0, 0.0, 1]), (15, [0.0, -0.0, 1]), (-50, [0, 3, 4]),
    ]
    df = _frame(spark, rows)
    got = N.nearest(df, F.col("vec") % 50 == 0, confidence=1 - 1e-12).collect()
    want = [(q, r + 1, j, round(-s, 9) + 0.0) for q, near in _brute(rows, 50) for r, (s, j) in enumerate(near)]
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9) + 0.0) for r in got), key=repr) == sorted(want, key=repr)
    assert N.nearest(df.limit(0), F.col("vec") % 50 == 0).collect() == []
    assert N.nearest(_frame(spark, [(0, None)]), F.col("vec") % 50 == 0).collect() == []
    assert N.nearest(_frame(spark, [(0, [1, 2])]), F.col("vec") % 50 == 0).collect() == []


def test_query_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = dict(_brute(rows, 50))
    df = N.op11_nearest_neighbours(spark, folder)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    got = dict(_got(df))
    assert set(got) == set(want)
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)
