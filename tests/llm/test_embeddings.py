"""Embedding near-dedup against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from roomgrid.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, node long, u string, component long, label int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", 2, 3) for i, v in rows], SCHEMA)


def _brute(rows, threshold=0.95):
    """(links, component) of each row by comparing all."""
    f32 = lambda v: None if v is None or any(x is None for x in v) else np.array(v, dtype=np.float32).astype(np.float64)
    vs = [f32(v) for _, v in rows]
    good = [v is not None and len(v) and np.isfinite(v).all() and v.any() for v in vs]
    links = {k: set() for k in range(len(rows))}
    for dim in {len(v) for v, g in zip(vs, good) if g}:
        at = [k for k, v in enumerate(vs) if good[k] and len(v) == dim]
        m = np.array([vs[k] / np.abs(vs[k]).max() for k in at])
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(m @ m.T >= threshold)):
            if a != b:
                links[at[a]].add(at[b])
    least, seen = {}, set()
    for k in range(len(rows)):
        if k in seen:
            continue
        todo, group = [k], {k}
        while todo:
            new = links[todo.pop()] - group
            group |= new
            todo += new
        seen |= group
        ids = [rows[g][0] for g in group if rows[g][0] is not None]
        least.update(dict.fromkeys(group, min(ids) if ids else None))
    return [(rows[k][0], len(links[k]), least[k]) for k in range(len(rows))]


def _groups(rng, dim, sizes, spread):
    out = []
    for n in sizes:
        c = rng.normal(size=dim)
        c /= np.linalg.norm(c)
        out += [c + rng.normal(size=dim) * spread / dim**0.5 for _ in range(n)]
    return out


@pytest.mark.parametrize("spread", [0.1, 0.2, 0.3])
def test_recall_and_no_false_link(spark, spread):
    rng = np.random.default_rng(int(spread * 10))
    vs = _groups(rng, 32, [2] * 60 + [5] * 20 + [300], spread) + list(rng.normal(size=(700, 32)))
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(vs)), vs)]
    want = {i: (n, c) for i, n, c in _brute(rows)}
    got = {r["vec_id"]: r for r in E.near_duplicates(_frame(spark, rows)).collect()}
    assert set(got) == set(want)
    assert all(got[i]["n_links"] <= n for i, (n, _) in want.items())
    assert sum(r["n_links"] for r in got.values()) >= 0.95 * sum(n for n, _ in want.values())
    assert np.mean([got[i]["component_id"] == c for i, (_, c) in want.items()]) > 0.97
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_blocks_count_all_pairs_of_a_component(spark, monkeypatch):
    monkeypatch.setattr(E, "_BLOCK", 40)
    rng = np.random.default_rng(9)
    c = rng.normal(size=16)
    chain = [c + k * 0.02 * rng.normal(size=16) for k in range(160)]  # some are near the middle, some are not
    rows = list(enumerate(chain + chain[:30]))
    want = {i: (n, comp) for i, n, comp in _brute(rows)}
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in E.near_duplicates(_frame(spark, rows), passes=20).collect()}
    assert got == want


def test_edges(spark):
    rows = [
        (1, [1, 0, 0]), (2, [2, 0, 0]), (3, [1, 0, 0]), (3, [1, 0, 0]), (4, None), (5, []), (6, [0, 0, 0]), (7, [1, None, 0]), (8, [float("nan"), 1, 0]),
        (9, [float("inf"), 1, 0]), (10, [1, 0]), (11, [-1, 0, 0]), (None, [1, 0, 0]), (None, [0, 5, 0]), (12, [3e38, 3e38, 0]), (13, [1e-38, 1e-38, 0]), (14, [-0.0, 0.0, 1]), (15, [0.0, 0.0, 2]),
    ]
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in E.near_duplicates(_frame(spark, rows)).collect()), key=str)
    assert got == sorted(_brute(rows), key=str)
    assert E.near_duplicates(_frame(spark, [])).count() == 0
    assert E.near_duplicates(_frame(spark, [(1, None)])).collect()[0][:3] == (1, 0, 1)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in E.op6_embedding_near_dedup(spark, folder).collect()}
    assert got == {i: (n, c) for i, n, c in _brute(rows)}
