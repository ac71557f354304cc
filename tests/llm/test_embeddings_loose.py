"""Embedding near-dedup of pairs across small groups inside one large loose group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from roomgrid.llm import embeddings as E


def test_pairs_inside_a_loose_group(spark, tmp_path):
    rng = np.random.default_rng(17)
    dim, n, pairs = 64, 20_000, 400
    unit = lambda m: m / np.linalg.norm(m, axis=-1, keepdims=True)
    common = unit(rng.normal(size=dim))
    loose = unit(common + unit(rng.normal(size=(n, dim))) * (0.15 / 0.85) ** 0.5)  # pairwise cosine about 0.85
    noise = rng.normal(size=(pairs, dim))
    noise = unit(noise - (noise * loose[:pairs]).sum(axis=1, keepdims=True) * loose[:pairs])
    partners = 0.955 * loose[:pairs] + (1 - 0.955**2) ** 0.5 * noise
    vectors = np.concatenate([loose, partners])
    pq.write_table(pa.table({"vec_id": pa.array(range(len(vectors))), "embedding": pa.array(vectors.tolist())}), tmp_path / "e.parquet")
    got = {r["vec_id"]: r["component_id"] for r in E.near_duplicates(spark.read.parquet(str(tmp_path / "e.parquet"))).collect()}
    assert len(got) == len(vectors)
    assert np.mean([got[k] == got[n + k] for k in range(pairs)]) >= 0.99
