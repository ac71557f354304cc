"""The near-dedup stage of the pipeline: five words, a similarity of 0.8 or more."""

from __future__ import annotations

import random

import corpus_pipeline as C
from test_jaccard import _set

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _similarity(a, b, size):
    x, y = _set(a, size), _set(b, size)
    return len(x & y) / len(x | y)


def test_near_copies_by_five_words(spark):
    rng = random.Random(11)
    rows, want = [], set()
    for group, changed in enumerate([0, 1, 8, 12, 14, 16, 18, 22, 40]):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
        copy = [*words[:80], *(f"n{group}_{k}" for k in range(changed)), *words[80 + changed :]]
        a, b = " ".join(words), " ".join(copy)
        rows += [(2 * group, a, "en", "s", len(a)), (2 * group + 1, b, "en", "s", len(b))]
        want |= {2 * group} | ({2 * group + 1} if _similarity(a, b, 5) < 0.8 else set())
    missed = [k for k in range(0, len(rows), 2) if _similarity(rows[k][1], rows[k + 1][1], 3) < 0.9 and k + 1 not in want]
    assert missed and len(want) > len(rows) // 2  # both sides of the limit, and pairs that three words at 0.9 leave
    got = [r["doc_id"] for r in C.near_dedup(spark, spark.createDataFrame(rows, SCHEMA), "").collect()]
    assert sorted(got) == sorted(want)
