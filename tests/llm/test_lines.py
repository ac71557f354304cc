"""Line dedup against a plain Python version that looks at every stretch of every text."""

from __future__ import annotations

import random
import re

from roomgrid.llm import lines as L

SCHEMA = "doc_id long, text string, row string, runs string, key long, doc string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], SCHEMA)


def _expected(rows, m):
    """Rows must have different ids: the order between equal ids is that of a hash."""
    seen, gone = {}, {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        parts = (text or "").split("\n")
        content = [(i, WORD.findall(x)) for i, x in enumerate(parts) if WORD.search(x)]
        spans = set()
        for k in range(len(content)):
            for step in (1, -1):
                n, j = 0, k
                while 0 <= j < len(content) and n < m:
                    n += len(content[j][1])
                    j += step
                if n >= m:
                    a, b = (k, j - 1) if step == 1 else (j + 1, k)
                    spans.add((a, b, step))
        found = {(content[a][0], content[b][0], step, tuple(" ".join(w) for _, w in content[a : b + 1])) for a, b, step in spans}
        for first, last, step, body in sorted(found):
            d, l0 = seen.setdefault((step, body), ((doc, text), last))
            if not (d == (doc, text) and first <= l0):
                gone.setdefault((doc, text), set()).update(range(first, last + 1))
    out = []
    for doc, text in rows:
        cut = gone.get((doc, text), set())
        parts = (text or "").split("\n")
        n = sum(bool(WORD.search(x)) for x in parts)
        kept = [x for i, x in enumerate(parts) if i not in cut]
        left = sum(bool(WORD.search(x)) for x in kept)
        out.append((doc, text if not cut else "\n".join(kept) if left else "", n, n - left))
    return sorted(out, key=str)


def _check(spark, rows, m):
    got = L.dedup_lines(_frame(spark, rows), min_words=m).select("doc_id", "text", "_lines", "_deleted").collect()
    assert sorted((tuple(r) for r in got), key=str) == _expected(rows, m)
    return {r["doc_id"]: r for r in got}


def test_random_runs(spark):
    rng = random.Random(5)
    pool = [" ".join(f"w{k}" for k in range(rng.choice([0, 1, 2, 3, 9]))) + f" l{i % 9}" * (i % 5 > 0) for i in range(30)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(120)]
    passage = "\n".join(pool[3:9])
    rows += [(200 + i, f"own {i}\n{passage}\n\n \t\nrest {i}") for i in range(40)]
    _check(spark, rows, 8)


def test_edges(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    long = "\n".join(f"line {i} of a very long text " + "x " * (i % 3) for i in range(20_000))
    rows = [
        (None, passage), (1, passage), (2, f"before\n{passage}\nafter"), (3, None), (4, ""), (5, " \n\t\n"),
        (6, "short line\n" * 200), (7, long), (8, long + "\nnew end"), (9, passage.replace(" ", "   ")), (10, passage[:-1]), (2, f"before\n{passage}\nafter"),
    ]
    got = _check(spark, rows, 50)
    assert got[None]["text"] == passage and got[1]["text"] == "" and got[2]["text"] == "before\nafter"
    assert got[9]["text"] == "" and got[10]["_deleted"] == 0 and got[3]["text"] is None
    assert got[6]["text"].count("short line") == 25  # periodic text: a first stretch of 25 lines stays


def test_columns_and_empty_table(spark):
    got = L.dedup_lines(_frame(spark, []))
    assert got.columns == ["doc_id", "text", "row", "runs", "key", "doc", "_lines", "_deleted"] and got.count() == 0
