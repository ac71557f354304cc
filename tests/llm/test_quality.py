"""Quality rules against a plain Python version, with edge cases."""

from __future__ import annotations

import re
from collections import Counter

from roomgrid.llm import quality as Q

SCHEMA = "doc_id long, text string, source string, host string, n string, line string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def _expected(rows, max_share, min_documents):
    norm = lambda line: re.sub("[0-9]+", "0", " ".join(WORD.findall(line))).lower()
    lines = lambda text: [x for x in (text or "").split("\n") if WORD.search(x)]
    texts, holds = Counter(), Counter()
    for source, text in {(s, t) for _, t, s in rows if t is not None}:
        texts[source] += 1
        holds.update({(source, norm(x)) for x in lines(text)})
    out = []
    for doc, text, source in rows:
        w = WORD.findall(text or "")
        three = Counter(zip(w, w[1:], w[2:]))
        inside = {i + k for i, t in enumerate(zip(w, w[1:], w[2:])) if three[t] > 1 for k in range(3)}
        removed = sum(len(WORD.findall(x)) for x in lines(text) if holds[source, norm(x)] > max(min_documents, max_share * texts[source]))
        failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
        ls = lines(text)
        out.append((doc, len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(ls) - len(set(ls)), len(inside), removed, failed, not failed and 2 * (len(w) - removed) >= len(w)))
    return sorted(out, key=str)


def test_against_python(spark):
    furniture = " ".join(f"menu{i % 7}{chr(97 + i % 26)}" for i in range(40))
    own = lambda i: " ".join(f"w{i}_{k}" for k in range(45))
    rows = [(i, f"{furniture} {i}\n{own(i)}\n\n \t \n{own(i)[:20]}", "a" if i % 3 else None) for i in range(12)]
    rows += [
        (100, None, "a"), (101, "", None), (None, own(7) + "\n" + own(8), "b"), (102, "# | <b> $ " * 30, "b"),
        (103, "\x0bone\x0ctwo\rthree\x1cfour five", "b"), (104, "a b c a b c d", "b"), (105, (own(1) + "\n") * 3, "a"), (1, rows[1][1], "a"),
        (106, "the same words here " * 20_000, "a"), (107, " ".join(f"x{i}" for i in range(60_000)), "a"),
    ]
    got = Q.quality(_frame(spark, rows), max_share=0.5, min_documents=3).collect()
    assert sorted((tuple(r) for r in got), key=str) == _expected(rows, 0.5, 3)
    assert any(r["n_removed"] and not r["kept"] for r in got)


def test_copies_do_not_make_their_lines_common(spark):
    text = " ".join(f"w{k}" for k in range(80))
    got = Q.quality(_frame(spark, [(i, text, "a") for i in range(20)]), max_share=0.1, min_documents=2).collect()
    assert all(r["kept"] and r["n_removed"] == 0 for r in got) and len(got) == 20


def test_empty_table(spark):
    assert Q.quality(_frame(spark, [])).count() == 0
