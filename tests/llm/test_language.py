"""Language ID: exact inference against enumeration, held-out accuracy, code-switched text, edge cases."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from roomgrid.llm import language as L

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def field(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return L.fit(docs.where(~L.held_out(docs["doc_id"])), per_language=100)


def test_forward_backward_is_exact(monkeypatch):
    rng = np.random.default_rng(0)
    monkeypatch.setattr(L, "_BLOCK", 2)
    f = L.Field(["a", "b", "c"], np.zeros((L.BUCKETS, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    lengths = np.array([1, 5, 2, 4])
    scores = rng.normal(size=(12, 3)) * 3
    got, at = f.posteriors(scores, lengths), 0
    for n in lengths.tolist():
        e, want = scores[at : at + n], np.zeros((n, 3))
        for y in itertools.product(range(3), repeat=n + 1):
            w = np.exp(f.start[y[0]] + sum(f.transitions[y[k], y[k + 1]] + e[k, y[k + 1]] for k in range(n)))
            for k in range(n):
                want[k, y[k + 1]] += w
        assert np.allclose(got[at : at + n], want / want.sum(axis=1, keepdims=True))
        at += n


def test_a_step_follows_the_gradient():
    """The log-likelihood of the training sequences grows under the steps."""
    texts = [("der und die das nicht " * 6, "de"), ("the and of that with " * 6, "en"), ("le les des une pour " * 6, "fr")]
    few, many = (L.train(texts, 30, epochs=n) for n in (1, 12))
    share = lambda f: np.mean([L.Labeller(f).label([t])[0][1] for t, _ in texts])
    assert share(many) > share(few) > 1 / 3 and share(many) > 0.95
    assert (np.diag(many.transitions) > many.transitions.sum(axis=1) - np.diag(many.transitions)).all()


def test_features_do_not_depend_on_neighbours():
    words = ["a", "the", "straße", "ñ", "x" * 80, "漢字", "\U0001f600a"]
    numbers, first = L.features(words)
    for k, w in enumerate(words):
        alone, _ = L.features([w])
        assert sorted(alone) == sorted(numbers[first[k] : first[k + 1]])
        if len(w) > 3:
            assert len(alone) == (len(w) + 1) + len(w) + 2 + 1


def test_held_out_accuracy_over_whole_texts(spark):
    got = {r["doc_id"]: r for r in L.op9_language_id(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert set(got) == {r["doc_id"] for r in rows}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for d, r in got.items())
    held = [(got[r["doc_id"]]["lang_pred"], r["lang"]) for r in rows if r["lang"] and got[r["doc_id"]]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.95


def test_code_switched_words(field):
    text = "the of and that with from this are was for in it " * 2 + "der und die das nicht von mit sich auf ist dem ein " * 2
    words = [L.core(w) for w in text.split()]
    p = field.posteriors(field.scores(words), np.array([len(words)])).argmax(axis=1)
    named = [field.languages[k] for k in p]
    assert named[2:20].count("en") > 16 and named[28:].count("de") > 16


def test_edges(spark, field):
    rows = [(1, None), (2, ""), (3, "12 34 -- !!"), (4, "der " * 300_000), (5, "x"), (5, "x"), (None, "the and of")]
    df = spark.createDataFrame([(*r, "en", 1.0) for r in rows], "doc_id long, text string, lang_pred string, score double")
    got = L.predict(df, field).collect()
    assert [r[-2] for r in got if r[0] in (1, 2, 3)] == ["und"] * 3 and [r[-1] for r in got if r[0] in (1, 2, 3)] == [0.0] * 3
    assert next(r[-2] for r in got if r[0] == 4) == "de" and len(got) == len(rows)
    assert len({tuple(r) for r in got if r[0] == 5}) == 1
    assert L.predict(df.limit(0), field).count() == 0
    nothing = L.fit(df.withColumn("lang", df["lang_pred"]).limit(0))
    assert [r[-2] for r in L.predict(df, nothing).collect()] == ["und"] * len(rows)


def test_labels_do_not_depend_on_the_batch(field):
    texts = ["the and of it", None, "der und " * 200, "la de que el los", "", "one " * 70]
    together = L.Labeller(field).label(texts)
    alone = [L.Labeller(field).label([t])[0] for t in texts]
    assert [a[0] for a in together] == [b[0] for b in alone] and np.allclose([a[1] for a in together], [b[1] for b in alone])
