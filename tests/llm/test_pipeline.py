"""The pipeline: each stage against a plain version, over what its predecessor kept."""

from __future__ import annotations

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline as C
from roomgrid.llm import mixing as M
from roomgrid.session import shared_paths
from test_jaccard import _expected as jaccard_expected
from test_lines import _expected as lines_expected
from test_packing import check as packing_check

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows before the first stage and after each, and the folder of what went into the mixing."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    copy = docs.orderBy("doc_id").limit(8).selectExpr("doc_id + 1000000 as doc_id", "text", "lang", "source", "n_chars")
    junk = spark.createDataFrame([(2_000_000, "12 -- 34", None, "src1", 8), (2_000_001, None, "en", None, None)], docs.schema)
    docs = docs.union(copy).union(junk)
    out = [docs.collect()]
    for k, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        if k < len(C.STAGES) - 1:
            assert docs.columns == COLUMNS
        out.append(docs.collect())
    return out, base


def test_language_id_keeps_clean_documents(steps):
    before, after = steps[0][:2]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert {2_000_000, 2_000_001} <= gone and len(gone) <= 4
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_line_dedup(steps):
    before, after = steps[0][1:3]
    want = [(d, t) for d, t, _, deleted in lines_expected([(r["doc_id"], r["text"]) for r in before], 50) if not deleted or t]
    assert sorted(want) == sorted((r["doc_id"], r["text"]) for r in after)
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_dedup(steps):
    before, after = steps[0][2:4]
    want = {d for d, _, component in jaccard_expected([(r["doc_id"], r["text"]) for r in before], C.NEAR_PERCENT, C.NEAR_WORDS) if d == component}
    assert want == {r["doc_id"] for r in after} and len(want) == len(after)


def test_mixing(steps):
    base, after = steps[1], steps[0][4]
    con = duckdb.connect()
    con.execute(f"create view mixed as select * from '{base}/2/*.parquet'")
    want = con.execute(f"with {M.MIX_SQL.replace('{documents}', 'mixed')} select doc_id, count(*) from copies group by doc_id").fetchall()
    got = {}
    for r in after:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == dict(want)


def test_packing(steps):
    before, after = steps[0][4:6]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert packing_check(after, [(r["doc_id"], r["text"]) for r in before], tokenizer, 2048) < 0.001


def test_run_and_registration(spark):
    found = __spark_entry__.queries()
    assert found["pipeline"] is C.run and "pipeline" not in __spark_entry__.oracle_sql()
    assert [f"op{n}_" in " ".join(found) for n in range(1, 14)] == [True] * 13
    assert C.run(spark, FOLDER).count() > 100


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0


def test_clashing_names_nulls_and_long_texts(spark, tmp_path):
    """Every stage passes other columns through, whatever their names."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    odd = [(None, None, None, None, None), (None, "wort " * 30_000 + "ende", "de", "s", 1), (5, "", "en", None, 0), (5, "", "en", None, 0)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    extra = ["id", "rows", "row", "score", "lang_pred", "_lines", "_deleted", "doc", "key", "node", "h", "own", "times", "c0", "copies", "n", "runs", "text_", "root", "first"]
    for c in extra:
        docs = docs.withColumn(c, F.coalesce(F.col("doc_id"), F.lit(-1)).cast("string"))
    for k, (_, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, FOLDER)
        if k == len(C.STAGES) - 1:
            assert out.count() > 30
            break
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = docs.collect()
        assert rows and all(r[c] == str(-1 if r["doc_id"] is None else r["doc_id"]) for r in rows for c in extra)


def test_step_tables_go_when_the_next_stage_starts(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(30)
    before = set(shared_paths(spark))
    first = C.line_dedup(spark, docs, FOLDER)
    made = set(shared_paths(spark)) - before
    lazily = C.mixing(spark, first, FOLDER)  # reads the step tables, so they stay
    assert lazily.count() > 0
    first.write.parquet(f"{tmp_path}/1")
    C.mixing(spark, spark.read.parquet(f"{tmp_path}/1"), FOLDER)
    assert made and not made & set(shared_paths(spark))
