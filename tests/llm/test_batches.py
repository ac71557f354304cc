"""Batches that go to Python stay small whatever the number of rows that a job allows."""

from __future__ import annotations

import pyarrow as pa

from roomgrid.llm.common import BATCH_BYTES, small_batches


def test_texts_go_in_several_batches_and_numbers_in_one(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    texts = spark.range(0, 2000, 1, 1).selectExpr("id", "repeat('x', 8000) as text")
    with small_batches(spark, rows=1 << 16):
        long = texts.mapInArrow(sizes, "n long, size long").collect()
        short = spark.range(0, 60000, 1, 1).mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in long) == 2000 and max(r["size"] for r in long) < 1.1 * BATCH_BYTES
    assert [r["n"] for r in short] == [60000]
    assert spark.conf.get(name) == before
