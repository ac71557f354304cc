"""What a streamed job leaves on disk."""

from __future__ import annotations

from roomgrid.plans.catalog import JOBS
from roomgrid.session import cut_lineage, settle, shared_paths

FOLDER = "/root/testdata/sf0.001"


def test_a_stream_leaves_only_its_outcomes(spark):
    for name in ("s01_stream_approvals", "s01_stream_approvals_impacts"):
        before = shared_paths(spark)
        found = JOBS[name](spark, FOLDER)
        left = [path.rsplit("/", 1)[-1] for path in shared_paths(spark) if path not in before]
        assert len(left) == 1 and left[0].startswith("outcomes-")
        assert found.count() > 0


def test_settled_rows_keep_no_steps(spark):
    before = shared_paths(spark)

    def build():
        return cut_lineage(spark.range(5)).join(cut_lineage(spark.range(3)), "id")

    df = settle(spark, build)
    assert len([path for path in shared_paths(spark) if path not in before]) == 1
    assert df.count() == 3
