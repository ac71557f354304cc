"""Every registered job against its oracle, on the smallest derived tables."""

from __future__ import annotations

import pytest

from compare import compare, oracle_connection
from roomgrid.plans.catalog import JOBS
from roomgrid.plans.oracle import QUERIES, oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


def test_every_job_has_an_oracle():
    assert set(JOBS) == set(QUERIES)


@pytest.mark.parametrize("name", list(JOBS))
def test_job(spark, con, name):
    assert compare(JOBS[name](spark, FOLDER), con, oracle(name)) == ""
