"""The shared folder: taken from the session, own only in local runs, emptied on demand."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from roomgrid import session

CHILD = """
import os, sys
sys.path.insert(0, {repo!r})
from roomgrid.session import cut_lineage, drop_shared, local_session, shared_root
spark = local_session(2, 2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
df = cut_lineage(spark.range(10))
assert df.count() == 10
root = shared_root(spark)
assert len(os.listdir(root)) == 1
assert drop_shared(spark) == 1 and os.listdir(root) == []
print("fine")
"""


def test_works_with_the_setting_unset(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", CHILD.format(repo=repo)], env=env, capture_output=True, text=True, timeout=240)
    assert "fine" in out.stdout, out.stderr[-2000:]


class _Fake:
    """Stands for a session on a cluster whose setting is missing."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"
        applicationId = "app-none"

        @staticmethod
        def getConf():
            return {}


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(_Fake())


def test_the_setting_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.shared_dir(spark, "step").startswith(named.rstrip("/"))
