"""Session helpers: nothing forced on a cluster, shared scratch only, scratch folders that go."""

import os
import subprocess
import sys

import pytest

from tidemark import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class FakeContext:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class FakeSession:
    sparkContext = FakeContext()

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(FakeSession())


def test_shuffle_partitions_are_only_set_when_asked_for():
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from pyspark.sql import SparkSession\n"
            "SparkSession.builder.master('local[1]').config('spark.sql.shuffle.partitions', '23').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "from tidemark.session import build_session\n"
            "print('N', build_session().conf.get('spark.sql.shuffle.partitions'))\n"
            "print('M', build_session(shuffle_partitions=5).conf.get('spark.sql.shuffle.partitions'))\n") % ROOT
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300).stdout
    assert "N 23" in out and "M 5" in out


def test_scratch_goes_with_the_driver():
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from tidemark.session import build_session, scratch_path\n"
            "spark = build_session('local[1]')\n"
            "path = scratch_path(spark, 'product')\n"
            "spark.range(3).write.parquet(path)\n"
            "import os; print('P', path, os.path.exists(path))\n") % ROOT
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300).stdout
    path, was = next(line for line in out.splitlines() if line.startswith("P ")).split()[1:]
    assert was == "True" and not os.path.exists(path)


def test_materialize_and_release(spark):
    df = session.materialize(spark.range(5), "t")
    assert df.count() == 5 and session.path_exists(spark, df.scratch_path)
    session.release(df)
    assert not session.path_exists(spark, df.scratch_path)


def test_dimension_join_is_broadcast_by_size(spark):
    from tidemark.operators.joins import join_dimension
    fact, dim = spark.range(1000), session.materialize(spark.range(10).withColumnRenamed("id", "d"))
    on = fact.id == dim.d
    small = join_dimension(fact, dim, on)._jdf.queryExecution().analyzed().toString()
    large = join_dimension(fact, dim, on, max_bytes=1)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in small.lower() and "broadcast" not in large.lower()
