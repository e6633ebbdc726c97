"""Cuts: what they read, what is left in the shared folder, and that a cluster must name one."""

import os
import time
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from kithweave import runtime


def left(spark):
    return {f for f in os.listdir(urlparse(runtime.shared_dir(spark)).path) if f.startswith("cut-")}


def test_only_results_stay(spark):
    before = left(spark)

    def make():
        a = runtime.cut(spark.range(10))
        b = runtime.settled(lambda: runtime.cut(a.where("id > 3")).union(a))
        return b.where("id <> 5")

    out = runtime.settled(make)
    assert sorted(r.id for r in out.collect()) == sorted(x for x in [*range(4, 10), *range(10)] if x != 5)
    assert len(left(spark) - before) == 1
    runtime.drop_cut(out)
    assert left(spark) == before


def test_nothing_stays_of_a_failure(spark):
    before = left(spark)

    def make():
        runtime.cut(spark.range(3))
        raise ValueError("no")

    with pytest.raises(ValueError):
        runtime.settled(make)
    assert left(spark) == before and runtime._OPEN == []


def test_a_cluster_must_name_its_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        runtime.shared_dir(Session())


def test_bounded_reads(spark):
    assert len(runtime.bounded_rows(spark.range(3), 3, "x")) == 3
    with pytest.raises(ValueError):
        runtime.bounded_rows(spark.range(4), 3, "x")
    rows = runtime.bounded_sample(spark.range(1000), 100, ["id"])
    assert 50 < len(rows) < 200 and rows == runtime.bounded_sample(spark.range(1000), 100, ["id"])


def shuffles(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def freed(spark, before):
    for _ in range(50):  # the cleaner runs beside
        if shuffles(spark) <= before:
            return True
        time.sleep(0.1)
    return False


@pytest.fixture
def held_before(spark):
    """Shuffles that other tests' results still refer to."""
    for _ in range(3):
        runtime.release(spark)
        time.sleep(0.5)
    return shuffles(spark)


def test_release_frees_the_last_step_too(spark, held_before):
    out = runtime.cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    runtime.release(spark)
    assert freed(spark, held_before) and out.count() == 7


def test_parts_become_one_cut(spark, held_before):
    before, held = left(spark), []

    def parts():
        for i in range(3):
            held.append(freed(spark, held_before))
            yield spark.range(i * 10, i * 10 + 5).repartition(3)

    out = runtime.settled(lambda: runtime.cut_each(parts()))
    assert sorted(r.id for r in out.collect()) == [i * 10 + j for i in range(3) for j in range(5)] and held == [True] * 3
    assert len(left(spark) - before) == 1, "a result that is a cut is not written again"
    runtime.drop_cut(out)
    assert left(spark) == before
