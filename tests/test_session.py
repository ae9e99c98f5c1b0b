from __future__ import annotations

from threading import Thread
from types import SimpleNamespace

import pytest

from wardline import session
from wardline.session import bounded_tasks, materialize, scratch_root


def _session(configured: str | None):
    settings = {"spark.checkpoint.dir": configured, "spark.sql.warehouse.dir": "hdfs:///warehouse/"}
    return SimpleNamespace(
        sparkContext=SimpleNamespace(applicationId="app-1"),
        conf=SimpleNamespace(get=lambda name, default=None: settings[name] or default),
    )


def test_scratch_lies_in_the_folder_the_cluster_names():
    assert scratch_root(_session("hdfs:///shared/")) == "hdfs:///shared/wardline-app-1"


def test_without_one_scratch_lies_in_the_warehouse():
    assert scratch_root(_session(None)) == "hdfs:///warehouse/_scratch/wardline-app-1"


def test_materialized_rows_do_not_depend_on_their_origin(spark, capfd):
    df = spark.range(10).selectExpr("id", "id % 3 as k")
    written = materialize(df, "test")
    assert written.exceptAll(df).isEmpty() and written.columns == df.columns
    capfd.readouterr()
    written.select("k").explain("formatted")
    plan = capfd.readouterr().out
    assert "Range" not in plan and "ReadSchema: struct<k:bigint>" in plan


PARTITIONS = "spark.sql.shuffle.partitions"
SETTINGS = (PARTITIONS, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")


def _settings(spark):
    return [spark.conf.get(name) for name in SETTINGS]


def test_tasks_are_bounded_inside_and_the_session_is_as_before_afterwards(spark):
    before = _settings(spark)
    with pytest.raises(KeyError), bounded_tasks(spark, 30 * session.ROWS_A_TASK):
        assert _settings(spark) == ["30", "8m", "16m"]
        with bounded_tasks(spark, 3 * session.ROWS_A_TASK):
            assert _settings(spark) == ["30", "8m", "16m"]
        assert _settings(spark) == ["30", "8m", "16m"]
        raise KeyError
    assert _settings(spark) == before


def test_few_rows_and_smaller_tasks_leave_the_settings_as_they_are(spark):
    before = _settings(spark)
    try:
        spark.conf.set(SETTINGS[1], "64k")
        spark.conf.set(SETTINGS[2], "1048576b")
        with bounded_tasks(spark, 2):
            assert _settings(spark) == [before[0], "64k", "1048576b"]
    finally:
        for name, value in zip(SETTINGS, before):
            spark.conf.set(name, value)


def test_of_threads_that_overlap_the_last_one_restores_the_settings(spark):
    before, inner = _settings(spark), bounded_tasks(spark, 40 * session.ROWS_A_TASK)
    with bounded_tasks(spark, 20 * session.ROWS_A_TASK):
        thread = Thread(target=inner.__enter__)
        thread.start()
        thread.join()
    assert _settings(spark) == ["40", "8m", "16m"]
    inner.__exit__(None, None, None)
    assert _settings(spark) == before


@pytest.mark.parametrize("text, size", [("134217728b", 128 << 20), ("128MB", 128 << 20), ("64m", 64 << 20), ("10", 10), ("1 gib", 1 << 30)])
def test_sizes_are_read_as_spark_writes_them(text, size):
    assert session._bytes(text) == size
