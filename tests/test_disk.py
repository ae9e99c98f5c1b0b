"""What loads leave on disk, and what they compute twice."""

from __future__ import annotations

import time
from datetime import timedelta

import pytest
from clinic import AS_OF, write_extracts
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wardline.plans import layout, load
from wardline.session import bounded_tasks
from wardline.sources.csv import read_csv_extracts


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_what_a_query_has_shuffled_is_removed_when_it_ends(spark, tmp_path):
    before, setting = _shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    outside = spark.conf.get(setting)
    counted = spark.range(10_000).selectExpr("id % 1000 as k").groupBy("k").count()
    with bounded_tasks(spark):
        counted.write.parquet(str(tmp_path / "counted"))
        assert spark.read.parquet(str(tmp_path / "counted")).count() == 1000
        end = time.time() + 20
        while (left := _shuffle_files(spark) - before) and time.time() < end:
            time.sleep(0.2)
    assert not left
    assert spark.conf.get(setting) == outside


def test_shuffled_rows_come_back_if_they_are_asked_for_again(spark):
    counted = spark.range(10_000).selectExpr("id % 1000 as k").groupBy("k").count()
    with bounded_tasks(spark):
        first = sorted(counted.collect())
        assert sorted(counted.collect()) == first and len(first) == 1000


@pytest.mark.parametrize("on_violation", [load.STOP, load.QUARANTINE])
def test_ranges_are_drawn_from_written_tables(spark, tmp_path, monkeypatch, core, on_violation):
    """The limits of ranges cost a scan; no exclusion and no chain of visits is computed for them."""
    plans, limits = [], layout._range_limits

    def noted(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return limits(df, *args)

    monkeypatch.setattr(layout, "_range_limits", noted)
    (tmp_path / "in").mkdir()
    source, root = write_extracts(tmp_path / "in"), str(tmp_path / "out")
    # No broadcast: what is excluded would be joined by a shuffle.
    found = load.load_csv(spark, source, root, AS_OF, layout_rows=1, on_violation=on_violation, broadcast_rows=0).core
    assert len(plans) == 3 and not any("Join" in p or "Aggregate" in p for p in plans)
    for name, rows in core.tables().items():
        assert sorted(map(str, found.tables()[name].collect())) == sorted(map(str, rows.collect()))
    assert sorted(map(str, found.visits.collect())) == sorted(map(str, core.visits.collect()))


def test_queries_keep_no_staged_tables_and_no_failed_loads(spark, monkeypatch, tmp_path):
    (tmp_path / "in").mkdir()
    feed = read_csv_extracts(spark, write_extracts(tmp_path / "in"))
    unborn = F.when(F.col("Patient_ID") == "P1", F.lit(AS_OF + timedelta(days=1))).otherwise(F.col("Date_Of_Birth"))
    # P1 is quarantined and has appointments, so that the load stops.
    dirty = feed | {"Patients": feed["Patients"].withColumn("Date_Of_Birth", unborn)}
    monkeypatch.setattr(entry, "_prepared", {})
    monkeypatch.setattr(entry, "scratch_root", lambda spark: str(tmp_path))
    monkeypatch.setattr(entry.testbed, "clean_feed", lambda spark, sf_dir: feed)
    monkeypatch.setattr(entry.testbed, "dirty_feed", lambda spark, sf_dir: dirty)
    for day in ("AS_OF", "DIRTY_AS_OF"):
        monkeypatch.setattr(entry.testbed, day, AS_OF)

    published = {r.Table_Name: r.Row_Count for r in entry.queries()["load_publish"](spark, "tables").collect()}
    assert published == {"Patients": 3, "Doctors": 3, "Appointments": 5, "Treatments": 5, "Billing": 6}
    assert entry.queries()["load_log"](spark, "tables").count() == 15
    # Published: the clean load, and in the other folder the one with quarantine, too.
    for folder, runs, staged in (("clinic-" + "?" * 32, 1, 0), ("clinic-loads-*", 2, 1)):
        (root,) = tmp_path.glob(folder)
        assert len(list(root.glob("run=*"))) == runs
        assert len(list(root.glob("run=*/staging"))) == staged
