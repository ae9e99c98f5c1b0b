"""Large shuffles are cut by the rows they move, not by what the session happens to be set to."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from clinic import AS_OF, write_extracts

from wardline import session, testbed
from wardline.operators import joins
from wardline.plans import load, quality
from wardline.sources import open_core

PARTITIONS = "spark.sql.shuffle.partitions"


@pytest.fixture
def small_tasks(monkeypatch):
    """Ten rows a task; the parts of a shuffle while something is written."""
    monkeypatch.setattr(session, "ROWS_A_TASK", 10)
    monkeypatch.setattr(testbed, "ROWS_A_TASK", 10)
    seen = {}

    def materialize(df, label):
        seen[label] = int(df.sparkSession.conf.get(PARTITIONS))
        return session.materialize(df, label)

    for module in (joins, quality, load):
        monkeypatch.setattr(module, "materialize", materialize)
    return seen


def _plan(df, capfd) -> str:
    capfd.readouterr()
    df.explain()
    return capfd.readouterr().out


def test_repeated_keys_are_counted_in_as_many_tasks_as_the_rows_need(spark, small_tasks):
    before = spark.conf.get(PARTITIONS)
    staged = spark.range(200).selectExpr("cast(id % 150 as string) as k", "id")
    found = quality.repeated_keys(staged, "k", "again", 200)
    assert sorted(int(r.k) for r in found.collect()) == list(range(50))
    assert small_tasks["repeated"] == 20 and spark.conf.get(PARTITIONS) == before


def test_references_are_counted_in_as_many_tasks_as_both_sides_need(spark, small_tasks):
    before = spark.conf.get(PARTITIONS)
    left = spark.range(120).selectExpr("cast(id as string) as r")
    keys = spark.range(80).selectExpr("cast(id as string) as k")
    found = joins.anti_join(left, keys, "r", "k", 120, 80, broadcast_rows=5)
    assert sorted(int(r.r) for r in found.collect()) == list(range(80, 120))
    assert small_tasks["values"] == 20
    kept = joins.anti_join(left, keys, "r", "k", 120, 80, broadcast_rows=5, most_stay=True)
    assert sorted(int(r.r) for r in kept.collect()) == list(range(80, 120))
    assert small_tasks["hot"] == 12 and spark.conf.get(PARTITIONS) == before


@pytest.mark.parametrize("on_violation", [load.STOP, load.QUARANTINE])
def test_a_load_writes_in_as_many_tasks_as_its_largest_table_needs(spark, small_tasks, monkeypatch, tmp_path, on_violation):
    monkeypatch.setattr(session, "ROWS_A_TASK", 1)
    before, seen, write = spark.conf.get(PARTITIONS), [], load.write_core_table

    def spy(df, *rest):
        seen.append(int(spark.conf.get(PARTITIONS)))
        return write(df, *rest)

    monkeypatch.setattr(load, "write_core_table", spy)
    source = write_extracts(tmp_path)
    load.load_csv(spark, source, str(tmp_path / "root"), AS_OF, on_violation=on_violation)
    rows = max(r.Read_Rows - r.Rejected_Rows for r in load.load_log(spark, str(tmp_path / "root")).collect())
    assert rows > int(before) and seen and min(seen) >= rows
    assert open_core(spark, str(tmp_path / "root")).billing.count() > 0 and spark.conf.get(PARTITIONS) == before


def test_lines_are_dealt_by_their_number_and_sorted_after_the_shuffle_only(spark, small_tasks, tmp_path, capfd):
    day = datetime(1997, 5, 6)
    lines = [(i % 30, i % 7, 1, 1 + i % 2, 1.0, 100.0 + i, 0.01, 0.0, "A", "F", day) for i in range(100)]
    columns = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(7).selectExpr("id as p_partkey", "concat('type ', id) as p_type").write.parquet(f"{tmp_path}/part.parquet")
    orders = "id as o_orderkey, id as o_custkey, '1-URGENT' as o_orderpriority".split(", ")
    spark.range(30).selectExpr(*orders).write.parquet(f"{tmp_path}/orders.parquet")
    tables = testbed._Tables(spark, str(tmp_path))

    wanted = {}
    for order, part, _, number, _, price, *_ in lines:
        kind, cost = wanted.get((order, number), ("z", 0))
        wanted[order, number] = min(kind, f"type {part}"), max(cost, price)
    found = {(r.l_orderkey, r._line % 10): (r.Treatment_Type, float(r.Cost)) for r in tables.treatments().collect()}
    assert found == wanted and {r.Treatment_Date for r in tables.treatments().collect()} == {date(1997, 5, 6)}
    plan = _plan(tables.treatments(), capfd)
    assert "l_orderkey" in plan and plan.rindex("SortAggregate") < plan.index("Exchange hashpartitioning(_line")
    assert ", 10), REPARTITION_BY_NUM" in plan
    bills = tables.billing()
    assert bills.count() == 100 and bills.select("Bill_ID").distinct().count() == 100
    assert ", 10), REPARTITION_BY_NUM" in _plan(bills, capfd)
