"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from datetime import date

import pytest
from clinic import AS_OF
from pyspark.sql import functions as F

from wardline import testbed
from wardline.plans import insights, procedures, quality, reports, views
from wardline.plans.layout import write_by_month
from wardline.schema import BILLING, ENTITIES
from wardline.sources import Core
from wardline.sources.core import MONTH, read_monthly

RANGED = {"one_task_rows": 0, "buckets": 2}
PLANS = {
    **{name: view for name, view in views.VIEWS.items()},
    "top_doctors": reports.top_doctors,
    "top_patients": reports.top_patients,
    "monthly_revenue": reports.monthly_revenue,
    "patient_retention": reports.patient_retention,
    "patient_segmentation": reports.patient_segmentation,
    "doctor_performance": reports.doctor_performance,
    "treatment_performance": reports.treatment_performance,
    "appointment_status": reports.appointment_status,
    "payment_methods": reports.payment_methods,
    "age_gender": lambda core: reports.age_gender(core, AS_OF),
    "kpi_summary": reports.kpi_summary,
    "patient": lambda core: procedures.patient_analysis(core, "P1"),
    "doctor": lambda core: procedures.doctor_performance(core, "D1"),
    "revenue": lambda core: procedures.revenue_report(core, date(2023, 1, 1), date(2023, 2, 1)),
    "payment_status_share": insights.payment_status_share,
    "inactive_patients": insights.inactive_patients,
    "not_reached_rate": insights.not_reached_rate,
}


def explained(df, capfd) -> str:
    capfd.readouterr()
    df.explain("formatted")
    return capfd.readouterr().out


@pytest.mark.parametrize("name", PLANS)
def test_no_cross_joins_and_no_python(core, capfd, name):
    plan = explained(PLANS[name](core), capfd)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|MapInPandas|Expand", plan)


@pytest.mark.parametrize("name", ["top_doctors", "top_patients", "patient_segmentation", "treatment_performance"])
def test_large_ranks_do_not_meet_in_one_task(core, capfd, name):
    plan = explained(getattr(reports, name)(core, **RANGED), capfd)
    # What does meet there is the list of ranges, which is then broadcast.
    for single in re.findall(r"Exchange\n.*?Arguments: SinglePartition", plan):
        assert "_range" in plan[: plan.index(single)]


def test_scans_read_only_what_is_used(core, capfd):
    plan = explained(reports.monthly_revenue(core), capfd)
    assert "ReadSchema: struct<Bill_Date:date,Amount:decimal(10,2)>" in plan
    plan = explained(views.appointment_analysis(core), capfd)
    assert "ReadSchema: struct<Appointment_ID:string,Appointment_Date:date,Status:string>" in plan


def test_filters_reach_the_scan(core, capfd, monkeypatch):
    """What a lookup writes on its way is left in its plan here."""
    monkeypatch.setattr(procedures, "materialize", lambda df, label: df)
    for tables in (core, Core.of(core.tables())):
        plan = explained(procedures.patient_analysis(tables, "P1"), capfd)
        assert "EqualTo(Patient_ID,P1)" in plan


def test_lookups_read_each_table_once(core, capfd):
    """Visits and treatments of the key are small tables of their own; bills are read with them."""
    plan = explained(procedures.patient_analysis(Core.of(core.tables()), "P1"), capfd)
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) <= 5
    assert plan.count("/core/appointments") == 0 and plan.count("/core/treatments") == 0


def test_periods_prune_month_folders(spark, core, capfd, tmp_path):
    path = str(tmp_path / "billing")
    write_by_month(core.billing, BILLING, path, files=2)
    by_month = read_monthly(spark, BILLING, path)
    monthly = Core.of(core.tables(), {"Billing": by_month})
    start, end = date(2023, 1, 6), date(2023, 2, 10)
    plan = explained(procedures.revenue_report(monthly, start, end), capfd)
    assert re.search(r"PartitionFilters: \[.*_month.* >= 2023-01-01.*_month.* <= 2023-02-01", plan)
    assert "GreaterThanOrEqual(Bill_Date,2023-01-06)" in plan
    same = procedures.revenue_report(core, start, end).collect()
    assert procedures.revenue_report(monthly, start, end).collect() == same


def test_row_rules_share_one_scan(loaded, core, capfd):
    rules = tuple(r for r in quality.RULES["Patients"] if not isinstance(r, quality.Duplicate))
    assert len(rules) == 2
    plan = explained(quality.error_rows(ENTITIES["Patients"], core.tables(), AS_OF, rules), capfd)
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1
    assert "IsNull(Patient_ID)" in plan


def test_few_keys_do_not_shuffle_the_referring_table(core, capfd):
    rule = tuple(r for r in quality.RULES["Billing"] if getattr(r, "parent", "") == "Treatments")
    plan = explained(quality.error_rows(ENTITIES["Billing"], core.tables(), AS_OF, rule), capfd)
    assert "BroadcastHashJoin LeftAnti" in plan and "SortMergeJoin" not in plan


def test_month_layout_splits_a_hot_month_and_patient(spark, tmp_path):
    rows = spark.range(0, 6000, numPartitions=3).selectExpr(
        "concat('A', lpad(id, 5, '0')) as Appointment_ID",
        "if(id % 3 = 0, 'hot', concat('P', id % 500)) as Patient_ID",
        "cast(null as string) as Doctor_ID",
        "if(id % 3 < 2, date '2020-05-05', date_add(date '2020-01-01', cast(id % 300 as int))) as Appointment_Date",
        "'08:00:00' as Appointment_Time",
        "cast(null as string) as Reason_For_Visit",
        "'Completed' as Status",
    )
    entity, path = ENTITIES["Appointments"], str(tmp_path / "appointments")
    write_by_month(rows, entity, path, files=12)
    written = read_monthly(spark, entity, path)
    assert written.drop(MONTH).exceptAll(rows).isEmpty() and written.count() == 6000
    by_file = written.groupBy(F.input_file_name()).agg(F.count("*").alias("n"))
    assert by_file.agg(F.max("n")).first()[0] < 6000 / 6
    hot = written.where("Patient_ID = 'hot'").select(F.input_file_name()).distinct().count()
    assert hot > 3
    cold = written.where("Patient_ID = 'P7' and _month = date '2020-05-01'").select(F.input_file_name()).distinct()
    assert cold.count() == 1


def test_filters_of_month_files_are_sized_by_the_month(spark, tmp_path):
    """60,000 bills over 60 months: 60 files of a thousand rows, not of filters for 60,000 rows."""
    rows = spark.range(0, 60_000, numPartitions=2).selectExpr(
        "concat('B', id) as Bill_ID",
        "concat('P', id % 5000) as Patient_ID",
        "concat('T', id) as Treatment_ID",
        "add_months(date '2020-01-05', cast(id % 60 as int)) as Bill_Date",
        "cast(1 as decimal(10,2)) as Amount",
        "'Cash' as Payment_Method",
        "'Paid' as Payment_Status",
    )
    path = tmp_path / "billing"
    write_by_month(rows, BILLING, str(path), files=1)
    files = list(path.rglob("*.parquet"))
    assert len(files) == 60 and max(f.stat().st_size for f in files) < 60_000
    assert read_monthly(spark, BILLING, str(path)).drop(MONTH).exceptAll(rows).isEmpty()


def test_bills_of_the_test_tables_take_one_shuffle_of_the_lines(spark, tmp_path, capfd):
    lines = spark.range(0, 40).selectExpr(
        "id div 4 as l_orderkey", "cast(id % 2 as int) as l_linenumber", "cast(id as double) as l_extendedprice",
        "cast(0.1 as double) as l_discount", "timestamp '1997-01-01' as l_shipdate", "'A' as l_returnflag",
        "cast(1 as double) as l_quantity",
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = spark.range(0, 10).selectExpr("id as o_orderkey", "id as o_custkey", "'1-URGENT' as o_orderpriority")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    bills = testbed._Tables(spark, str(tmp_path)).billing()
    plan = explained(bills, capfd)
    assert "hashpartitioning(l_orderkey#" in plan and not re.search(r"hashpartitioning\(l_orderkey#\w+L?, l_linenumber", plan)
    assert bills.count() == 40 and bills.select("Bill_ID").distinct().count() == 40
