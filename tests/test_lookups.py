"""Published visits, layouts with two lookup columns, Bloom filters, and summaries called from SQL."""

from __future__ import annotations

import json
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest
from clinic import AS_OF, write_extracts
from pyspark.sql import functions as F

from wardline.plans import facts, load, procedures, reports
from wardline.plans.layout import _range_number, _spread, write_sorted
from wardline.schema import APPOINTMENTS, ENTITIES, VISITS
from wardline.sources import Core
from wardline.sources.parquet import conform

REPORTS = {
    "top_doctors": reports.top_doctors,
    "top_patients": reports.top_patients,
    "patient_segmentation": reports.patient_segmentation,
    "doctor_performance": reports.doctor_performance,
    "patient": lambda core: procedures.patient_analysis(core, "P1"),
    "doctor": lambda core: procedures.doctor_performance(core, "D1"),
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def rows_of(df) -> list:
    return sorted(map(tuple, df.collect()), key=str)


# --- visits published with the core ---


def test_published_visits_are_the_fact_chain(core):
    joined = conform(facts.fact_chain(core.appointments, core.treatments, core.billing), VISITS)
    assert core.visits.dtypes == joined.dtypes and rows_of(core.visits) == rows_of(joined) and core.visits.count() > 2


@pytest.mark.parametrize("name", REPORTS)
def test_reports_read_visits_in_place_of_facts(core, name):
    files = REPORTS[name](core).inputFiles()
    assert any("/core/visits/" in f for f in files)
    assert not any(f"/core/{table}/" in f for f in files for table in ("appointments", "treatments", "billing"))


@pytest.mark.parametrize("name", REPORTS)
def test_same_rows_without_published_visits(core, name):
    assert rows_of(REPORTS[name](core)) == rows_of(REPORTS[name](Core.of(core.tables())))


def test_a_load_without_visits(spark, tmp_path, core):
    (tmp_path / "in").mkdir()
    result = load.load_csv(spark, write_extracts(tmp_path / "in"), str(tmp_path / "root"), AS_OF, with_visits=False)
    assert result.core.visits is None
    assert not (tmp_path / "root" / f"run={result.run}" / "core" / "visits").exists()
    assert rows_of(reports.top_doctors(result.core)) == rows_of(reports.top_doctors(core))


# --- two lookup columns ---


def test_range_numbers(spark):
    limits = ["b", "d", "d", "f", "f", "f", "x"]
    values = ["", "a", "b", "c", "d", "e", "f", "w", "x", "z", None]
    df = spark.createDataFrame([(v,) for v in values], "v string").withColumn("n", _range_number(F.col("v"), limits))
    assert {r.v: r.n for r in df.collect()} == {v: 0 if v is None else sum(x <= v for x in limits) for v in values}


def test_bits_take_turns(spark):
    numbers = [0, 1, 2, 5, 1023, 4095, 65535]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint").withColumn("s", _spread(F.col("n")))
    assert {r.n: r.s for r in df.collect()} == {n: int("0".join(f"{n:b}"), 2) for n in numbers}


def _visits(spark, n=40_000):
    """A third of all visits are of one patient, a third of one doctor."""
    return conform(
        spark.range(n, numPartitions=4).selectExpr(
            "concat('A', lpad(id, 6, '0')) as Appointment_ID",
            "if(id % 3 = 0, 'P0500', concat('P', lpad(pmod(hash(id), 1000), 4, '0'))) as Patient_ID",
            "if(id % 3 = 1, 'D0500', concat('D', lpad(pmod(hash(id, 7), 1000), 4, '0'))) as Doctor_ID",
        ),
        APPOINTMENTS,
    )


def test_a_lookup_by_either_column_reads_few_files(spark, tmp_path):
    rows, path, files = _visits(spark), str(tmp_path / "visits"), 64
    write_sorted(rows, APPOINTMENTS, path, files)
    written = spark.read.parquet(path)
    assert written.columns == APPOINTMENTS.columns and written.exceptAll(rows).isEmpty() and written.count() == 40_000
    sizes = written.groupBy(F.input_file_name().alias("f")).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[1] >= files * 3 / 4 and sizes[0] < 40_000 / files * 3
    for column, prefix in (("Patient_ID", "P"), ("Doctor_ID", "D")):
        bounds = written.groupBy(F.input_file_name()).agg(F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for number in (17, 250, 730, 999):
            value = f"{prefix}{number:04d}"
            # Files that their footers cannot rule out: about a square root of all, however the hot values lie.
            assert 1 <= sum(b.low <= value <= b.high for b in bounds) <= files / 2.5, value
        hot = written.where(F.col(column) == f"{prefix}0500").select(F.input_file_name()).distinct().count()
        assert hot > files / 8


def test_rows_without_values_and_without_rows(spark, tmp_path):
    rows = conform(spark.range(50).selectExpr("cast(id as string) as Appointment_ID"), APPOINTMENTS)
    for name, df in (("nulls", rows), ("none", rows.limit(0))):
        path = str(tmp_path / name)
        write_sorted(df, APPOINTMENTS, path, 4)
        assert spark.read.schema(APPOINTMENTS.ddl).parquet(path).count() == df.count()


# --- Bloom filters ---

# Reads one bill by its key and one by a key that is not there, from a table sorted by something else.
PROGRAM = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import functions as F
from wardline.plans.layout import write_sorted
from wardline.schema import BILLING
from wardline.session import local_session
from wardline.sources.parquet import conform

spark = local_session("2", **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": sys.argv[2], "spark.eventLog.compress": "false"})
rows = conform(spark.range(60_000, numPartitions=2).selectExpr(
    "md5(cast(id as string)) as Bill_ID", "md5(concat('p', id)) as Patient_ID", "md5(concat('t', id)) as Treatment_ID"), BILLING)
path = sys.argv[3]
write_sorted(rows, BILLING, path, 12, {"Patients": 5_000, "Treatments": 60_000})
bills = spark.read.schema(BILLING.ddl).parquet(path)
for bill in (17, -1):
    key = spark.sql(f"select md5('{bill}')").first()[0]
    spark.sparkContext.setJobDescription(f"lookup {bill}")
    assert bills.where(F.col("Bill_ID") == key).count() == (bill > 0)
spark.stop()
"""


def test_bloom_filters_skip_row_groups(tmp_path):
    program, logs = tmp_path / "program.py", tmp_path / "logs"
    program.write_text(PROGRAM)
    logs.mkdir()
    repository = str(Path(__file__).resolve().parents[1])
    subprocess.run([sys.executable, program, repository, logs, str(tmp_path / "bills")], check=True, timeout=300)
    described, read = {}, {}
    for file in logs.rglob("*"):
        for line in file.read_text().splitlines() if file.is_file() and file.suffix != ".crc" else ():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                name = event["Properties"].get("spark.job.description", "")
                described |= {stage: name for stage in event["Stage IDs"]}
            elif event["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in event:
                name = described.get(event["Stage ID"], "")
                read[name] = read.get(name, 0) + event["Task Metrics"]["Input Metrics"]["Records Read"]
    # Without filters every one of the 12 files could hold the key: 60,000 rows.
    assert 1 <= read["lookup 17"] <= 60_000 / 4
    assert read.get("lookup -1", 0) <= 60_000 / 4


# --- summaries from SQL ---


def test_summaries_from_sql(spark, core):
    procedures.register_functions(core)
    for patient in ("P1", "P2", "P6", "nobody", "it's"):
        found = spark.sql("select * from patient_analysis(:p)", args={"p": patient})
        expected = procedures.patient_analysis(core, patient)
        assert found.dtypes == expected.dtypes and found.collect() == expected.collect()
    for doctor in ("D1", "D2", "D3"):
        found = spark.sql("select * from doctor_performance(:d)", args={"d": doctor})
        expected = procedures.doctor_performance(core, doctor)
        assert found.dtypes == expected.dtypes and found.collect() == expected.collect()
    for days in ((date(2023, 1, 1), date(2023, 2, 1)), (date(1990, 1, 1), date(1990, 1, 2))):
        found = spark.sql("select * from revenue_report(:a, :b)", args={"a": days[0], "b": days[1]})
        expected = procedures.revenue_report(core, *days)
        assert found.dtypes == expected.dtypes and found.collect() == expected.collect()


def test_filters_of_sql_calls_reach_the_scan(spark, core, tmp_path):
    procedures.register_functions(core)
    assert "EqualTo(Patient_ID,P1)" in plan_of(spark.sql("select * from patient_analysis('P1')"))
    assert "EqualTo(Doctor_ID,D1)" in plan_of(spark.sql("select * from doctor_performance('D1')"))
    (tmp_path / "in").mkdir()
    monthly = load.load_csv(spark, write_extracts(tmp_path / "in"), str(tmp_path / "root"), AS_OF, layout_rows=0).core
    procedures.register_functions(monthly)
    call = spark.sql("select * from revenue_report(date '2023-01-06', date '2023-02-10')")
    assert "PartitionFilters: [isnotnull(_month" in plan_of(call)
    assert call.collect() == procedures.revenue_report(core, date(2023, 1, 6), date(2023, 2, 10)).collect()
    assert set(ENTITIES) <= {t.name.capitalize() for t in spark.catalog.listTables() if t.isTemporary}
