"""Random cores with NULLs, idle entities and several bills per treatment, against plain SQL."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import duckdb
import oracle
import pyarrow as pa
import pyarrow.parquet
import pytest
from clinic import AS_OF
from compare import _multiset, spark_rows

from wardline.plans import insights, procedures, reports, views
from wardline.schema import ENTITIES
from wardline.sources import Core

RANGED = {"one_task_rows": 0, "buckets": 5}
PERIOD = date(1997, 1, 1), date(1998, 6, 30)
PLANS = {
    "view_patient_analysis": views.patient_analysis,
    "view_doctor_performance": views.doctor_performance,
    "view_revenue_analysis": views.revenue_analysis,
    "view_appointment_analysis": views.appointment_analysis,
    "report_top_doctors": reports.top_doctors,
    "report_top_patients": reports.top_patients,
    "global_dense_rank": lambda core: reports.top_patients(core, **RANGED),
    "report_monthly_revenue": reports.monthly_revenue,
    "report_patient_retention": reports.patient_retention,
    "retention_in_pieces": lambda core: reports.patient_retention(core, chunk=1, one_task_copies=0),
    "report_patient_segmentation": reports.patient_segmentation,
    "report_doctor_performance": lambda core: reports.doctor_performance(core, **RANGED),
    "report_treatment_performance": lambda core: reports.treatment_performance(core, **RANGED),
    "report_appointment_status": reports.appointment_status,
    "report_payment_methods": reports.payment_methods,
    "report_age_gender": lambda core: reports.age_gender(core, AS_OF),
    "report_kpi_summary": reports.kpi_summary,
    "proc_patient_analysis": lambda core: procedures.patient_analysis(core, "12"),
    "proc_doctor_performance": lambda core: procedures.doctor_performance(core, "5", max_rows=0),
    "proc_revenue_report": lambda core: procedures.revenue_report(core, *PERIOD),
    "insight_payment_status_share": insights.payment_status_share,
    "insight_inactive_patients": insights.inactive_patients,
    "insight_not_reached_rate": insights.not_reached_rate,
}


def random_rows(seed: int) -> dict[str, list[dict]]:
    pick = random.Random(seed)

    def maybe(value, gap=0.1):
        return None if pick.random() < gap else value

    def day(first: int, days: int) -> date:
        return date(first, 1, 1) + timedelta(pick.randrange(days))

    def amount(top: int) -> Decimal:
        return Decimal(pick.randrange(top * 100)) / 100

    def reference(prefix: str, count: int):
        # One value holds a third of the references.
        return maybe(f"{prefix}{0 if pick.random() < 1 / 3 else pick.randrange(count)}")

    return {
        "Patients": [
            {
                "Patient_ID": f"{i}",
                "First_Name": maybe("Ann"),
                "Last_Name": maybe(f"L{i}"),
                "Gender": maybe(pick.choice("FM")),
                "Date_Of_Birth": day(1920, 38_000),
                "Insurance_Provider": maybe("Care"),
            }
            for i in range(60)
        ],
        "Doctors": [
            {"Doctor_ID": f"{i}", "First_Name": maybe("Bob"), "Specialization": maybe("S", 0.3)} for i in range(15)
        ],
        "Appointments": [
            {
                "Appointment_ID": f"A{i}",
                "Patient_ID": reference("", 50),
                "Doctor_ID": reference("", 12),
                "Appointment_Date": maybe(day(1996, 90)),
                "Status": maybe(pick.choice(["Completed", "Cancelled", "No-show", "Scheduled", "Other"])),
            }
            for i in range(300)
        ],
        "Treatments": [
            {
                "Treatment_ID": f"T{i}",
                "Appointment_ID": reference("A", 280),
                "Treatment_Type": maybe(pick.choice(["MRI", "ECG", "X-Ray"])),
                "Cost": maybe(amount(50)),
            }
            for i in range(400)
        ],
        "Billing": [
            {
                "Bill_ID": f"B{i}",
                "Patient_ID": reference("", 50),
                "Treatment_ID": reference("T", 350),
                "Bill_Date": maybe(day(1996, 1000)),
                "Amount": maybe(amount(20)),
                "Payment_Method": maybe(pick.choice(["Cash", "Card"])),
                "Payment_Status": maybe(pick.choice(["Paid", "Pending", "Failed"])),
            }
            for i in range(700)
        ],
    }


ARROW = {"string": pa.string(), "int": pa.int32(), "date": pa.date32(), "decimal(10,2)": pa.decimal128(10, 2)}


@pytest.fixture(scope="module", params=[1, 2])
def both(request, spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("random")
    tables, connection = {}, duckdb.connect()
    for name, rows in random_rows(request.param).items():
        entity = ENTITIES[name]
        schema = pa.schema([(f.name, ARROW[f.type]) for f in entity.fields])
        frame = pa.Table.from_pylist([{c: row.get(c) for c in entity.columns} for row in rows], schema)
        path = str(folder / f"{name}.parquet")
        pa.parquet.write_table(frame, path)
        connection.execute(f"create view {name} as select * from '{path}'")
        tables[name] = spark.read.schema(entity.ddl).parquet(path)
    return Core.of(tables), connection


@pytest.mark.parametrize("name", PLANS)
def test_same_rows(both, name):
    core, connection = both
    result = connection.execute(oracle.on_core_tables()[name])
    names = [d[0] for d in result.description]
    expected = _multiset(names, result.fetchall())
    spark_names, _, rows = spark_rows(PLANS[name](core))
    assert sorted(spark_names) == sorted(names)
    assert rows == expected
