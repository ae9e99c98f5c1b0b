"""Summaries for one patient, one doctor or one period, as DataFrames and as SQL table functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import average, full_name, money
from wardline.operators.joins import BROADCAST_ROWS, prefilter
from wardline.plans.facts import fact_chain, visits
from wardline.plans.layout import in_period
from wardline.session import materialize
from wardline.sources.core import MONTH, Core


def _chain_of(core: Core, column: str, value: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The fact chain of the appointments with ``column`` = ``value``, read if its load has published it.

    Otherwise each table is scanned once: what belongs to the key is written, its row count comes with it, and
    it selects rows of the next table, broadcast as long as it has at most ``max_rows``. Beyond that
    the next tables are joined as they are, since a shuffle by a hot key would not be cheaper.
    """
    if core.visits is not None:
        return core.visits.where(F.col(column) == value)
    own = core.appointments.where(F.col(column) == value)
    own = materialize(own.select("Appointment_ID", "Patient_ID", "Doctor_ID", "Appointment_Date"), "visits")
    treatments = prefilter(core.treatments, own, "Appointment_ID", max_rows)
    if treatments is core.treatments:
        return fact_chain(own, treatments, core.billing)
    treatments = materialize(treatments, "treatments")
    return fact_chain(own, treatments, prefilter(core.billing, treatments, "Treatment_ID", max_rows))


def patient_analysis(core: Core, patient_id: str, **limits: int) -> DataFrame:
    """One row, or none if the patient is unknown or has no billed treatment."""
    totals = (
        _chain_of(core, "Patient_ID", patient_id, **limits)
        .groupBy("Patient_ID")
        .agg(
            F.count("*").alias("Total_Visits"),
            F.sum("Treatments").alias("Total_Treatments"),
            money(F.sum("Amount")).alias("Total_Paid_Amount"),
            F.max("Appointment_Date").alias("Last_Visit_Date"),
        )
    )
    patient = core.patients.select("Patient_ID", full_name().alias("Patient_Name"))
    return totals.join(patient, "Patient_ID").select(
        "Patient_ID", "Patient_Name", "Total_Visits", "Total_Treatments", "Total_Paid_Amount", "Last_Visit_Date"
    )


def doctor_performance(core: Core, doctor_id: str, **limits: int) -> DataFrame:
    """One row, or none if the doctor is unknown or has no billed treatment."""
    totals = (
        _chain_of(core, "Doctor_ID", doctor_id, **limits)
        .groupBy("Doctor_ID")
        .agg(
            F.count_distinct("Patient_ID").alias("Total_Patients"),
            F.count("*").alias("Total_Visits"),
            money(F.sum("Amount")).alias("Total_Revenue"),
            average(F.sum("Weighted_Cost"), F.sum("Cost_Weight")).alias("Avg_Treatment_Cost"),
        )
    )
    doctor = core.doctors.select("Doctor_ID", full_name().alias("Doctor_Name"), "Specialization")
    return totals.join(doctor, "Doctor_ID").select(
        "Doctor_ID",
        "Doctor_Name",
        "Specialization",
        "Total_Patients",
        "Total_Visits",
        "Total_Revenue",
        "Avg_Treatment_Cost",
    )


def revenue_report(core: Core, start: date, end: date) -> DataFrame:
    """Always one row; a period without bills has a zero count and NULL figures."""
    bills = core.by_date("Billing")
    return bills.where(in_period(bills, "Bill_Date", start, end)).agg(
        F.lit(start).alias("Start_Date"),
        F.lit(end).alias("End_Date"),
        F.count("Bill_ID").alias("Total_Bills"),
        money(F.sum("Amount")).alias("Total_Revenue"),
        average(F.sum("Amount"), F.count("Amount")).alias("Average_Bill_Amount"),
        F.max("Amount").alias("Highest_Bill"),
        F.min("Amount").alias("Lowest_Bill"),
    )


# --- the same for callers that speak SQL ---

_NAME = "concat(coalesce(First_Name, ''), ' ', coalesce(Last_Name, ''))"


def _mean(total: str, count: str) -> str:
    """As ``functions.average``."""
    return f"cast(cast({total} as decimal(24,2)) / nullif(cast({count} as decimal(20,2)), 0) as decimal(38,6))"


_FUNCTIONS = {
    "patient_analysis": (
        "patient string",
        "Patient_ID string, Patient_Name string, Total_Visits bigint, Total_Treatments bigint, "
        "Total_Paid_Amount decimal(38,2), Last_Visit_Date date",
        f"""select Patient_ID, {_NAME}, Total_Visits, Total_Treatments, Total_Paid_Amount, Last_Visit_Date
            from (select Patient_ID, count(*) as Total_Visits, sum(Treatments) as Total_Treatments,
                         cast(sum(Amount) as decimal(38,2)) as Total_Paid_Amount, max(Appointment_Date) as Last_Visit_Date
                  from Visits where Patient_ID = patient_analysis.patient group by Patient_ID)
            join Patients using (Patient_ID)""",
    ),
    "doctor_performance": (
        "doctor string",
        "Doctor_ID string, Doctor_Name string, Specialization string, Total_Patients bigint, Total_Visits bigint, "
        "Total_Revenue decimal(38,2), Avg_Treatment_Cost decimal(38,6)",
        f"""select Doctor_ID, {_NAME}, Specialization, Total_Patients, Total_Visits, Total_Revenue, Avg_Treatment_Cost
            from (select Doctor_ID, count(distinct Patient_ID) as Total_Patients, count(*) as Total_Visits,
                         cast(sum(Amount) as decimal(38,2)) as Total_Revenue,
                         {_mean("sum(Weighted_Cost)", "sum(Cost_Weight)")} as Avg_Treatment_Cost
                  from Visits where Doctor_ID = doctor_performance.doctor group by Doctor_ID)
            join Doctors using (Doctor_ID)""",
    ),
    "revenue_report": (
        "first_day date, last_day date",
        "Start_Date date, End_Date date, Total_Bills bigint, Total_Revenue decimal(38,2), "
        "Average_Bill_Amount decimal(38,6), Highest_Bill decimal(10,2), Lowest_Bill decimal(10,2)",
        f"""select revenue_report.first_day, revenue_report.last_day, bills, revenue, mean, highest, lowest
            from (select count(Bill_ID) as bills, cast(sum(Amount) as decimal(38,2)) as revenue,
                         {_mean("sum(Amount)", "count(Amount)")} as mean, max(Amount) as highest, min(Amount) as lowest
                  from Bills_By_Date
                  where Bill_Date between revenue_report.first_day and revenue_report.last_day {{months}})""",
    ),
}
_MONTHS = (
    f"and {MONTH} between trunc(revenue_report.first_day, 'month') and trunc(revenue_report.last_day, 'month')"
)


def register_functions(core: Core) -> None:
    """Make the summaries callable from ``spark.sql``: ``select * from patient_analysis('P012')``.

    They are temporary functions over temporary views of this session, which are replaced when a later
    run is registered.
    """
    spark = core.patients.sparkSession
    core.register_views()
    visits(core).createOrReplaceTempView("Visits")
    bills = core.by_date("Billing")
    bills.createOrReplaceTempView("Bills_By_Date")
    months = _MONTHS if MONTH in bills.columns else ""
    for name, (parameters, columns, body) in _FUNCTIONS.items():
        spark.sql(
            f"create or replace temporary function {name}({parameters}) returns table ({columns}) "
            f"return {body.format(months=months)}"
        )
