"""The eleven analytical reports. Unlike the views, the ranked ones drop inactive entities."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions import age_years, average, full_name, money, month_name, percent, quotient
from wardline.operators import dense_rank_desc, repeat_rows, with_total
from wardline.plans.facts import billed_treatments, visits
from wardline.schema import CANCELLED, COMPLETED, NO_SHOW, PAID, PENDING
from wardline.sources.core import Core

# Labels and limits.
NEW, RETURNING = "New Patient", "Returning Patient"
ONE_TIME, VIP, REGULAR = "One-Time Patient", "VIP Patient", "Regular Patient"
VIP_VISITS = 3
AGE_GROUPS = ((17, "Under 18"), (35, "18-35"), (50, "36-50"), (65, "51-65"))
OLDEST_GROUP = "Over 65"


def _doctor_totals(core: Core) -> DataFrame:
    totals = (
        visits(core).where(F.col("Doctor_ID").isNotNull())
        .groupBy("Doctor_ID")
        .agg(
            F.count("*").alias("Total_Visits"),
            F.count_distinct("Patient_ID").alias("Total_Patients"),
            money(F.sum("Amount")).alias("Total_Revenue"),
            average(F.sum("Weighted_Cost"), F.sum("Cost_Weight"), "decimal(10,2)").alias("Avg_Treatment_Cost"),
        )
    )
    return totals.join(core.doctors, "Doctor_ID").withColumn("Doctor_Name", full_name())


def _patient_totals(core: Core) -> DataFrame:
    totals = (
        visits(core).where(F.col("Patient_ID").isNotNull())
        .groupBy("Patient_ID")
        .agg(
            F.count("*").alias("Total_Visits"),
            F.sum("Treatments").alias("Total_Treatments"),
            money(F.sum("Amount")).alias("Total_Spending"),
        )
    )
    return totals.join(core.patients, "Patient_ID").withColumn("Patient_Name", full_name())


def top_doctors(core: Core, **ranking) -> DataFrame:
    doctors = _doctor_totals(core).select(
        "Doctor_ID", "Doctor_Name", "Specialization", "Total_Visits", "Total_Patients", "Total_Revenue"
    )
    return dense_rank_desc(
        doctors, "Total_Revenue", "Revenue_Rank", "Doctor_ID", max_rows=core.row_count("Doctors"), **ranking
    )


def top_patients(core: Core, **ranking) -> DataFrame:
    patients = _patient_totals(core).select(
        "Patient_ID",
        "Patient_Name",
        "Total_Visits",
        "Total_Treatments",
        "Total_Spending",
        average(F.col("Total_Spending"), F.col("Total_Visits"), "decimal(10,2)").alias("Average_Spend"),
    )
    return dense_rank_desc(
        patients, "Total_Spending", "Spending_Rank", "Patient_ID", max_rows=core.row_count("Patients"), **ranking
    )


def monthly_revenue(core: Core) -> DataFrame:
    """Billed money per month and its change from the last month that has any bill."""
    months = core.billing.groupBy(
        F.year("Bill_Date").alias("Revenue_Year"), F.month("Bill_Date").alias("Revenue_Month")
    ).agg(money(F.sum("Amount")).alias("Total_Revenue"))
    # One row per calendar month, so a single task orders a few thousand rows at most.
    by_month = Window.orderBy("Revenue_Year", "Revenue_Month")
    previous = F.col("Previous_Month_Revenue")
    difference = F.col("Total_Revenue") - previous
    return months.withColumn("Previous_Month_Revenue", F.lag("Total_Revenue").over(by_month)).select(
        "Revenue_Year",
        "Revenue_Month",
        month_name(F.make_date("Revenue_Year", "Revenue_Month", F.lit(1))).alias("Revenue_Month_Name"),
        "Total_Revenue",
        "Previous_Month_Revenue",
        money(difference).alias("Revenue_Difference"),
        quotient(difference * 100, previous).cast("decimal(10,2)").alias("Growth_Percentage"),
    )


def patient_retention(core: Core, **repeating) -> DataFrame:
    """Every visit with the date of the visit before; the first one is New, others Returning.

    Visits of a patient on one day differ in nothing that is returned: the first follows
    the previous day with a visit, the others follow that same day. So visits are counted
    per patient and day, which leaves at most one row per calendar day for the window
    whatever the number of visits, and the counts are turned back into rows at the end.
    """
    days = (
        core.appointments.where(F.col("Patient_ID").isNotNull())
        .groupBy("Patient_ID", "Appointment_Date")
        .agg(F.count("*").alias("_visits"))
    )
    by_day = Window.partitionBy("Patient_ID").orderBy("Appointment_Date")
    first_and_others = F.array(
        F.struct(F.col("_before").alias("previous"), F.lit(1).cast("bigint").alias("visits")),
        F.struct(F.col("Appointment_Date").alias("previous"), (F.col("_visits") - 1).alias("visits")),
    )
    counted = (
        days.withColumn("_before", F.lag("Appointment_Date").over(by_day))
        .join(core.patients.select("Patient_ID", full_name().alias("Patient_Name")), "Patient_ID")
        .select("Patient_ID", "Patient_Name", "Appointment_Date", F.inline(first_and_others))
    )
    each = repeat_rows(counted, "visits", total=core.row_count("Appointments"), **repeating)
    return each.select(
        "Patient_ID",
        "Patient_Name",
        "Appointment_Date",
        F.col("previous").alias("Previous_Visit_Date"),
        F.when(F.col("previous").isNull(), NEW).otherwise(RETURNING).alias("Patient_Status"),
    )


def patient_segmentation(core: Core, **ranking) -> DataFrame:
    patients = _patient_totals(core).select(
        "Patient_ID", "Patient_Name", "Total_Visits", "Total_Treatments", "Total_Spending"
    )
    most = core.row_count("Patients")
    ranked = dense_rank_desc(patients, "Total_Spending", "Spending_Rank", "Patient_ID", max_rows=most, **ranking)
    one_task = {k: v for k, v in ranking.items() if k == "one_task_rows"}
    totals = with_total(ranked, "_spending", F.sum("Total_Spending"), max_rows=most, **one_task)
    totals = with_total(totals, "_spenders", F.count("Total_Spending"), max_rows=most, **one_task)
    spender = F.col("Total_Spending") > F.col("Avg_Patient_Spending")
    return totals.withColumn("Avg_Patient_Spending", average(F.col("_spending"), F.col("_spenders"))).select(
        "Patient_ID",
        "Patient_Name",
        "Total_Visits",
        "Total_Treatments",
        "Total_Spending",
        "Avg_Patient_Spending",
        "Spending_Rank",
        F.when(F.col("Total_Visits") == 1, ONE_TIME)
        .when((F.col("Total_Visits") >= VIP_VISITS) & spender, VIP)
        .otherwise(REGULAR)
        .alias("Patient_Segment"),
    )


def doctor_performance(core: Core, **ranking) -> DataFrame:
    doctors = _doctor_totals(core).select(
        "Doctor_ID",
        "Doctor_Name",
        "Specialization",
        "Total_Patients",
        "Total_Visits",
        "Total_Revenue",
        "Avg_Treatment_Cost",
    )
    return dense_rank_desc(
        doctors, "Total_Revenue", "Revenue_Rank", "Doctor_ID", max_rows=core.row_count("Doctors"), **ranking
    )


def treatment_performance(core: Core, **ranking) -> DataFrame:
    types = (
        billed_treatments(core.treatments, core.billing)
        .groupBy("Treatment_Type")
        .agg(
            F.count("*").alias("Total_Treatments"),
            money(F.sum("Amount")).alias("Total_Revenue"),
            average(F.sum("Weighted_Cost"), F.sum("Cost_Weight"), "decimal(10,2)").alias("Avg_Treatment_Cost"),
        )
    )
    return dense_rank_desc(types, "Total_Revenue", "Revenue_Rank", "Treatment_Type", **ranking)


def appointment_status(core: Core) -> DataFrame:
    statuses = core.appointments.groupBy("Status").agg(F.count("*").alias("Total_Appointments"))
    return with_total(statuses, "Overall_Appointments", F.sum("Total_Appointments")).withColumn(
        "Status_Percentage", percent(F.col("Total_Appointments"), F.col("Overall_Appointments"))
    )


def payment_methods(core: Core) -> DataFrame:
    methods = core.billing.groupBy("Payment_Method").agg(
        F.count("*").alias("Bill_Count"), money(F.sum("Amount")).alias("Total_Amount")
    )
    return (
        # The figure uses both columns, so that its plan is that of the rows and the exchange is shared.
        with_total(methods, "_all", F.struct(F.sum("Bill_Count").alias("bills"), F.sum("Total_Amount").alias("amount")))
        .withColumn("Pct_Of_Bills", percent(F.col("Bill_Count"), F.col("_all.bills"), "decimal(5,1)"))
        .drop("_all")
        .orderBy(F.desc("Total_Amount"))
    )


def age_gender(core: Core, as_of: date) -> DataFrame:
    """Patients by age group and gender. A patient without a birth date counts as the oldest group."""
    group = F.lit(OLDEST_GROUP)
    for limit, label in reversed(AGE_GROUPS):
        group = F.when(F.col("_age") <= limit, label).otherwise(group)
    return (
        core.patients.select("Gender", age_years(F.col("Date_Of_Birth"), as_of).alias("_age"))
        .groupBy(group.alias("Age_Group"), "Gender")
        .agg(F.count("*").alias("Patient_Count"))
        .orderBy("Age_Group", "Gender")
    )


def kpi_summary(core: Core) -> DataFrame:
    """One row of nine figures; one pass over each table."""

    def outcomes(status: str):
        return F.count_if(F.col("Status") == status)

    def billed(status: str):
        return money(F.sum(F.when(F.col("Payment_Status") == status, F.col("Amount"))))

    appointments = core.appointments.agg(
        F.struct(
            F.count("*").alias("Total_Appointments"),
            outcomes(COMPLETED).alias("Completed_Appointments"),
            outcomes(NO_SHOW).alias("No_Show_Appointments"),
            outcomes(CANCELLED).alias("Cancelled_Appointments"),
        )
    ).scalar()
    money_totals = core.billing.agg(
        money(F.sum("Amount")).alias("Total_Revenue_Billed"),
        billed(PAID).alias("Total_Revenue_Collected"),
        billed(PENDING).alias("Total_Revenue_Pending"),
    )
    return (
        money_totals.withColumn("_appointments", appointments)
        .withColumn("Total_Patients", core.patients.agg(F.count("*")).scalar())
        .withColumn("Total_Doctors", core.doctors.agg(F.count("*")).scalar())
        .select(
            "Total_Patients",
            "Total_Doctors",
            "_appointments.*",
            "Total_Revenue_Billed",
            "Total_Revenue_Collected",
            "Total_Revenue_Pending",
        )
    )
