"""The four analysis views. They keep entities without activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import average, full_name, money, percent, weekday_name
from wardline.plans.facts import billed_treatments, treatments_per_appointment
from wardline.schema import CANCELLED, COMPLETED, NO_SHOW, SCHEDULED
from wardline.sources.core import Core


def _or_zero(name: str, type_: str = "bigint"):
    return F.coalesce(F.col(name), F.lit(0)).cast(type_).alias(name)


def patient_analysis(core: Core) -> DataFrame:
    """Visits, treatment cost and billed money per patient; money by the patient on the bill."""
    costs = (
        core.treatments.where(F.col("Appointment_ID").isNotNull())
        .groupBy("Appointment_ID")
        .agg(F.sum("Cost").alias("Cost"))
    )
    visits = (
        core.appointments.join(costs, "Appointment_ID", "left")
        .groupBy("Patient_ID")
        .agg(
            F.count("*").alias("Total_Appointments"),
            F.sum("Cost").alias("Total_Treatment_Cost"),
            F.max("Appointment_Date").alias("Last_Visit_Date"),
        )
    )
    billed = core.billing.groupBy("Patient_ID").agg(F.sum("Amount").alias("Total_Paid_Amount"))
    return (
        core.patients.join(visits, "Patient_ID", "left")
        .join(billed, "Patient_ID", "left")
        .select(
            "Patient_ID",
            full_name().alias("Patient_Name"),
            "Gender",
            "Insurance_Provider",
            _or_zero("Total_Appointments"),
            _or_zero("Total_Treatment_Cost", "decimal(38,2)"),
            _or_zero("Total_Paid_Amount", "decimal(38,2)"),
            "Last_Visit_Date",
        )
    )


def doctor_performance(core: Core) -> DataFrame:
    """Visits, treatments and billed money per doctor."""
    per_appointment = treatments_per_appointment(core.treatments, core.billing, how="left")
    activity = (
        core.appointments.join(per_appointment, "Appointment_ID", "left")
        .groupBy("Doctor_ID")
        .agg(
            F.count("*").alias("Total_Visits"),
            F.sum("Treatments").alias("Total_Treatments"),
            F.sum("Amount").alias("Total_Revenue"),
        )
    )
    return core.doctors.join(activity, "Doctor_ID", "left").select(
        "Doctor_ID",
        full_name().alias("Doctor_Name"),
        "Specialization",
        _or_zero("Total_Visits"),
        _or_zero("Total_Treatments"),
        _or_zero("Total_Revenue", "decimal(38,2)"),
    )


def revenue_analysis(core: Core) -> DataFrame:
    """Treatments, money and payment outcomes per treatment type."""
    return (
        billed_treatments(core.treatments, core.billing)
        .groupBy("Treatment_Type")
        .agg(
            F.count("*").alias("Total_Treatments"),
            money(F.sum("Amount")).alias("Total_Revenue"),
            average(F.sum("Weighted_Cost"), F.sum("Cost_Weight")).alias("Avg_Treatment_Cost"),
            F.sum("Paid").alias("Paid_Count"),
            F.sum("Pending").alias("Pending_Count"),
            F.sum("Failed").alias("Failed_Count"),
            percent(F.sum("Paid"), F.sum("Bills")).alias("Payment_Success_Rate"),
        )
    )


def appointment_analysis(core: Core) -> DataFrame:
    """Appointments by outcome per day."""

    def with_status(status: str):
        return F.count_if(F.col("Status") == status)

    total = F.col("Total_Appointments")
    return (
        core.appointments.groupBy("Appointment_Date")
        .agg(
            F.count("Appointment_ID").alias("Total_Appointments"),
            with_status(COMPLETED).alias("Completed_Count"),
            with_status(CANCELLED).alias("Cancelled_Count"),
            with_status(NO_SHOW).alias("No_Show_Count"),
            with_status(SCHEDULED).alias("Scheduled_Count"),
        )
        .select(
            "Appointment_Date",
            weekday_name(F.col("Appointment_Date")).alias("Day_Name"),
            "Total_Appointments",
            "Completed_Count",
            "Cancelled_Count",
            "No_Show_Count",
            "Scheduled_Count",
            percent(F.col("Completed_Count"), total).alias("Completion_Rate"),
            percent(F.col("No_Show_Count"), total).alias("No_Show_Rate"),
            percent(F.col("Cancelled_Count"), total).alias("Cancellation_Rate"),
        )
    )


VIEWS = {
    "vw_Patient_Analysis": patient_analysis,
    "vw_Doctor_Performance": doctor_performance,
    "vw_Revenue_Analysis": revenue_analysis,
    "vw_Appointment_Analysis": appointment_analysis,
}


def register_views(core: Core) -> None:
    """Make the core tables and the views known to ``spark.sql``."""
    core.register_views()
    for name, view in VIEWS.items():
        view(core).createOrReplaceTempView(name)
