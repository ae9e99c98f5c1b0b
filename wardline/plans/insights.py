"""Figures behind the written insights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import average, money, percent
from wardline.operators import with_total
from wardline.schema import CANCELLED, NO_SHOW
from wardline.sources.core import Core


def payment_status_share(core: Core) -> DataFrame:
    statuses = core.billing.groupBy("Payment_Status").agg(money(F.sum("Amount")).alias("Total_Amount"))
    return (
        with_total(statuses, "_billed", F.sum("Total_Amount"))
        .withColumn("Pct_Of_Billed", percent(F.col("Total_Amount"), F.col("_billed"), "decimal(5,1)"))
        .drop("_billed")
    )


def inactive_patients(core: Core) -> DataFrame:
    """One row: patients with and without appointments, and visits per active patient."""
    visits = (
        core.appointments.where(F.col("Patient_ID").isNotNull())
        .groupBy("Patient_ID")
        .agg(F.count("*").alias("_visits"))
    )
    return (
        core.patients.join(visits, "Patient_ID", "left")
        .agg(
            F.count("_visits").alias("Active_Patients"),
            F.count_if(F.col("_visits").isNull()).alias("Inactive_Patients"),
            F.sum("_visits").alias("_visits"),
        )
        .select(
            "Active_Patients",
            "Inactive_Patients",
            average(F.col("_visits"), F.col("Active_Patients"), "decimal(10,2)").alias("Visits_Per_Active_Patient"),
        )
    )


def specialization_mix(core: Core) -> DataFrame:
    return core.doctors.groupBy("Specialization").agg(F.count("*").alias("Doctor_Count"))


def insurance_mix(core: Core) -> DataFrame:
    return core.patients.groupBy("Insurance_Provider").agg(F.count("*").alias("Patient_Count"))


def gender_mix(core: Core) -> DataFrame:
    return core.patients.groupBy("Gender").agg(F.count("*").alias("Patient_Count"))


def not_reached_rate(core: Core) -> DataFrame:
    """One row: how many appointments ended as No-show or Cancelled."""
    not_reached = F.count_if(F.col("Status").isin(NO_SHOW, CANCELLED))
    return core.appointments.agg(
        not_reached.alias("Not_Reached_Appointments"),
        percent(not_reached, F.count("*")).alias("Not_Reached_Rate"),
    )
