"""The chain appointment - treatment - bill, aggregated step by step.

Keys are unique in core tables, so each step reduces its input to one row per key before
the next join: bills per treatment, treatments per appointment. The joins then meet at
most one row per key on either side, whatever the distribution of the foreign keys, the
aggregations combine before they shuffle, and appointments and treatments need no
distinct count. Averages that are weighted by bills carry a weighted sum and its weight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.schema import FAILED, PAID, PENDING, VISITS
from wardline.sources.core import Core
from wardline.sources.parquet import conform


def bills_per_treatment(billing: DataFrame) -> DataFrame:
    def with_status(status: str):
        return F.count_if(F.col("Payment_Status") == status)

    return (
        billing.where(F.col("Treatment_ID").isNotNull())
        .groupBy("Treatment_ID")
        .agg(
            F.count("*").alias("Bills"),
            F.sum("Amount").alias("Amount"),
            with_status(PAID).alias("Paid"),
            with_status(PENDING).alias("Pending"),
            with_status(FAILED).alias("Failed"),
        )
    )


def billed_treatments(treatments: DataFrame, billing: DataFrame, how: str = "inner") -> DataFrame:
    """One row per treatment with its bills; ``how="left"`` keeps treatments without any."""
    weight = F.col("Bills").cast("decimal(18,0)")
    return treatments.join(bills_per_treatment(billing), "Treatment_ID", how).select(
        "Treatment_ID",
        "Appointment_ID",
        "Treatment_Type",
        "Bills",
        "Amount",
        "Paid",
        "Pending",
        "Failed",
        (F.col("Cost") * weight).alias("Weighted_Cost"),
        F.when(F.col("Cost").isNotNull(), F.col("Bills")).alias("Cost_Weight"),
    )


def treatments_per_appointment(treatments: DataFrame, billing: DataFrame, how: str = "inner") -> DataFrame:
    return (
        billed_treatments(treatments, billing, how)
        .where(F.col("Appointment_ID").isNotNull())
        .groupBy("Appointment_ID")
        .agg(
            F.count("*").alias("Treatments"),
            F.sum("Amount").alias("Amount"),
            F.sum("Weighted_Cost").alias("Weighted_Cost"),
            F.sum("Cost_Weight").alias("Cost_Weight"),
        )
    )


def visits(core: Core) -> DataFrame:
    """The fact chain of a core: read if its load has published it, else put together."""
    if core.visits is not None:
        return core.visits
    return conform(fact_chain(core.appointments, core.treatments, core.billing), VISITS)


def fact_chain(appointments: DataFrame, treatments: DataFrame, billing: DataFrame) -> DataFrame:
    """One row per appointment that has at least one treatment with at least one bill."""
    visits = appointments.select("Appointment_ID", "Patient_ID", "Doctor_ID", "Appointment_Date")
    return visits.join(treatments_per_appointment(treatments, billing), "Appointment_ID")
