"""The clinic entities as seen through a trading data set (customers, orders, lines).

``clean_feed`` is a delivery that loads; ``dirty_feed`` breaks every rule. Both use all
rows of the given tables: a treatment per order and line number, a bill per line. Some
treatments have several bills, some bills are paid by someone else than the visitor, some patients
and doctors have no visit, some doctors no last name, some patients no birth date. Dates of the
dirty feed are judged on ``DIRTY_AS_OF``, within the range of the order dates.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.schema import CANCELLED, COMPLETED, ENTITIES, FAILED, NO_SHOW, PAID, PENDING, SCHEDULED
from wardline.session import ROWS_A_TASK
from wardline.sources.parquet import conform

AS_OF = date(2026, 12, 3)
DIRTY_AS_OF = date(2000, 1, 1)


def clean_feed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = _Tables(spark, sf_dir)
    return _typed(
        {
            "Patients": tables.patients(),
            "Doctors": tables.doctors(),
            "Appointments": tables.appointments(),
            "Treatments": tables.treatments(),
            "Billing": tables.billing(),
        }
    )


def dirty_feed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Parents whose keys are delivered with a prefix leave orphans behind; no row is left out."""
    tables = _Tables(spark, sf_dir)

    balance = F.col("c_acctbal")
    customers = tables.patients("c_acctbal").withColumn("Last_Name", _unless(balance.between(0, 500), "Last_Name"))
    customers = customers.withColumn("Patient_ID", _renamed(balance < -500, "Patient_ID"))
    again = customers.where(balance > 9000)
    patients = customers.unionByName(again).withColumn(
        "Patient_ID", _unless(balance.between(8800, 9000), "Patient_ID")
    )

    balance = F.col("s_acctbal")
    doctors = tables.doctors("s_acctbal").withColumn("Doctor_ID", _renamed(balance < 0, "Doctor_ID"))
    doctors = doctors.withColumn("Doctor_ID", _unless(balance > 9500, "Doctor_ID"))

    total = F.col("o_totalprice")
    orders = tables.appointments("o_totalprice").withColumn("Doctor_ID", _unless(total < 10000, "Doctor_ID"))
    orders = orders.withColumn("Appointment_ID", _renamed(total < 5000, "Appointment_ID"))
    appointments = orders.unionByName(orders.where(total > 480000))

    treatments = tables.line_treatments("l_quantity")
    treatments = treatments.withColumn("Treatment_ID", _unless(F.col("l_quantity") == 50, "Treatment_ID"))
    treatments = treatments.withColumn("Appointment_ID", _unless(F.col("l_quantity") == 1, "Appointment_ID"))

    refund = (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.085)
    billing = tables.billing("l_returnflag", "l_discount")
    billing = billing.withColumn("Amount", F.when(refund, -F.col("Amount")).otherwise(F.col("Amount")))
    return _typed(
        {
            "Patients": patients,
            "Doctors": doctors,
            "Appointments": appointments,
            "Treatments": treatments,
            "Billing": billing,
        }
    )


class _Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")

    def lines(self) -> DataFrame:
        return self._read("lineitem")

    def _dealt(self, lines: DataFrame, *keys: str) -> DataFrame:
        """Lines with the same ``keys`` in one part; more parts than the session asks for where the lines need them."""
        parts = self.lines().agg(F.count("*")).first()[0] // ROWS_A_TASK
        enough = parts <= int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        return lines.repartition(*keys) if enough else lines.repartition(parts, *keys)

    def patients(self, *more: str) -> DataFrame:
        key = F.col("c_custkey")
        born = F.date_add(F.lit(date(1940, 1, 1)), (key * 7919 % 25550).cast("int"))
        registered = F.date_add(F.lit(date(1990, 1, 1)), (key % 1825).cast("int"))
        return self._read("customer").select(
            _text(key).alias("Patient_ID"),
            F.substring("c_name", 1, 8).alias("First_Name"),
            F.expr("substring(c_name, 10)").alias("Last_Name"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("Gender"),
            F.when(key % 11 != 0, born).alias("Date_Of_Birth"),
            registered.alias("Registration_Date"),
            F.col("c_mktsegment").alias("Insurance_Provider"),
            F.concat(F.lit("INS"), _text(key)).alias("Insurance_Number"),
            *more,
        )

    def doctors(self, *more: str) -> DataFrame:
        nations = self._read("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return self._read("supplier").join(nations, "s_nationkey").select(
            _text(F.col("s_suppkey")).alias("Doctor_ID"),
            F.substring("s_name", 1, 8).alias("First_Name"),
            F.when(F.col("s_suppkey") % 7 != 0, F.expr("substring(s_name, 10)")).alias("Last_Name"),
            F.col("n_name").alias("Specialization"),
            *more,
        )

    def appointments(self, *more: str) -> DataFrame:
        doctors = self._read("supplier").agg(F.count("*")).scalar()
        doctor = F.col("o_orderkey") % doctors
        patient = F.col("o_custkey")
        status = (
            F.when(F.col("o_orderpriority") == "5-LOW", CANCELLED)
            .when(F.col("o_orderstatus") == "F", COMPLETED)
            .when(F.col("o_orderstatus") == "P", NO_SHOW)
            .when(F.col("o_orderstatus") == "O", SCHEDULED)
        )
        quarter_hour = F.lpad(_text(F.col("o_orderkey") % 4 * 15), 2, "0")
        time = F.concat(F.lpad(_text(F.col("o_orderkey") % 10 + 8), 2, "0"), F.lit(":"), quarter_hour, F.lit(":00"))
        return self._read("orders").select(
            _text(F.col("o_orderkey")).alias("Appointment_ID"),
            # No visits to patients and doctors with keys that end in zero.
            _text(patient + F.when(patient % 10 == 0, 1).otherwise(0)).alias("Patient_ID"),
            _text(doctor + F.when(doctor % 10 == 0, 1).otherwise(0)).alias("Doctor_ID"),
            F.col("o_orderdate").cast("date").alias("Appointment_Date"),
            time.alias("Appointment_Time"),
            status.alias("Status"),
            *more,
        )

    def treatments(self) -> DataFrame:
        """One per order and line number, with the least or largest of what its lines say."""
        # Numbers are sorted and shuffled in place of the texts made of them. Lines are sorted (for the least text) after
        # the shuffle only: few of them share a number, so that sorting a file's lines ahead of it would gain nothing.
        lines = self._dealt(self._lines_with_parts().withColumn("_line", _line_number()), "_line", "l_orderkey")
        lines = lines.groupBy("_line", "l_orderkey").agg(
            F.min("Treatment_Type").alias("Treatment_Type"),
            F.max("Cost").alias("Cost"),
            F.min("Treatment_Date").alias("Treatment_Date"),
        )
        return lines.withColumns({"Treatment_ID": _text(F.col("_line")), "Appointment_ID": _text(F.col("l_orderkey"))})

    def line_treatments(self, *more: str) -> DataFrame:
        """One per line: a line number that occurs twice in an order is a key that occurs twice."""
        lines = self._lines_with_parts(*more)
        return lines.withColumns({"Treatment_ID": _line_id(), "Appointment_ID": _text(F.col("l_orderkey"))})

    def _lines_with_parts(self, *more: str) -> DataFrame:
        parts = self._read("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
        return self.lines().join(parts, "l_partkey").select(
            "l_orderkey",
            "l_linenumber",
            F.col("p_type").alias("Treatment_Type"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("Cost"),
            F.col("l_shipdate").cast("date").alias("Treatment_Date"),
            *more,
        )

    def billing(self, *more: str) -> DataFrame:
        """One per line, numbered within its treatment by what the line says; lines alike are bills alike."""
        orders = self._read("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
        rate = F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
        flag = F.col("l_returnflag")
        number = F.row_number().over(
            Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
                "l_extendedprice", "l_discount", "l_shipdate", "l_returnflag", "l_quantity"
            )
        )
        # The first line of an order is paid by the visitor's neighbour.
        payer = F.col("o_custkey") + F.when(F.col("l_linenumber") == 1, 1 - F.col("o_custkey") % 2 * 2).otherwise(0)
        # One shuffle by order serves the numbering and the join.
        lines = self._dealt(self.lines(), "l_orderkey").withColumn("_number", number)
        return lines.join(orders, "l_orderkey").select(
            F.concat(_line_id(), F.lit("-"), _text(F.col("_number"))).alias("Bill_ID"),
            _text(payer).alias("Patient_ID"),
            _line_id().alias("Treatment_ID"),
            F.col("l_shipdate").cast("date").alias("Bill_Date"),
            (F.col("l_extendedprice").cast("decimal(12,2)") * rate).cast("decimal(12,2)").alias("Amount"),
            F.col("o_orderpriority").alias("Payment_Method"),
            F.when(flag == "A", PAID).when(flag == "N", PENDING).when(flag == "R", FAILED).alias("Payment_Status"),
            *more,
        )


def _text(key: Column) -> Column:
    return key.cast("string")


def _line_number() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _line_id() -> Column:
    return _text(_line_number())


def _renamed(condition: Column, column: str) -> Column:
    return F.when(condition, F.concat(F.lit("X"), column)).otherwise(F.col(column))


def _unless(condition: Column, column: str) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), None).otherwise(F.col(column))


def _typed(feed: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: conform(df, ENTITIES[name]) for name, df in feed.items()}
