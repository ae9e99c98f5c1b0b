"""Entry points: the flagship query, all registered queries, and their SQL counterparts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import oracle
from wardline import testbed
from wardline.plans import checks, facts, insights, load, procedures, quality, reports, views
from wardline.plans.layout import write_by_month
from wardline.schema import APPOINTMENTS, BILLING, CORRUPT, ENTITIES, PATIENTS, Entity
from wardline.session import bounded_tasks, materialize, scratch_root
from wardline.sources import Core, open_core, read_csv_extract
from wardline.sources.core import MONTH, latest_run, read_monthly

try:
    from wardline.llm import queries as llm
except ModuleNotFoundError as error:
    # Only without that part of the library; anything else that it lacks is an error.
    if error.name not in ("wardline.llm", "wardline.llm.queries", "corpus_pipeline"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

PERIOD = date(1997, 1, 1), date(1998, 6, 30)


def entry(spark: SparkSession) -> DataFrame:
    """Doctors by billed money, from the smallest test tables."""
    return reports.top_doctors(_core(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    own = _source_queries() | _quality_queries() | _load_queries() | _reporting_queries()
    return own | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    return oracle.all_queries() | (llm.oracle_sql() if llm else {})


# --- inputs that several queries share, prepared once per session and data folder ---


# A patient who makes every third visit, in the query that joins by hot keys.
HOT_PATIENT = "12"


@dataclass(frozen=True)
class _Dirty:
    staging: dict[str, DataFrame]
    errors: dict[str, DataFrame]
    clean: dict[str, DataFrame]


_prepared: dict[tuple, object] = {}


def _once(kind: str, spark: SparkSession, sf_dir: str, prepare):
    key = (kind, spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _prepared:
        _prepared[key] = prepare()
    return _prepared[key]


def _root(spark: SparkSession, sf_dir: str) -> str:
    return _once("root", spark, sf_dir, lambda: f"{scratch_root(spark)}/clinic-{uuid.uuid4().hex}")


def _core(spark: SparkSession, sf_dir: str) -> Core:
    """The clean delivery, loaded and published."""

    def prepare() -> Core:
        root = _root(spark, sf_dir)
        _load_clean(spark, sf_dir, root)
        return open_core(spark, root)

    return _once("core", spark, sf_dir, prepare)


def _load_clean(spark: SparkSession, sf_dir: str, root: str, **options) -> None:
    """Load and publish the clean delivery; nobody reads what it has staged."""
    done = load.load(spark, testbed.clean_feed(spark, sf_dir), root, testbed.AS_OF, **options)
    load.drop_staging(spark, root, done.run)


def _staged_dirty(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def prepare():
        path = f"{scratch_root(spark)}/dirty-{uuid.uuid4().hex}"
        return load.stage(spark, testbed.dirty_feed(spark, sf_dir), path)[0]

    return _once("staged", spark, sf_dir, prepare)


def _dirty(spark: SparkSession, sf_dir: str) -> _Dirty:
    """The dirty delivery: staged, with its error logs, and what is left without quarantined keys."""

    def prepare() -> _Dirty:
        staging = _staged_dirty(spark, sf_dir)
        path = f"{scratch_root(spark)}/dirty-errors-{uuid.uuid4().hex}"
        errors = load.write_errors(spark, staging, {}, path, testbed.DIRTY_AS_OF)
        clean = {}
        for name, entity in ENTITIES.items():
            rows = quality.rows_of(staging, name)
            with bounded_tasks(spark, rows):
                kept = load.exclude_quarantined(staging[name], errors[name], entity, rows)
                clean[name] = materialize(kept, f"kept-{name}")
        return _Dirty(staging, errors, clean)

    return _once("dirty", spark, sf_dir, prepare)


# --- sources ---


def _source_queries() -> dict[str, Query]:
    out: dict[str, Query] = {f"source_{e.file.removesuffix('.csv')}": _csv_round_trip(e) for e in ENTITIES.values()}
    out["source_multiline"] = _line_breaks
    out["source_bad_rows"] = _bad_rows
    out["source_bad_times"] = _bad_times
    return out


def _write_csv(df: DataFrame) -> str:
    path = f"{scratch_root(df.sparkSession)}/csv-{uuid.uuid4().hex}"
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def _csv_round_trip(entity: Entity) -> Query:
    """The delivery as CSV, read back through the source. Hours are written without padding."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = testbed.clean_feed(spark, sf_dir)[entity.name]
        if entity is APPOINTMENTS:
            rows = rows.withColumn("Appointment_Time", F.regexp_replace("Appointment_Time", "^0", ""))
        # Unreadable rows would show as rows without a counterpart.
        return read_csv_extract(spark, entity, _write_csv(rows)).drop(CORRUPT)

    return query


def _line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients whose addresses have quotes and line breaks, in one file that many tasks read."""
    rows = testbed.clean_feed(spark, sf_dir)["Patients"]
    number = F.col("Patient_ID").cast("bigint")
    lines = F.concat(F.lit('"House", '), "Patient_ID", F.lit("\n\n"), "Last_Name", F.lit(',\r\n"'))
    address = F.when(number % 3 == 0, lines).when(number % 3 == 1, F.concat(F.lit('say ""'), "Patient_ID"))
    path = _write_csv(rows.withColumn("Address", address).coalesce(1))
    split = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(split)
    spark.conf.set(split, "4k")
    try:
        return materialize(read_csv_extract(spark, PATIENTS, path, multi_line=True), "patients").drop(CORRUPT)
    finally:
        spark.conf.set(split, before)


def _bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients with a negative balance are written with a birth date that is no date."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    rows = testbed.clean_feed(spark, sf_dir)["Patients"]
    balance = customers.select(F.col("c_custkey").cast("string").alias("Patient_ID"), "c_acctbal")
    born = F.when(F.col("c_acctbal") < 0, "unknown").otherwise(F.col("Date_Of_Birth").cast("string"))
    broken = rows.join(balance, "Patient_ID").withColumn("Date_Of_Birth", born).select(*PATIENTS.columns)
    return quality.reject_rows(materialize(read_csv_extract(spark, PATIENTS, _write_csv(broken)), "raw"), PATIENTS)


def _bad_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appointments whose time is written in seven ways, three of which are none."""
    rows = testbed.clean_feed(spark, sf_dir)["Appointments"]
    written = F.array(*map(F.lit, [None, "noon", "25:00", "8:5", "8:00", "23:59:59", "08:15:00.5"]))
    rows = rows.withColumn("Appointment_Time", written[(F.col("Appointment_ID").cast("bigint") % 7).cast("int")])
    return quality.reject_rows(materialize(read_csv_extract(spark, APPOINTMENTS, _write_csv(rows)), "raw"), APPOINTMENTS)


# --- quality ---

# Query name and rule text.
RULE_QUERIES = {
    "dq_patient_duplicate": ("Patients", "Duplicate Patient_ID"),
    "dq_patient_missing": ("Patients", "Missing required field (ID/Name/Registration_Date)"),
    "dq_patient_future_dob": ("Patients", "Date_Of_Birth is in the future"),
    "dq_doctor_missing": ("Doctors", "Missing Doctor_ID"),
    "dq_appointment_duplicate": ("Appointments", "Duplicate Appointment_ID"),
    "dq_appointment_missing": ("Appointments", "Missing required field (ID/Patient/Doctor/Date)"),
    "dq_appointment_future": ("Appointments", "Appointment_Date is in the future"),
    "dq_appointment_orphan_patient": ("Appointments", "References a Patient_ID not found in stg.Patients"),
    "dq_appointment_orphan_doctor": ("Appointments", "References a Doctor_ID not found in stg.Doctors"),
    "dq_treatment_duplicate": ("Treatments", "Duplicate Treatment_ID"),
    "dq_treatment_missing": ("Treatments", "Missing required field (ID/Appointment_ID)"),
    "dq_treatment_orphan": ("Treatments", "References an Appointment_ID not found in stg.Appointments"),
    "dq_bill_negative": ("Billing", "Negative Amount"),
    "dq_bill_orphan_patient": ("Billing", "References a Patient_ID not found in stg.Patients"),
    "dq_bill_orphan_treatment": ("Billing", "References a Treatment_ID not found in stg.Treatments"),
}


def _quality_queries() -> dict[str, Query]:
    def rule(table: str, reason: str) -> Query:
        return lambda spark, sf_dir: quality.rule_rows(
            ENTITIES[table], reason, _staged_dirty(spark, sf_dir), testbed.DIRTY_AS_OF
        )

    def error_log(table: str) -> Query:
        return lambda spark, sf_dir: _dirty(spark, sf_dir).errors[table].drop("Logged_At")

    def hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The orphan rule by the plan for large tables; a third of all visits are of one known patient."""
        rules = tuple(r for r in quality.RULES["Appointments"] if getattr(r, "parent", None) == "Patients")
        staging = dict(_staged_dirty(spark, sf_dir))
        number = F.regexp_extract("Appointment_ID", "[0-9]+", 0).cast("bigint")
        hot = F.when(number % 3 == 0, HOT_PATIENT).otherwise(F.col("Patient_ID"))
        staging["Appointments"] = staging["Appointments"].withColumn("Patient_ID", hot)
        return quality.error_rows(APPOINTMENTS, staging, testbed.DIRTY_AS_OF, rules, hot_rows=5, broadcast_rows=5)

    def collated(spark: SparkSession, sf_dir: str) -> DataFrame:
        """All error rows of the dirty delivery, whose keys come in upper and lower case, under a collation without cases."""
        errors = _collated(spark, sf_dir)
        rows = [
            errors[n].select(
                F.lit(n).alias("Table_Name"), F.lower(F.collate(e.key, "UTF8_BINARY")).alias("Row_Key"), "Error_Reason"
            )
            for n, e in ENTITIES.items()
        ]
        return reduce(DataFrame.unionByName, rows)

    out = {name: rule(table, reason) for name, (table, reason) in RULE_QUERIES.items()}
    out["dq_collated"] = collated
    out |= {f"errors_{name.lower()}": error_log(name) for name in ENTITIES}
    out["dq_summary"] = lambda spark, sf_dir: quality.summary(_dirty(spark, sf_dir).errors)
    out["anti_join_hot_keys"] = hot_keys
    return out


# --- load ---


def _load_queries() -> dict[str, Query]:
    def core_table(name: str) -> Query:
        return lambda spark, sf_dir: _core(spark, sf_dir).tables()[name]

    def remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
        dirty = _dirty(spark, sf_dir)
        keys = []
        for name, entity in ENTITIES.items():
            kept = load.exclude_quarantined(dirty.staging[name], dirty.errors[name], entity)
            keys.append(kept.select(F.lit(name).alias("Table_Name"), F.col(entity.key).alias("Row_Key")))
        return reduce(DataFrame.unionByName, keys)

    def key_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _checked(_dirty(spark, sf_dir).clean).where(F.col("Check").startswith("key "))

    def reference_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _checked(_dirty(spark, sf_dir).clean).where(F.col("Check").startswith("not found "))

    def length_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
        """On a delivery that writes genders out for every fifth patient."""
        tables = _core(spark, sf_dir).tables()
        long = F.when(F.col("Patient_ID").cast("int") % 5 == 0, "not stated yet").otherwise(F.col("Gender"))
        tables["Patients"] = tables["Patients"].withColumn("Gender", long)
        return _checked(tables).where(F.col("Check").startswith("longer "))

    def guard(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A delivery without treatments."""
        feed = testbed.clean_feed(spark, sf_dir)
        return load.staging_status(feed | {"Treatments": feed["Treatments"].where(F.lit(False))})

    def by_month(name: str) -> Query:
        return lambda spark, sf_dir: _core_by_month(spark, sf_dir).tables()[name]

    def publish(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Row counts after a load of the dirty delivery has failed: those of the clean one."""
        _core(spark, sf_dir)
        root = _root(spark, sf_dir)
        try:
            load.load(spark, testbed.dirty_feed(spark, sf_dir), root, testbed.DIRTY_AS_OF)
        except load.ConstraintError:
            load.drop_runs(spark, root)
            return checks.row_counts(open_core(spark, root).tables())
        raise AssertionError("the dirty delivery must not be published")

    def cascade_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The keys that a load of the dirty delivery publishes when it may quarantine."""
        tables = _quarantining(spark, sf_dir).core.tables()
        keys = [tables[n].select(F.lit(n).alias("Table_Name"), F.col(e.key).alias("Row_Key")) for n, e in ENTITIES.items()]
        return reduce(DataFrame.unionByName, keys)

    def cascade_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
        errors = _quarantining(spark, sf_dir).errors
        rows = [
            errors[n].select(F.lit(n).alias("Table_Name"), F.col(e.key).alias("Row_Key"), "Error_Reason")
            for n, e in ENTITIES.items()
        ]
        return reduce(DataFrame.unionByName, rows)

    def history(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The log after three loads: the clean delivery, the dirty one, which stops, and the dirty one with quarantine."""
        log = load.load_log(spark, _loads(spark, sf_dir))
        number = F.dense_rank().over(Window.orderBy("started_at"))
        return log.select(
            number.cast("bigint").alias("Load_Number"), "Status", "Table_Name", "Read_Rows", "Rejected_Rows", "Error_Rows",
            "Quarantined_Rows", "Published_Rows",
        )

    def published_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _core_by_month(spark, sf_dir).visits

    def doctor_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Visits to one doctor, from the layout in which files can be skipped by patient and by doctor."""
        visits = _core_by_month(spark, sf_dir).appointments.where(F.col("Doctor_ID") == "5")
        return visits.select("Appointment_ID", "Patient_ID", "Doctor_ID", "Appointment_Date")

    def patient_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
        bills = _core_by_month(spark, sf_dir).billing.where(F.col("Patient_ID") == "12")
        return bills.select("Bill_ID", "Patient_ID", "Treatment_ID", "Amount")

    out: dict[str, Query] = {f"core_{name.lower()}": core_table(name) for name in ENTITIES}
    return out | {
        "load_exclude_quarantined": remaining,
        "load_guard_empty": guard,
        "core_appointments_by_month": by_month("Appointments"),
        "core_billing_by_month": by_month("Billing"),
        "layout_treatment_lookup": _treatment_lookup,
        "check_primary_key": key_checks,
        "check_foreign_key": reference_checks,
        "check_length": length_checks,
        "load_row_counts": lambda spark, sf_dir: checks.row_counts(_core(spark, sf_dir).tables()),
        "load_publish": publish,
        "load_cascade": cascade_keys,
        "load_cascade_errors": cascade_errors,
        "load_log": history,
        "visits_published": published_visits,
        "layout_doctor_lookup": doctor_lookup,
        "layout_patient_bills": patient_bills,
        "layout_billing_by_month": lambda spark, sf_dir: _by_month(spark, sf_dir, BILLING)
        .groupBy(F.col(MONTH).alias("Bill_Month"))
        .agg(F.count("*").alias("Bill_Count"), F.sum("Amount").cast("decimal(38,2)").alias("Total_Amount")),
        "layout_appointments_by_month": lambda spark, sf_dir: _by_month(spark, sf_dir, APPOINTMENTS)
        .groupBy(F.col(MONTH).alias("Visit_Month"), "Status")
        .agg(F.count("*").alias("Appointment_Count")),
        "layout_revenue_report": _revenue_by_month_folders,
    }


def _checked(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [checks.entity_checks(tables, e) for e in ENTITIES.values()])


def _by_month(spark: SparkSession, sf_dir: str, entity: Entity) -> DataFrame:
    """A core table written in the layout for large tables."""

    def prepare() -> DataFrame:
        path = f"{scratch_root(spark)}/by-month-{uuid.uuid4().hex}"
        write_by_month(_core(spark, sf_dir).tables()[entity.name], entity, path, files=8)
        return read_monthly(spark, entity, path)

    return _once(f"{entity.name} by month", spark, sf_dir, prepare)


def _revenue_by_month_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = Core.of(_core(spark, sf_dir).tables(), {"Billing": _by_month(spark, sf_dir, BILLING)})
    return procedures.revenue_report(monthly, *PERIOD)


def _core_by_month(spark: SparkSession, sf_dir: str) -> Core:
    """The clean delivery, loaded in the layout for large tables."""

    def prepare() -> Core:
        root = f"{scratch_root(spark)}/clinic-by-month-{uuid.uuid4().hex}"
        _load_clean(spark, sf_dir, root, layout_rows=0)
        return open_core(spark, root)

    return _once("core by month", spark, sf_dir, prepare)


def _collated(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Error logs of the dirty delivery with a letter ahead of each key: capital for keys, small for references."""

    def prepare() -> dict[str, DataFrame]:
        feed = {}
        for name, df in testbed.dirty_feed(spark, sf_dir).items():
            entity = ENTITIES[name]
            spelled = {c: F.concat(F.lit("k"), c) for c, _ in entity.foreign_keys}
            feed[name] = df.withColumns(spelled | {entity.key: F.concat(F.lit("K"), F.lower(entity.key))})
        path = f"{scratch_root(spark)}/collated-{uuid.uuid4().hex}"
        staging, _ = load.stage(spark, feed, f"{path}/staging", collation="UTF8_LCASE")
        return load.write_errors(spark, staging, {}, f"{path}/errors", testbed.DIRTY_AS_OF, collation="UTF8_LCASE")

    return _once("collated", spark, sf_dir, prepare)


def _loads(spark: SparkSession, sf_dir: str) -> str:
    """A folder under which three loads have run, the last of them with quarantine."""

    def prepare() -> str:
        root = f"{scratch_root(spark)}/clinic-loads-{uuid.uuid4().hex}"
        _load_clean(spark, sf_dir, root)
        dirty = testbed.dirty_feed(spark, sf_dir)
        try:
            load.load(spark, dirty, root, testbed.DIRTY_AS_OF)
        except load.ConstraintError:
            load.drop_runs(spark, root)
            load.load(spark, dirty, root, testbed.DIRTY_AS_OF, on_violation=load.QUARANTINE)
            return root
        raise AssertionError("the dirty delivery must not be published as it is")

    return _once("loads", spark, sf_dir, prepare)


def _quarantining(spark: SparkSession, sf_dir: str) -> load.LoadResult:
    root = _loads(spark, sf_dir)
    run = latest_run(spark, root).run
    return load.LoadResult(run, open_core(spark, root), load.read_errors(spark, root, run))


def _treatment_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Treatments of one appointment, from the layout in which their files can be skipped."""
    treatments = _core_by_month(spark, sf_dir).treatments
    last = treatments.agg(F.max("Appointment_ID")).first()[0]
    return treatments.where(F.col("Appointment_ID") == last).select("Treatment_ID", "Appointment_ID", "Cost")


# --- views, reports, summaries, insights ---


def _reporting_queries() -> dict[str, Query]:
    def on_core(plan, *args, **options) -> Query:
        return lambda spark, sf_dir: plan(_core(spark, sf_dir), *args, **options)

    def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
        core = _core(spark, sf_dir)
        rows = facts.fact_chain(core.appointments, core.treatments, core.billing)
        wide = {c: F.col(c).cast("decimal(38,2)") for c in ("Amount", "Weighted_Cost")}
        return rows.withColumns(wide)

    def from_sql(call: str) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            procedures.register_functions(_core(spark, sf_dir))
            return spark.sql(f"select * from {call}")

        return query

    period = ", ".join(f"date '{day}'" for day in PERIOD)
    return {
        "sql_patient_analysis": from_sql("patient_analysis('12')"),
        "sql_doctor_performance": from_sql("doctor_performance('5')"),
        "sql_revenue_report": from_sql(f"revenue_report({period})"),
        "fact_chain": chain,
        "view_patient_analysis": on_core(views.patient_analysis),
        "view_doctor_performance": on_core(views.doctor_performance),
        "view_revenue_analysis": on_core(views.revenue_analysis),
        "view_appointment_analysis": on_core(views.appointment_analysis),
        "report_top_doctors": on_core(reports.top_doctors),
        "report_top_patients": on_core(reports.top_patients),
        "report_monthly_revenue": on_core(reports.monthly_revenue),
        "report_patient_retention": on_core(reports.patient_retention),
        "report_patient_segmentation": on_core(reports.patient_segmentation),
        "report_doctor_performance": on_core(reports.doctor_performance),
        "report_treatment_performance": on_core(reports.treatment_performance),
        "report_appointment_status": on_core(reports.appointment_status),
        "report_payment_methods": on_core(reports.payment_methods),
        "report_age_gender": on_core(reports.age_gender, testbed.AS_OF),
        "report_kpi_summary": on_core(reports.kpi_summary),
        # The paths for large tables, forced on all rows of the small ones. Tests rank over more ranges.
        "global_dense_rank": on_core(reports.top_patients, one_task_rows=0, buckets=16),
        "retention_in_pieces": on_core(reports.patient_retention, chunk=1, one_task_copies=0),
        "proc_patient_analysis": on_core(procedures.patient_analysis, "12"),
        "proc_doctor_performance": on_core(procedures.doctor_performance, "5"),
        "proc_revenue_report": on_core(procedures.revenue_report, *PERIOD),
        "insight_payment_status_share": on_core(insights.payment_status_share),
        "insight_inactive_patients": on_core(insights.inactive_patients),
        "insight_specialization_mix": on_core(insights.specialization_mix),
        "insight_insurance_mix": on_core(insights.insurance_mix),
        "insight_gender_mix": on_core(insights.gender_mix),
        "insight_not_reached_rate": on_core(insights.not_reached_rate),
    }
