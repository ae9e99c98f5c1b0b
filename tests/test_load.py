from __future__ import annotations

from datetime import date, datetime

import pytest
from clinic import AS_OF, extract_rows, write_extracts
from pyspark.sql import functions as F

from wardline.plans import checks, load, quality
from wardline.schema import ENTITIES, PATIENTS
from wardline.sources import conform, open_core, read_csv_extract, read_parquet_extracts
from wardline.sources.core import MONTH, latest_run

MISSING_PATIENT = "Missing required field (ID/Name/Registration_Date)"
MISSING_APPOINTMENT = "Missing required field (ID/Patient/Doctor/Date)"


def pairs(df, key):
    return sorted((r[key] or "", r.Error_Reason) for r in df.collect())


def test_error_rows(loaded):
    errors = loaded.errors
    assert pairs(errors["Patients"], "Patient_ID") == [
        ("P3", "Duplicate Patient_ID"),
        ("P4", MISSING_PATIENT),
        ("P5", "Date_Of_Birth is in the future"),
    ]
    assert pairs(errors["Doctors"], "Doctor_ID") == []
    assert pairs(errors["Appointments"], "Appointment_ID") == [
        ("A5", "Appointment_Date is in the future"),
        ("A6", "References a Patient_ID not found in stg.Patients"),
        ("A7", "References a Doctor_ID not found in stg.Doctors"),
        ("A8", "Duplicate Appointment_ID"),
        ("A9", MISSING_APPOINTMENT),
        ("A9", "References a Doctor_ID not found in stg.Doctors"),
    ]
    assert pairs(errors["Treatments"], "Treatment_ID") == [
        ("T6", "References an Appointment_ID not found in stg.Appointments"),
        ("T7", "Duplicate Treatment_ID"),
        ("T8", "Missing required field (ID/Appointment_ID)"),
        ("T8", "References an Appointment_ID not found in stg.Appointments"),
    ]
    assert pairs(errors["Billing"], "Bill_ID") == [
        ("B6", "Negative Amount"),
        ("B7", "References a Patient_ID not found in stg.Patients"),
        ("B8", "References a Treatment_ID not found in stg.Treatments"),
    ]
    logged = errors["Billing"].select("Logged_At").distinct().collect()
    assert len(logged) == 1 and isinstance(logged[0][0], datetime)


def test_summary_counts_distinct_keys_and_shows_zero(loaded):
    counts = {r.Table_Name: r.Quarantined_Rows for r in quality.summary(loaded.errors).collect()}
    assert counts == {"Patients": 3, "Doctors": 0, "Appointments": 5, "Treatments": 3, "Billing": 3}


def test_core_rows(core):
    counts = {r.Table_Name: r.Row_Count for r in checks.row_counts(core.tables()).collect()}
    assert counts == {"Patients": 3, "Doctors": 3, "Appointments": 5, "Treatments": 5, "Billing": 6}
    assert {r[0] for r in core.patients.select("Patient_ID").collect()} == {"P1", "P2", "P6"}
    times = {r[0]: r[1] for r in core.appointments.select("Appointment_ID", "Appointment_Time").collect()}
    assert times["A1"] == "08:00:00" and times["A2"] == "15:15:00"
    for name, df in core.tables().items():
        assert df.columns == ENTITIES[name].columns


def test_clean_and_excluded_make_up_staging(loaded, spark, tmp_path):
    source = write_extracts(tmp_path)
    for name, entity in ENTITIES.items():
        staged = read_csv_extract(spark, entity, f"{source}/{entity.file}")
        bad = {r[0] for r in loaded.errors[name].select(entity.key).collect()}
        kept = loaded.core.tables()[name].count()
        dropped = staged.where(F.col(entity.key).isin(list(bad))).count()
        assert kept + dropped == staged.count()


def _published(spark, root):
    core = open_core(spark, root)
    return {name: sorted(map(tuple, df.collect()), key=str) for name, df in core.tables().items()}


@pytest.fixture
def failing_load(spark, tmp_path, loaded, root):
    """Load a changed delivery that must fail over the published clinic; return the error."""

    def run(change):
        before = _published(spark, root)
        rows = extract_rows()
        change(rows)
        with pytest.raises(load.LoadError) as caught:
            load.load_csv(spark, write_extracts(tmp_path, rows), root, AS_OF)
        assert _published(spark, root) == before
        assert latest_run(spark, root).run == loaded.run
        return caught.value

    return run


def test_child_of_a_quarantined_parent_stops_the_load(failing_load):
    def change(rows):
        rows["Appointments"].append(
            {
                "Appointment_ID": "A12",
                "Patient_ID": "P3",
                "Doctor_ID": "D1",
                "Appointment_Date": "2023-02-01",
                "Appointment_Time": "09:00:00",
                "Status": "Completed",
            }
        )

    error = failing_load(change)
    assert isinstance(error, load.ConstraintError)
    assert [(v.Table_Name, v.Column_Name, v.Check, v.Violations) for v in error.violations] == [
        ("Appointments", "Patient_ID", "not found in Patients", 1)
    ]


def test_null_key_is_logged_but_stops_the_load(failing_load):
    def change(rows):
        rows["Patients"].append(dict(rows["Patients"][0], Patient_ID=""))

    error = failing_load(change)
    assert [(v.Table_Name, v.Check) for v in error.violations] == [("Patients", "key is null")]


def test_null_key_is_invisible_in_the_summary(spark):
    errors = {
        name: spark.createDataFrame([], f"{e.key} string, Error_Reason string") for name, e in ENTITIES.items()
    }
    errors["Patients"] = spark.createDataFrame([(None, "x"), ("P1", "x")], "Patient_ID string, Error_Reason string")
    assert quality.summary(errors).where("Table_Name = 'Patients'").first().Quarantined_Rows == 1


@pytest.mark.parametrize("table", ["Doctors", "Billing"])
def test_duplicate_key_without_a_rule_stops_the_load(failing_load, table):
    error = failing_load(lambda rows: rows[table].append(rows[table][0]))
    assert [(v.Table_Name, v.Check, v.Violations) for v in error.violations] == [(table, "key not unique", 1)]


def test_empty_staging_stops_the_load(failing_load):
    error = failing_load(lambda rows: rows["Billing"].clear())
    assert isinstance(error, load.EmptyStagingError)
    assert (error.code, error.table) == (50005, "Billing")


def test_guard_names_the_first_empty_table(core):
    tables = core.tables()
    load.guard_not_empty(tables)
    for first, code in load.EMPTY_STAGING_CODES.items():
        names = list(ENTITIES)
        emptied = {n: df.limit(0) if names.index(n) >= names.index(first) else df for n, df in tables.items()}
        with pytest.raises(load.EmptyStagingError) as caught:
            load.guard_not_empty(emptied)
        assert (caught.value.code, caught.value.table) == (code, first)


def test_too_long_key_stops_the_load(failing_load):
    def change(rows):
        rows["Doctors"].append({"Doctor_ID": "D" * 21, "First_Name": "x"})

    error = failing_load(change)
    assert [(v.Table_Name, v.Column_Name, v.Check) for v in error.violations] == [
        ("Doctors", "Doctor_ID", "longer than 20")
    ]


def test_reloading_gives_the_same_core(spark, tmp_path):
    root = str(tmp_path / "root")
    (tmp_path / "in").mkdir()
    source = write_extracts(tmp_path / "in")
    first = load.load_csv(spark, source, root, AS_OF)
    before = _published(spark, root)
    second = load.load_csv(spark, source, root, AS_OF)
    assert first.run != second.run
    assert _published(spark, root) == before


def test_nothing_published_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        open_core(spark, str(tmp_path))


def test_large_date_tables_are_laid_out_by_month(spark, tmp_path, core):
    (tmp_path / "in").mkdir()
    root = str(tmp_path / "root")
    result = load.load_csv(spark, write_extracts(tmp_path / "in"), root, AS_OF, layout_rows=1)
    assert set(result.core.monthly) == {"Appointments", "Billing"}
    assert MONTH in result.core.by_date("Billing").columns
    for name, df in result.core.tables().items():
        flat = core.tables()[name]
        assert df.columns == flat.columns
        assert sorted(map(tuple, df.collect()), key=str) == sorted(map(tuple, flat.collect()), key=str)


def test_hot_keys_do_not_change_the_load(spark, tmp_path, core):
    (tmp_path / "in").mkdir()
    result = load.load_csv(spark, write_extracts(tmp_path / "in"), str(tmp_path / "root"), AS_OF, hot_rows=2, broadcast_rows=0)
    for name, df in result.core.tables().items():
        assert sorted(map(tuple, df.collect()), key=str) == sorted(map(tuple, core.tables()[name].collect()), key=str)


def _patients_csv(tmp_path, *lines):
    path = tmp_path / "patients.csv"
    header = ",".join(c.lower() for c in PATIENTS.columns)
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


GOOD = "P1,Ann,Lee,F,1980-02-29,555,1 Elm St,2022-01-01,Care,INS1,a@x"


def test_source_reads_by_position_with_quotes(spark, tmp_path):
    path = tmp_path / "patients.csv"
    path.write_text("these,names,are,not,looked,at,by,the,reader,at,all\n" + GOOD.replace("1 Elm St", '"1 ""Elm"", St"') + "\n")
    row = read_csv_extract(spark, PATIENTS, str(path)).first()
    assert row.Patient_ID == "P1" and row.Address == '1 "Elm", St' and row.Date_Of_Birth == date(1980, 2, 29)
    assert row._corrupt_record is None


@pytest.mark.parametrize(
    "line",
    [
        GOOD.replace("1980-02-29", "soon"),
        GOOD.replace("1980-02-29", "1981-02-29"),
        GOOD + ",extra",
        "P1,Ann",
        GOOD.replace("Ann", "A" * 51),
    ],
)
def test_source_marks_bad_lines(spark, tmp_path, line):
    rows = read_csv_extract(spark, PATIENTS, _patients_csv(tmp_path, line, GOOD.replace("P1", "P2"))).collect()
    assert {r.Patient_ID: r._corrupt_record is None for r in rows} == {"P1": False, "P2": True}


def test_rejects_are_logged_and_tolerated_up_to_a_limit(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = extract_rows()
    rows["Doctors"] += [{"Doctor_ID": f"X{i}", "Years_Experience": "many"} for i in range(3)]
    rows["Doctors"].append({"Doctor_ID": "D1", "Years_Experience": "many"})
    source = write_extracts(tmp_path / "in", rows)
    result = load.load_csv(spark, source, str(tmp_path / "root"), AS_OF, max_errors=4)
    assert pairs(result.errors["Doctors"], "Doctor_ID") == [
        (k, "Unparseable row") for k in ("D1", "X0", "X1", "X2")
    ]
    assert {r[0] for r in result.core.doctors.select("Doctor_ID").collect()} == {"D1", "D2", "D3"}
    with pytest.raises(load.TooManyRejectsError):
        load.load_csv(spark, source, str(tmp_path / "root"), AS_OF, max_errors=3)


def test_today_is_not_in_the_future(spark, tmp_path):
    rows = extract_rows()
    rows["Patients"][0]["Date_Of_Birth"] = AS_OF.isoformat()
    source = write_extracts(tmp_path, rows)
    staging = {
        name: read_csv_extract(spark, e, f"{source}/{e.file}").drop("_corrupt_record") for name, e in ENTITIES.items()
    }
    found = quality.rule_rows(PATIENTS, "Date_Of_Birth is in the future", staging, AS_OF)
    assert [r.Patient_ID for r in found.collect()] == ["P5"]


def test_parquet_extracts(spark, tmp_path, core):
    for name, df in core.tables().items():
        df.drop("Email", "Description").write.parquet(str(tmp_path / f"{name.lower()}.parquet"))
    feed = read_parquet_extracts(spark, str(tmp_path))
    for name, df in feed.items():
        assert df.columns == [*ENTITIES[name].columns, "_corrupt_record"]
        assert df.where("_corrupt_record is not null").isEmpty()
        assert dict(df.drop("_corrupt_record").dtypes) == dict(core.tables()[name].dtypes)
        assert df.count() == core.tables()[name].count()


def test_load_messages(failing_load, spark, tmp_path, caplog):
    caplog.set_level("INFO", "wardline")
    error = failing_load(lambda rows: rows["Doctors"].append(rows["Doctors"][0]))
    [failed] = [r for r in caplog.records if r.levelname == "ERROR"]
    assert "nothing was published" in failed.getMessage() and str(error) in failed.getMessage()
    assert "Doctors.Doctor_ID key not unique: 1" in str(error)
    (tmp_path / "in").mkdir()
    load.load_csv(spark, write_extracts(tmp_path / "in"), str(tmp_path / "root"), AS_OF)
    assert any(r.getMessage().endswith("published") and r.levelname == "INFO" for r in caplog.records)


def test_one_key_with_very_many_copies(spark, tmp_path, monkeypatch):
    """A third of the rows are copies of one key, another third have no key."""
    entity = ENTITIES["Doctors"]
    rows = spark.range(0, 3000).selectExpr(
        "case id % 3 when 0 then 'hot' when 1 then null else concat('D', id) end as Doctor_ID"
    )
    staged_path = str(tmp_path / "staged")
    conform(rows, entity).write.parquet(staged_path)
    staged = spark.read.schema(entity.ddl).parquet(staged_path)
    errors = rows.where("Doctor_ID = 'hot'").selectExpr("Doctor_ID", "'x' as Error_Reason")
    monkeypatch.setattr(load, "BROADCAST_ROWS", 10)
    for thresholds in ({"broadcast_rows": 10}, {"broadcast_rows": 0, "hot_rows": 100}):
        kept = load.exclude_quarantined(staged, errors, entity, **thresholds)
        counts = {r.Doctor_ID: r["count"] for r in kept.groupBy("Doctor_ID").count().collect()}
        assert counts.pop(None) == 1000 and len(counts) == 1000 and "hot" not in counts


def test_dropped_runs_leave_the_last_published(spark, tmp_path):
    (tmp_path / "in").mkdir()
    root = str(tmp_path / "root")
    source = write_extracts(tmp_path / "in")
    first, second = (load.load_csv(spark, source, root, AS_OF) for _ in range(2))
    (tmp_path / "root" / "run=failed").mkdir()
    load.drop_staging(spark, root, second.run)
    assert load.drop_runs(spark, root, keep=0) == [second.run]
    folders = {p.name for p in (tmp_path / "root").iterdir() if p.name.startswith("run=")}
    assert folders == {f"run={second.run}"} and first.run != second.run
    assert not (tmp_path / "root" / f"run={second.run}" / "staging").exists()
    assert open_core(spark, root).patients.count() == second.core.patients.count()


@pytest.mark.parametrize(
    "written,read",
    [("8:00", "08:00:00"), ("23:59:59", "23:59:59"), ("08:15:00.5", "08:15:00.5"), ("noon", None), ("25:00", None), ("8:5", None),
     ("99:99:99", None), ("12:60", None), (None, None)],
)
def test_times(spark, written, read):
    from wardline.schema import APPOINTMENTS, CORRUPT
    from wardline.sources import conform
    from wardline.sources.csv import mark_unreadable

    rows = conform(spark.createDataFrame([("A1", written)], "Appointment_ID string, Appointment_Time string"), APPOINTMENTS)
    row = mark_unreadable(rows, APPOINTMENTS).first()
    assert (row[CORRUPT] is None) == (read is not None or written is None)
    assert row[CORRUPT] is not None or row.Appointment_Time == read
