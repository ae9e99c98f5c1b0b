"""Loads that quarantine what the core cannot take, their log, and loads side by side."""

from __future__ import annotations

import json

import pytest
from clinic import AS_OF, extract_rows, write_extracts
from pyspark.sql import functions as F

from wardline.plans import cascade, checks, load, quality
from wardline.schema import ENTITIES
from wardline.session import materialize, write_new
from wardline.sources import open_core
from wardline.sources.core import commit_path, latest_run, published_runs


def _appointment(key, **other):
    row = {"Appointment_ID": key, "Patient_ID": "P1", "Doctor_ID": "D1", "Appointment_Date": "2023-02-01", "Status": "Completed"}
    return row | other


def _breaking_rows() -> dict[str, list[dict[str, str]]]:
    rows = extract_rows()
    rows["Patients"].append(dict(rows["Patients"][0], Patient_ID=""))
    rows["Doctors"] += [rows["Doctors"][1], {"Doctor_ID": "D" * 21, "First_Name": "x"}]
    # D2 occurs twice now; P3 is a duplicate and P4 has no name.
    rows["Appointments"] += [_appointment("A20", Patient_ID="P3"), _appointment("A21", Doctor_ID="D2")]
    rows["Appointments"] += [_appointment("A22", Doctor_ID="D" * 21), _appointment("A23")]
    treatment = {"Treatment_Type": "ECG", "Cost": "1.00", "Treatment_Date": "2023-02-01"}
    rows["Treatments"] += [treatment | {"Treatment_ID": f"T{n}", "Appointment_ID": f"A{n}"} for n in (20, 21, 22, 23)]
    bill = {"Bill_Date": "2023-02-02", "Amount": "1.00", "Payment_Method": "Cash", "Payment_Status": "Paid"}
    rows["Billing"] += [bill | {"Bill_ID": f"B{n}", "Patient_ID": "P1", "Treatment_ID": f"T{n}"} for n in (20, 21, 22, 23)]
    rows["Billing"] += [bill | {"Bill_ID": "B30", "Patient_ID": "P4", "Treatment_ID": "T23"}]
    rows["Billing"] += [bill | {"Bill_ID": "", "Patient_ID": "P1", "Treatment_ID": "T23"}]
    rows["Billing"] += [bill | {"Bill_ID": "B31", "Patient_ID": "P1", "Treatment_ID": "T23"}] * 2
    return rows


@pytest.fixture(scope="module", params=[{}, {"hot_rows": 2, "broadcast_rows": 0}], ids=["few keys", "many keys"])
def quarantined(request, spark, tmp_path_factory):
    source = write_extracts(tmp_path_factory.mktemp("in"), _breaking_rows())
    root = str(tmp_path_factory.mktemp("root"))
    return load.load_csv(spark, source, root, AS_OF, on_violation=load.QUARANTINE, **request.param)


def _logged(result, table, *reasons):
    key = ENTITIES[table].key
    rows = result.errors[table].where(F.col("Error_Reason").isin(*reasons)).collect()
    return sorted((r[key] or "", r.Error_Reason) for r in rows)


def test_children_follow_their_parents(quarantined):
    parent = cascade.PARENT
    assert _logged(quarantined, "Appointments", parent) == [(f"A{n}", parent) for n in (20, 21, 22)]
    assert _logged(quarantined, "Treatments", parent) == [(f"T{n}", parent) for n in (20, 21, 22)]
    assert _logged(quarantined, "Billing", parent) == [(f"B{n}", parent) for n in (20, 21, 22, 30)]


def test_what_breaks_a_constraint_is_logged(quarantined):
    own = (cascade.REPEATED, cascade.TOO_LONG, cascade.NO_KEY)
    assert _logged(quarantined, "Doctors", *own) == [("D2", cascade.REPEATED), ("D" * 21, cascade.TOO_LONG)]
    assert _logged(quarantined, "Billing", *own) == [("", cascade.NO_KEY), ("B31", cascade.REPEATED)]
    # A rule has logged the patient without a key.
    assert _logged(quarantined, "Patients", *own) == []


def test_the_rest_is_published(quarantined):
    tables = quarantined.core.tables()
    keys = {n: {r[0] for r in df.select(ENTITIES[n].key).collect()} for n, df in tables.items()}
    assert keys["Doctors"] == {"D1", "D3"} and keys["Patients"] == {"P1", "P2", "P6"}
    assert {"A23"} == keys["Appointments"] & {"A20", "A21", "A22", "A23"}
    assert {"T23"} == keys["Treatments"] & {"T20", "T21", "T22", "T23"}
    assert {"B23"} == keys["Billing"] - {f"B{n}" for n in range(1, 10)}
    for entity in ENTITIES.values():
        assert checks.entity_checks(tables, entity).where("Violations > 0").isEmpty()
    assert quarantined.core.rows == {n: df.count() for n, df in tables.items()}


def test_rules_log_what_they_log_without_quarantine(quarantined, spark, tmp_path):
    source = write_extracts(tmp_path, _breaking_rows())
    with pytest.raises(load.ConstraintError):
        load.load_csv(spark, source, str(tmp_path / "root"), AS_OF)
    [run] = [p.name.removeprefix("run=") for p in (tmp_path / "root").iterdir() if p.name.startswith("run=")]
    stopped = load.read_errors(spark, str(tmp_path / "root"), run)
    added = (cascade.PARENT, cascade.REPEATED, cascade.TOO_LONG, cascade.NO_KEY)
    for name, errors in quarantined.errors.items():
        own = errors.where(~F.col("Error_Reason").isin(*added)).drop("Logged_At")
        assert sorted(map(str, own.collect())) == sorted(map(str, stopped[name].drop("Logged_At").collect()))


def test_levels_put_parents_first():
    assert [[e.name for e in level] for level in cascade.levels()] == [
        ["Patients", "Doctors"], ["Appointments"], ["Treatments"], ["Billing"],
    ]


def test_unknown_mode(spark, tmp_path):
    with pytest.raises(ValueError, match="on_violation"):
        load.load(spark, {}, str(tmp_path), AS_OF, on_violation="ignore")


# --- the log of loads ---


def test_every_load_is_logged(spark, tmp_path):
    root = str(tmp_path / "root")
    for name in ("good", "bad"):
        (tmp_path / name).mkdir()
    rows = extract_rows()
    rows["Doctors"].append({"Doctor_ID": "X1", "Years_Experience": "many"})
    load.load_csv(spark, write_extracts(tmp_path / "good", rows), root, AS_OF)
    rows["Doctors"].append(rows["Doctors"][0])
    with pytest.raises(load.ConstraintError):
        load.load_csv(spark, write_extracts(tmp_path / "bad", rows), root, AS_OF)
    rows["Doctors"] += [{"Doctor_ID": "X2", "Years_Experience": "many"}]
    with pytest.raises(load.TooManyRejectsError):
        load.load_csv(spark, write_extracts(tmp_path / "bad", rows), root, AS_OF, max_errors=1)

    log = load.load_log(spark, root).orderBy("started_at").collect()
    assert len(log) == 15 and len({r.run for r in log}) == 3
    assert all(r.started_at < r.ended_at for r in log)
    figures = ("Read_Rows", "Rejected_Rows", "Error_Rows", "Quarantined_Rows", "Published_Rows")
    doctors = [(r.Status, *(r[f] for f in figures)) for r in log if r.Table_Name == "Doctors"]
    assert doctors == [("published", 4, 1, 1, 0, 3), ("failed", 5, 1, 1, 0, 0), ("failed", 6, 2, None, None, 0)]
    patients = [(r.Status, *(r[f] for f in figures)) for r in log if r.Table_Name == "Patients"]
    assert patients[0] == ("published", 7, 0, 3, 4, 3)
    messages = {r.Message for r in log}
    assert None in messages and any("key not unique" in m for m in messages if m)


# --- loads side by side ---


def _loading_with(spark, root, source, monkeypatch, between):
    """A load in the middle of which ``between`` happens."""
    check = load._check

    def interrupted(written):
        monkeypatch.setattr(load, "_check", check)
        between()
        check(written)

    monkeypatch.setattr(load, "_check", interrupted)
    return load.load_csv(spark, source, root, AS_OF)


def test_of_two_loads_the_first_to_end_is_published(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    source, root = write_extracts(tmp_path / "in"), str(tmp_path / "root")
    first = load.load_csv(spark, source, root, AS_OF)
    inner = []
    with pytest.raises(load.OvertakenError):
        _loading_with(spark, root, source, monkeypatch, lambda: inner.append(load.load_csv(spark, source, root, AS_OF)))
    assert published_runs(spark, root) == [inner[0].run, first.run]
    assert latest_run(spark, root).sequence == 2
    third = load.load_csv(spark, source, root, AS_OF)
    assert published_runs(spark, root)[0] == third.run
    assert sorted(load.load_log(spark, root).groupBy("run", "Status").count().toPandas()["Status"]) == [
        "failed", "published", "published", "published",
    ]


def test_a_line_that_is_still_being_written_is_not_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    root = str(tmp_path / "root")
    first = load.load_csv(spark, write_extracts(tmp_path / "in"), root, AS_OF)
    for sequence, text in ((2, ""), (3, '{"sequence": 3, "ru')):
        assert write_new(spark, f"{commit_path(root)}/{sequence:020d}.json", text)
    assert latest_run(spark, root).run == first.run and published_runs(spark, root) == [first.run]
    assert open_core(spark, root).rows == first.core.rows


def test_a_new_file_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/log/1.json"
    assert write_new(spark, path, json.dumps({"a": "é"})) and not write_new(spark, f"file:{path}", "other")
    assert json.loads((tmp_path / "log" / "1.json").read_text()) == {"a": "é"}


def test_rows_come_from_the_load(core, monkeypatch):
    for name, df in core.tables().items():
        assert core.row_count(name) == df.count()
    monkeypatch.setattr(type(core.patients), "count", lambda self: pytest.fail("counted again"))
    assert core.row_count("Patients") == 3
    assert quality.REASON == "Error_Reason"


# --- keys under a collation ---


def _in_capitals_and_small_letters() -> dict[str, list[dict[str, str]]]:
    """Keys as delivered in capitals; references in small letters, and one key twice in both."""
    rows = extract_rows()
    for name, entity in ENTITIES.items():
        for row in rows[name]:
            for column, _ in entity.foreign_keys:
                row[column] = row[column].lower()
    rows["Patients"].append(dict(rows["Patients"][1], Patient_ID="p2"))
    return rows


def test_keys_are_compared_by_the_collation(spark, tmp_path, core):
    from wardline.plans import reports

    root = str(tmp_path / "root")
    (tmp_path / "in").mkdir()
    source = write_extracts(tmp_path / "in", _in_capitals_and_small_letters())
    # Byte by byte, no reference has a counterpart.
    assert load.load_csv(spark, source, root, AS_OF).core.appointments.isEmpty()
    result = load.load_csv(spark, source, root, AS_OF, collation="UTF8_LCASE", on_violation=load.QUARANTINE)
    found = {(r[0].lower(), r[1]) for r in result.errors["Patients"].select("Patient_ID", "Error_Reason").collect()}
    assert ("p2", "Duplicate Patient_ID") in found and ("p3", "Duplicate Patient_ID") in found
    # Both spellings of the repeated key are gone, and what refers to either.
    assert {r[0] for r in result.core.patients.select("Patient_ID").collect()} == {"P1", "P6"}
    opened = open_core(spark, root)
    assert all(r[0] == "p1" for r in opened.appointments.select("Patient_ID").collect())
    patients = [tuple(r)[:4] for r in reports.top_patients(opened).collect()]
    plain = [tuple(r)[:4] for r in reports.top_patients(core).where("Patient_ID = 'P1'").collect()]
    assert [(p[0].upper(), *p[1:]) for p in patients] == plain
    assert [r.Doctor_ID.upper() for r in reports.top_doctors(opened).collect()] == ["D1"]
    assert opened.billing.join(opened.patients, "Patient_ID").count() == opened.billing.count() > 0


def test_breaches_are_looked_for_in_narrow_rows_written_once(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(load, "materialize", lambda df, label: written.append(df.columns) or materialize(df, label))
    load.load_csv(spark, write_extracts(tmp_path), str(tmp_path / "root"), AS_OF, on_violation=load.QUARANTINE)
    assert sorted(written) == sorted(
        [e.key, *(c for c, _ in e.foreign_keys), "_too_long"] for e in ENTITIES.values()
    )
