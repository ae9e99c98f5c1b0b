from __future__ import annotations

from datetime import date
from decimal import Decimal as D

import pytest
from clinic import AS_OF

from wardline.plans import facts, insights, procedures, reports, views

JAN5, MAR10, MAR11, MAR12 = date(2023, 1, 5), date(2023, 3, 10), date(2023, 3, 11), date(2023, 3, 12)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def test_patient_view(core):
    columns = ("Patient_ID", "Total_Appointments", "Total_Treatment_Cost", "Total_Paid_Amount", "Last_Visit_Date")
    assert rows(views.patient_analysis(core), *columns) == [
        ("P1", 3, D("390.00"), D("380.00"), MAR11),
        ("P2", 2, D("10.00"), D("25.00"), MAR12),
        ("P6", 0, D("0.00"), D("0.00"), None),
    ]


def test_doctor_view(core):
    assert rows(views.doctor_performance(core)) == [
        ("D1", "Gus Poe", "Oncology", 3, 4, D("405.00")),
        ("D2", "Hal Roe", "Pediatrics", 0, 0, D("0.00")),
        ("D3", " Kim", "Dermatology", 2, 1, D("0.00")),
    ]


def test_revenue_view(core):
    assert rows(views.revenue_analysis(core)) == [
        ("ECG", 1, D("50.00"), D("50.000000"), 0, 1, 0, D("0.00")),
        ("MRI", 2, D("355.00"), D("150.000000"), 2, 1, 1, D("50.00")),
        ("X-Ray", 1, D("0.00"), D("10.000000"), 1, 0, 0, D("100.00")),
    ]


def test_appointment_view(core):
    [day] = views.appointment_analysis(core).where(f"Appointment_Date = '{JAN5}'").collect()
    assert tuple(day) == (JAN5, "Thursday", 2, 1, 0, 1, 0, D("50.00"), D("50.00"), D("0.00"))


RANKING = [{}, {"one_task_rows": 0, "buckets": 3}]


@pytest.mark.parametrize("ranking", RANKING)
def test_top_doctors(core, ranking):
    assert rows(reports.top_doctors(core, **ranking)) == [("D1", "Gus Poe", "Oncology", 3, 2, D("405.00"), 1)]


@pytest.mark.parametrize("ranking", RANKING)
def test_top_patients(core, ranking):
    assert rows(reports.top_patients(core, **ranking)) == [
        ("P1", "Ann Lee", 2, 3, D("405.00"), D("202.50"), 1),
        ("P2", "Bob Ray", 1, 1, D("0.00"), D("0.00"), 2),
    ]


def test_monthly_revenue(core):
    assert rows(reports.monthly_revenue(core)) == [
        (2023, 1, "January", D("350.00"), None, None, None),
        (2023, 3, "March", D("55.00"), D("350.00"), D("-295.00"), D("-84.29")),
    ]


@pytest.mark.parametrize("repeating", [{}, {"chunk": 1, "one_task_copies": 0}])
def test_patient_retention(core, repeating):
    columns = ("Patient_ID", "Appointment_Date", "Previous_Visit_Date", "Patient_Status")
    expected = [
        ("P1", JAN5, None, "New Patient"),
        ("P1", JAN5, JAN5, "Returning Patient"),
        ("P1", MAR11, JAN5, "Returning Patient"),
        ("P2", MAR10, None, "New Patient"),
        ("P2", MAR12, MAR10, "Returning Patient"),
    ]
    assert rows(reports.patient_retention(core, **repeating), *columns) == sorted(expected, key=str)


@pytest.mark.parametrize("ranking", RANKING)
def test_patient_segmentation(core, ranking):
    columns = ("Patient_ID", "Avg_Patient_Spending", "Spending_Rank", "Patient_Segment")
    assert rows(reports.patient_segmentation(core, **ranking), *columns) == [
        ("P1", D("202.500000"), 1, "Regular Patient"),
        ("P2", D("202.500000"), 2, "One-Time Patient"),
    ]


def test_doctor_performance_weighs_cost_by_bills(core):
    [row] = reports.doctor_performance(core).collect()
    assert row.Avg_Treatment_Cost == D("110.00") and row.Total_Revenue == D("405.00")


def test_treatment_performance(core):
    columns = ("Treatment_Type", "Total_Treatments", "Total_Revenue", "Avg_Treatment_Cost", "Revenue_Rank")
    assert rows(reports.treatment_performance(core), *columns) == [
        ("ECG", 1, D("50.00"), D("50.00"), 2),
        ("MRI", 2, D("355.00"), D("150.00"), 1),
        ("X-Ray", 1, D("0.00"), D("10.00"), 3),
    ]


def test_appointment_status(core):
    assert rows(reports.appointment_status(core)) == [
        ("Cancelled", 1, 5, D("20.00")),
        ("Completed", 2, 5, D("40.00")),
        ("No-show", 1, 5, D("20.00")),
        ("Scheduled", 1, 5, D("20.00")),
    ]


def test_payment_methods_in_order(core):
    assert [tuple(r) for r in reports.payment_methods(core).collect()] == [
        ("Insurance", 2, D("230.00"), D("33.3")),
        ("Cash", 3, D("175.00"), D("50.0")),
        ("Credit Card", 1, D("0.00"), D("16.7")),
    ]


def test_age_gender_in_text_order(core):
    assert [tuple(r) for r in reports.age_gender(core, AS_OF).collect()] == [
        ("36-50", "F", 1),
        ("Over 65", "F", 1),
        ("Under 18", "M", 1),
    ]


def test_kpi_summary(core):
    [row] = reports.kpi_summary(core).collect()
    assert tuple(row) == (3, 3, 5, 2, 1, 1, D("405.00"), D("130.00"), D("75.00"))


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_patient_procedure(core, limits):
    [row] = procedures.patient_analysis(core, "P1", **limits).collect()
    assert tuple(row) == ("P1", "Ann Lee", 2, 3, D("405.00"), JAN5)
    assert procedures.patient_analysis(core, "P6").collect() == []
    assert procedures.patient_analysis(core, "nobody").collect() == []


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_doctor_procedure(core, limits):
    [row] = procedures.doctor_performance(core, "D1", **limits).collect()
    assert tuple(row) == ("D1", "Gus Poe", "Oncology", 2, 3, D("405.00"), D("110.000000"))
    assert procedures.doctor_performance(core, "D2").collect() == []


def test_revenue_procedure(core):
    start, end = date(2023, 1, 6), date(2023, 3, 10)
    [row] = procedures.revenue_report(core, start, end).collect()
    assert tuple(row) == (start, end, 4, D("280.00"), D("70.000000"), D("200.00"), D("0.00"))
    start, end = date(1990, 1, 1), date(1990, 1, 2)
    [row] = procedures.revenue_report(core, start, end).collect()
    assert tuple(row) == (start, end, 0, None, None, None, None)


def test_kpis_of_an_empty_core(spark, core):
    from wardline.sources import Core

    empty = Core.of({name: df.limit(0) for name, df in core.tables().items()})
    [row] = reports.kpi_summary(empty).collect()
    assert tuple(row) == (0, 0, 0, 0, 0, 0, None, None, None)
    assert views.patient_analysis(empty).collect() == []
    assert reports.appointment_status(empty).collect() == []


def test_insights(core):
    assert rows(insights.payment_status_share(core)) == [
        ("Failed", D("200.00"), D("49.4")),
        ("Paid", D("130.00"), D("32.1")),
        ("Pending", D("75.00"), D("18.5")),
    ]
    assert rows(insights.inactive_patients(core)) == [(2, 1, D("2.50"))]
    assert rows(insights.specialization_mix(core)) == [("Dermatology", 1), ("Oncology", 1), ("Pediatrics", 1)]
    assert rows(insights.insurance_mix(core)) == [(None, 3)]
    assert rows(insights.gender_mix(core)) == [("F", 2), ("M", 1)]
    assert rows(insights.not_reached_rate(core)) == [(2, D("40.00"))]


def test_fact_chain(core):
    chain = facts.fact_chain(core.appointments, core.treatments, core.billing)
    assert rows(chain, "Appointment_ID", "Treatments", "Amount", "Weighted_Cost", "Cost_Weight") == [
        ("A1", 2, D("175.00"), D("250.00"), 3),
        ("A2", 1, D("230.00"), D("400.00"), 2),
        ("A3", 1, D("0.00"), D("10.00"), 1),
    ]


def test_views_are_visible_to_sql(spark, core):
    views.register_views(core)
    top = spark.sql("select Doctor_ID from vw_Doctor_Performance order by Total_Revenue desc limit 1").first()
    assert top.Doctor_ID == "D1"
    assert spark.sql("select count(*) as n from Billing").first().n == 6


def test_invariants(core):
    shares = [r.Status_Percentage for r in reports.appointment_status(core).collect()]
    assert abs(sum(shares) - 100) <= D("0.04")
    monthly = sum(r.Total_Revenue for r in reports.monthly_revenue(core).collect())
    assert monthly == reports.kpi_summary(core).first().Total_Revenue_Billed
