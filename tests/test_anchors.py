"""Known figures of one real delivery of five extracts, over rows that are made to have them, and over the delivery
itself if ``CLINIC_CSV_DIR`` names its folder."""

from __future__ import annotations

import os
from datetime import date
from decimal import Decimal as D

import pytest
from figures import write_delivery

from wardline.plans import insights, load, reports

FOLDER = os.environ.get("CLINIC_CSV_DIR", "")

AS_OF = date(2026, 12, 3)


@pytest.fixture(scope="module", params=["made", "real"] if os.path.isdir(FOLDER) else ["made"])
def real(request, spark, tmp_path_factory):
    folder = FOLDER if request.param == "real" else write_delivery(tmp_path_factory.mktemp("made"))
    return load.load_csv(spark, folder, str(tmp_path_factory.mktemp("real")), AS_OF)


def test_nothing_is_quarantined(real):
    assert all(df.isEmpty() for df in real.errors.values())


def test_kpis(real):
    assert tuple(reports.kpi_summary(real.core).first()) == (
        50, 10, 200, 46, 52, 51, D("551249.85"), D("173424.90"), D("184612.01"),
    )


def test_leaders(real):
    patient = reports.top_patients(real.core).where("Spending_Rank = 1").first()
    assert (patient.Patient_ID, patient.Total_Spending, patient.Total_Visits) == ("P012", D("30053.08"), 10)
    doctor = reports.top_doctors(real.core).where("Revenue_Rank = 1").first()
    assert (doctor.Doctor_ID, doctor.Total_Revenue, doctor.Total_Visits, doctor.Total_Patients) == (
        "D005", D("82696.48"), 29, 23,
    )


def test_months(real):
    months = {(r.Revenue_Year, r.Revenue_Month): r.Total_Revenue for r in reports.monthly_revenue(real.core).collect()}
    assert len(months) == 12
    assert min(months.items(), key=lambda m: m[1]) == ((2023, 12), D("27569.71"))
    assert max(months.items(), key=lambda m: m[1]) == ((2023, 4), D("64271.54"))


def test_mixes(real):
    core = real.core
    shares = {r.Payment_Status: tuple(r)[1:] for r in insights.payment_status_share(core).collect()}
    assert shares == {
        "Paid": (D("173424.90"), D("31.5")),
        "Pending": (D("184612.01"), D("33.5")),
        "Failed": (D("193212.94"), D("35.0")),
    }
    card = reports.payment_methods(core).first()
    assert tuple(card) == ("Credit Card", 75, D("201382.43"), D("37.5"))
    top = [tuple(r)[:3] for r in reports.treatment_performance(core).orderBy("Revenue_Rank").limit(3).collect()]
    assert top == [
        ("Chemotherapy", 49, D("128855.68")),
        ("MRI", 36, D("116098.16")),
        ("X-Ray", 41, D("110653.67")),
    ]
    assert tuple(insights.inactive_patients(core).first()) == (48, 2, D("4.17"))
    assert {r[0]: r[1] for r in insights.gender_mix(core).collect()} == {"M": 31, "F": 19}
    assert {r[0]: r[1] for r in insights.insurance_mix(core).collect()} == {
        "MedCare Plus": 18,
        "WellnessCorp": 16,
        "PulseSecure": 10,
        "HealthIndia": 6,
    }
    ages = {}
    for row in reports.age_gender(core, AS_OF).collect():
        ages[row.Age_Group] = ages.get(row.Age_Group, 0) + row.Patient_Count
    assert ages == {"18-35": 18, "36-50": 13, "51-65": 12, "Over 65": 7}
    assert tuple(insights.not_reached_rate(core).first()) == (103, D("51.50"))
