"""A small clinic with one example of every defect, as CSV extracts."""

from __future__ import annotations

import csv
from datetime import date
from pathlib import Path

from wardline.schema import ENTITIES

AS_OF = date(2026, 12, 3)

EXTRACTS = {
    "Patients": """
        Patient_ID,First_Name,Last_Name,Gender,Date_Of_Birth,Registration_Date
        P1,Ann,Lee,F,1980-02-29,2022-01-01
        P2,Bob,Ray,M,2010-07-01,2022-01-02
        P3,Cy,Fox,M,1970-01-01,2022-01-03
        P3,Cy,Fox,M,1970-01-01,2022-01-03
        P4,Di,,F,1990-01-01,2022-01-04
        P5,Ed,Orr,M,2999-01-01,2022-01-05
        P6,Flo,Ash,F,,2022-01-06
    """,
    "Doctors": """
        Doctor_ID,First_Name,Last_Name,Specialization
        D1,Gus,Poe,Oncology
        D2,Hal,Roe,Pediatrics
        D3,,Kim,Dermatology
    """,
    "Appointments": """
        Appointment_ID,Patient_ID,Doctor_ID,Appointment_Date,Appointment_Time,Status
        A1,P1,D1,2023-01-05,8:00:00,Completed
        A2,P1,D1,2023-01-05,15:15:00,No-show
        A3,P2,D1,2023-03-10,09:00:00,Cancelled
        A4,P1,D3,2023-03-11,09:00:00,Scheduled
        A5,P2,D1,2999-01-01,09:00:00,Scheduled
        A6,P9,D1,2023-01-01,09:00:00,Completed
        A7,P1,D9,2023-01-01,09:00:00,Completed
        A8,P1,D1,2023-01-02,09:00:00,Completed
        A8,P1,D1,2023-01-02,09:00:00,Completed
        A9,P1,,2023-01-03,09:00:00,Completed
        A11,P2,D3,2023-03-12,09:00:00,Completed
    """,
    "Treatments": """
        Treatment_ID,Appointment_ID,Treatment_Type,Cost,Treatment_Date
        T1,A1,MRI,100.00,2023-01-05
        T2,A1,ECG,50.00,2023-01-05
        T3,A2,MRI,200.00,2023-01-05
        T4,A3,X-Ray,10.00,2023-03-10
        T5,A4,ECG,40.00,2023-03-11
        T6,A99,ECG,1.00,2023-03-11
        T7,A1,ECG,1.00,2023-03-11
        T7,A1,ECG,1.00,2023-03-11
        T8,,ECG,1.00,2023-03-11
    """,
    "Billing": """
        Bill_ID,Patient_ID,Treatment_ID,Bill_Date,Amount,Payment_Method,Payment_Status
        B1,P1,T1,2023-01-05,100.00,Cash,Paid
        B2,P1,T2,2023-01-06,50.00,Cash,Pending
        B3,P1,T3,2023-01-07,200.00,Insurance,Failed
        B4,P1,T3,2023-03-07,30.00,Insurance,Paid
        B5,P2,T4,2023-03-10,0.00,Credit Card,Paid
        B6,P1,T1,2023-01-05,-5.00,Cash,Paid
        B7,P9,T1,2023-01-05,5.00,Cash,Paid
        B8,P1,T99,2023-01-05,5.00,Cash,Paid
        B9,P2,T1,2023-03-15,25.00,Cash,Pending
    """,
}


def extract_rows() -> dict[str, list[dict[str, str]]]:
    """The extracts as editable rows; an absent column is an empty field."""
    out = {}
    for name, text in EXTRACTS.items():
        lines = [line.strip() for line in text.strip().splitlines()]
        out[name] = list(csv.DictReader(lines))
    return out


def write_extracts(folder: Path, rows: dict[str, list[dict[str, str]]] | None = None) -> str:
    rows = rows or extract_rows()
    for name, entity in ENTITIES.items():
        with open(folder / entity.file, "w", newline="") as file:
            writer = csv.DictWriter(file, entity.columns, restval="", lineterminator="\n")
            writer.writerow({c: c.lower() for c in entity.columns})
            writer.writerows(rows[name])
    return str(folder)
