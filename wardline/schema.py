"""The five clinic entities: columns, types, lengths, keys and references."""

from __future__ import annotations

from dataclasses import dataclass

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    staged_length: int | None = None
    core_length: int | None = None


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    file: str
    fields: tuple[Field, ...]
    foreign_keys: tuple[tuple[str, str], ...] = ()
    # Large tables: the date that gives the month folder, if any, and the one or two columns by which rows are looked up.
    month_of: str | None = None
    lookups: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def ddl(self) -> str:
        return ", ".join(f"{f.name} {f.type}" for f in self.fields)

    def ddl_with(self, collation: str | None) -> str:
        """``ddl`` with keys and references under a collation, so that they are compared by it wherever they meet."""
        keys = {self.key, *(c for c, _ in self.foreign_keys)} if collation else set()
        return ", ".join(f"{f.name} {f.type}{f' collate {collation}' if f.name in keys else ''}" for f in self.fields)

    @property
    def core_lengths(self) -> dict[str, int]:
        return {f.name: f.core_length for f in self.fields if f.core_length}

    @property
    def staged_lengths(self) -> dict[str, int]:
        return {f.name: f.staged_length for f in self.fields if f.staged_length}


def _fields(text: str) -> tuple[Field, ...]:
    out = []
    for line in text.strip().splitlines():
        name, type_, *lengths = line.split()
        staged, core = (int(n) for n in lengths) if lengths else (None, None)
        out.append(Field(name, type_, staged, core))
    return tuple(out)


# Column order, types, and text lengths (staged, core) of the extracts.
PATIENTS = Entity("Patients", "Patient_ID", "patients.csv", _fields("""
    Patient_ID          string  50   20
    First_Name          string  50   50
    Last_Name           string  50   50
    Gender              string  20   10
    Date_Of_Birth       date
    Contact_Number      string  20   20
    Address             string  200  200
    Registration_Date   date
    Insurance_Provider  string  100  100
    Insurance_Number    string  100  50
    Email               string  100  100
"""))

DOCTORS = Entity("Doctors", "Doctor_ID", "doctors.csv", _fields("""
    Doctor_ID         string  50   20
    First_Name        string  50   50
    Last_Name         string  50   50
    Specialization    string  100  100
    Phone_Number      string  20   20
    Years_Experience  int
    Hospital_Branch   string  100  100
    Email             string  100  100
"""))

APPOINTMENTS = Entity("Appointments", "Appointment_ID", "appointments.csv", _fields("""
    Appointment_ID    string  50   20
    Patient_ID        string  50   20
    Doctor_ID         string  50   20
    Appointment_Date  date
    Appointment_Time  string
    Reason_For_Visit  string  200  200
    Status            string  50   50
"""), (("Patient_ID", "Patients"), ("Doctor_ID", "Doctors")), month_of="Appointment_Date", lookups=("Patient_ID", "Doctor_ID"))

TREATMENTS = Entity("Treatments", "Treatment_ID", "treatments.csv", _fields("""
    Treatment_ID    string  50   20
    Appointment_ID  string  50   20
    Treatment_Type  string  100  100
    Description     string  500  500
    Cost            decimal(10,2)
    Treatment_Date  date
"""), (("Appointment_ID", "Appointments"),), lookups=("Appointment_ID",))

BILLING = Entity("Billing", "Bill_ID", "billing.csv", _fields("""
    Bill_ID         string  50  20
    Patient_ID      string  50  20
    Treatment_ID    string  50  20
    Bill_Date       date
    Amount          decimal(10,2)
    Payment_Method  string  50  50
    Payment_Status  string  50  50
"""), (("Patient_ID", "Patients"), ("Treatment_ID", "Treatments")), month_of="Bill_Date", lookups=("Treatment_ID", "Patient_ID"))

# What the treatments and bills of an appointment come to, published beside the tables it is made of.
VISITS = Entity("Visits", "Appointment_ID", "", _fields("""
    Appointment_ID    string
    Patient_ID        string
    Doctor_ID         string
    Appointment_Date  date
    Treatments        bigint
    Amount            decimal(38,2)
    Weighted_Cost     decimal(38,2)
    Cost_Weight       bigint
"""), (("Patient_ID", "Patients"), ("Doctor_ID", "Doctors")), lookups=("Patient_ID", "Doctor_ID"))

# Parents come before children.
ENTITIES = {e.name: e for e in (PATIENTS, DOCTORS, APPOINTMENTS, TREATMENTS, BILLING)}

# Texts that the results look for.
COMPLETED, CANCELLED, NO_SHOW, SCHEDULED = "Completed", "Cancelled", "No-show", "Scheduled"
PAID, PENDING, FAILED = "Paid", "Pending", "Failed"
