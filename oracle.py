"""Plain SQL for each registered query, over the given tables, for DuckDB.

Written against the meaning of each result, with direct joins and distinct counts, and
independent of how the library computes it. Quotients are rounded half up in integers,
because DuckDB divides decimals as doubles.
"""

from __future__ import annotations

import re


def _rounded(numerator: str, denominator: str, places: int, type_: str) -> str:
    """numerator / denominator, both integers, rounded half away from zero; NULL for a zero denominator."""
    n, d = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)"
    units = f"((2 * abs({n}) * {10**places} + abs({d})) // nullif(2 * abs({d}), 0))"
    unit = "1" if places == 0 else "0." + "0" * (places - 1) + "1"
    signed = f"cast(sign({n}) * sign({d}) * {units} as decimal(28,0))"
    return f"cast({signed} * cast({unit} as decimal({places + 1},{places})) as {type_})"


def _cents(amount: str) -> str:
    return f"cast({amount} * 100 as bigint)"


def _percent(part: str, whole: str, type_: str = "decimal(5,2)") -> str:
    return _rounded(f"100 * ({part})", whole, int(type_.rstrip(")").split(",")[1]), type_)


def _mean_money(amount: str, places: int, type_: str) -> str:
    return _rounded(f"sum({_cents(amount)})", f"100 * count({amount})", places, type_)


# Age groups with their first and last age.
_AGE_BANDS = "(-1000, 17, 'Under 18'), (18, 35, '18-35'), (36, 50, '36-50'), (51, 65, '51-65'), (66, 1000, 'Over 65')"

_NAME = "concat(First_Name, ' ', Last_Name)"

_CHAIN = """
chain as (
  select a.Appointment_ID, a.Patient_ID, a.Doctor_ID, a.Appointment_Date,
         t.Treatment_ID, t.Cost, b.Bill_ID, b.Amount
  from appointments a
  join treatments t on t.Appointment_ID = a.Appointment_ID
  join billing b on b.Treatment_ID = t.Treatment_ID
)
"""

# The clean tables, as they are after a load.
_CLEAN = """
with dealt as (
  select *, o_custkey + case when o_custkey % 10 = 0 then 1 else 0 end as patient,
         o_orderkey % (select count(*) from supplier) as doctor
  from orders
),
patients as (
  select cast(c_custkey as varchar) as Patient_ID,
         substring(c_name, 1, 8) as First_Name, substring(c_name, 10) as Last_Name,
         case when c_custkey % 2 = 0 then 'F' else 'M' end as Gender,
         case when c_custkey % 11 <> 0 then date '1940-01-01' + cast(c_custkey * 7919 % 25550 as integer) end as Date_Of_Birth,
         cast(null as varchar) as Contact_Number, cast(null as varchar) as Address,
         date '1990-01-01' + cast(c_custkey % 1825 as integer) as Registration_Date,
         c_mktsegment as Insurance_Provider, 'INS' || c_custkey as Insurance_Number,
         cast(null as varchar) as Email
  from customer
),
doctors as (
  select cast(s_suppkey as varchar) as Doctor_ID,
         substring(s_name, 1, 8) as First_Name, case when s_suppkey % 7 <> 0 then substring(s_name, 10) end as Last_Name,
         n_name as Specialization, cast(null as varchar) as Phone_Number,
         cast(null as integer) as Years_Experience, cast(null as varchar) as Hospital_Branch,
         cast(null as varchar) as Email
  from supplier join nation on s_nationkey = n_nationkey
),
appointments as (
  select cast(o_orderkey as varchar) as Appointment_ID, cast(patient as varchar) as Patient_ID,
         cast(doctor + case when doctor % 10 = 0 then 1 else 0 end as varchar) as Doctor_ID,
         cast(o_orderdate as date) as Appointment_Date,
         lpad(cast(o_orderkey % 10 + 8 as varchar), 2, '0') || ':'
           || lpad(cast(o_orderkey % 4 * 15 as varchar), 2, '0') || ':00' as Appointment_Time,
         cast(null as varchar) as Reason_For_Visit,
         case when o_orderpriority = '5-LOW' then 'Cancelled'
              else case o_orderstatus when 'F' then 'Completed' when 'P' then 'No-show' when 'O' then 'Scheduled' end
         end as Status
  from dealt
),
treatments as (
  select cast(l_orderkey * 10 + l_linenumber as varchar) as Treatment_ID,
         cast(l_orderkey as varchar) as Appointment_ID, min(p_type) as Treatment_Type,
         cast(null as varchar) as Description,
         cast(max(l_extendedprice) as decimal(10,2)) as Cost, cast(min(l_shipdate) as date) as Treatment_Date
  from lineitem join part on p_partkey = l_partkey group by l_orderkey, l_linenumber
),
billing as (
  select l_orderkey * 10 + l_linenumber || '-' || row_number() over (
           partition by l_orderkey, l_linenumber
           order by l_extendedprice, l_discount, l_shipdate, l_returnflag, l_quantity) as Bill_ID,
         cast(case when l_linenumber <> 1 then o_custkey
                   when o_custkey % 2 = 0 then o_custkey + 1 else o_custkey - 1 end as varchar) as Patient_ID,
         cast(l_orderkey * 10 + l_linenumber as varchar) as Treatment_ID,
         cast(l_shipdate as date) as Bill_Date,
         cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(10,2)) as Amount,
         o_orderpriority as Payment_Method,
         case l_returnflag when 'A' then 'Paid' when 'N' then 'Pending' when 'R' then 'Failed' end as Payment_Status
  from lineitem join orders on o_orderkey = l_orderkey
),
""" + _CHAIN

# The staged rows of the dirty delivery.
_DIRTY = """
with patients as (
  select case when c_acctbal between 8800 and 9000 then null
              when c_acctbal < -500 then 'X' || c_custkey else cast(c_custkey as varchar) end as Patient_ID,
         substring(c_name, 1, 8) as First_Name,
         case when c_acctbal between 0 and 500 then null else substring(c_name, 10) end as Last_Name,
         case when c_custkey % 11 <> 0 then date '1940-01-01' + cast(c_custkey * 7919 % 25550 as integer) end as Date_Of_Birth,
         date '1990-01-01' + cast(c_custkey % 1825 as integer) as Registration_Date
  from customer, range(case when c_acctbal > 9000 then 2 else 1 end)
),
doctors as (
  select case when s_acctbal > 9500 then null
              when s_acctbal < 0 then 'X' || s_suppkey else cast(s_suppkey as varchar) end as Doctor_ID
  from supplier
),
dealt as (
  select *, o_custkey + case when o_custkey % 10 = 0 then 1 else 0 end as patient,
         o_orderkey % (select count(*) from supplier) as doctor
  from orders
),
appointments as (
  select case when o_totalprice < 5000 then 'X' || o_orderkey else cast(o_orderkey as varchar) end as Appointment_ID,
         cast(patient as varchar) as Patient_ID,
         case when o_totalprice < 10000 then null
              else cast(doctor + case when doctor % 10 = 0 then 1 else 0 end as varchar) end as Doctor_ID,
         cast(o_orderdate as date) as Appointment_Date
  from dealt, range(case when o_totalprice > 480000 then 2 else 1 end)
),
treatments as (
  select case when l_quantity = 50 then null else cast(l_orderkey * 10 + l_linenumber as varchar) end as Treatment_ID,
         case when l_quantity = 1 then null else cast(l_orderkey as varchar) end as Appointment_ID
  from lineitem
),
billing as (
  select l_orderkey * 10 + l_linenumber || '-' || row_number() over (
           partition by l_orderkey, l_linenumber
           order by l_extendedprice, l_discount, l_shipdate, l_returnflag, l_quantity) as Bill_ID,
         cast(case when l_linenumber <> 1 then o_custkey
                   when o_custkey % 2 = 0 then o_custkey + 1 else o_custkey - 1 end as varchar) as Patient_ID,
         cast(l_orderkey * 10 + l_linenumber as varchar) as Treatment_ID,
         cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(10,2))
           * case when l_returnflag = 'R' and l_discount > 0.085 then -1 else 1 end as Amount
  from lineitem join orders on o_orderkey = l_orderkey
)
"""


def _missing(table: str, key: str, reason: str, *columns: str) -> str:
    condition = " or ".join(f"{c} is null" for c in columns)
    return f"select {key}, '{reason}' as Error_Reason from {table} where {condition}"


def _duplicate(table: str, key: str, reason: str) -> str:
    return (
        f"select {key}, '{reason}' as Error_Reason from "
        f"(select {key}, row_number() over (partition by {key}) as n from {table} where {key} is not null) where n > 1"
    )


def _future(table: str, key: str, reason: str, column: str) -> str:
    return f"select {key}, '{reason}' as Error_Reason from {table} where {column} > date '2000-01-01'"


def _orphan(table: str, key: str, column: str, parent: str, reason: str) -> str:
    return (
        f"select {key}, '{reason}' as Error_Reason from {table} c "
        f"where not exists (select 1 from {parent} p where p.{column} = c.{column})"
    )


_RULES = {
    "patients": {
        "dq_patient_duplicate": _duplicate("patients", "Patient_ID", "Duplicate Patient_ID"),
        "dq_patient_missing": _missing(
            "patients",
            "Patient_ID",
            "Missing required field (ID/Name/Registration_Date)",
            "Patient_ID",
            "First_Name",
            "Last_Name",
            "Registration_Date",
        ),
        "dq_patient_future_dob": _future("patients", "Patient_ID", "Date_Of_Birth is in the future", "Date_Of_Birth"),
    },
    "doctors": {"dq_doctor_missing": _missing("doctors", "Doctor_ID", "Missing Doctor_ID", "Doctor_ID")},
    "appointments": {
        "dq_appointment_duplicate": _duplicate("appointments", "Appointment_ID", "Duplicate Appointment_ID"),
        "dq_appointment_missing": _missing(
            "appointments",
            "Appointment_ID",
            "Missing required field (ID/Patient/Doctor/Date)",
            "Appointment_ID",
            "Patient_ID",
            "Doctor_ID",
            "Appointment_Date",
        ),
        "dq_appointment_future": _future(
            "appointments", "Appointment_ID", "Appointment_Date is in the future", "Appointment_Date"
        ),
        "dq_appointment_orphan_patient": _orphan(
            "appointments",
            "Appointment_ID",
            "Patient_ID",
            "patients",
            "References a Patient_ID not found in stg.Patients",
        ),
        "dq_appointment_orphan_doctor": _orphan(
            "appointments", "Appointment_ID", "Doctor_ID", "doctors", "References a Doctor_ID not found in stg.Doctors"
        ),
    },
    "treatments": {
        "dq_treatment_duplicate": _duplicate("treatments", "Treatment_ID", "Duplicate Treatment_ID"),
        "dq_treatment_missing": _missing(
            "treatments",
            "Treatment_ID",
            "Missing required field (ID/Appointment_ID)",
            "Treatment_ID",
            "Appointment_ID",
        ),
        "dq_treatment_orphan": _orphan(
            "treatments",
            "Treatment_ID",
            "Appointment_ID",
            "appointments",
            "References an Appointment_ID not found in stg.Appointments",
        ),
    },
    "billing": {
        "dq_bill_negative": "select Bill_ID, 'Negative Amount' as Error_Reason from billing where Amount < 0",
        "dq_bill_orphan_patient": _orphan(
            "billing", "Bill_ID", "Patient_ID", "patients", "References a Patient_ID not found in stg.Patients"
        ),
        "dq_bill_orphan_treatment": _orphan(
            "billing", "Bill_ID", "Treatment_ID", "treatments", "References a Treatment_ID not found in stg.Treatments"
        ),
    },
}
_KEYS = {
    "patients": "Patient_ID",
    "doctors": "Doctor_ID",
    "appointments": "Appointment_ID",
    "treatments": "Treatment_ID",
    "billing": "Bill_ID",
}


def _log_of(table: str) -> str:
    return " union all ".join(f"({sql})" for sql in _RULES[table].values())


_LOGS = ",\n".join(f"{t}_log as ({_log_of(t)})" for t in _RULES)
_KEPT = ",\n".join(
    f"kept_{t} as (select * from {t} s where not exists (select 1 from {t}_log e where e.{k} = s.{k}))"
    for t, k in _KEYS.items()
)


def _per_table(expression: str, source: str = "{t}") -> str:
    return " union all ".join(
        f"select '{t.capitalize()}' as Table_Name, {expression.format(t=t, k=k)} from {source.format(t=t, k=k)}"
        for t, k in _KEYS.items()
    )


def _check(table: str, check: str, column: str, counted: str) -> str:
    return (
        f"select '{table.capitalize()}' as Table_Name, '{check}' as \"Check\", '{column}' as Column_Name, "
        f"cast(({counted}) as bigint) as Violations"
    )


def _key_checks() -> str:
    parts = []
    for t, k in _KEYS.items():
        parts.append(_check(t, "key is null", k, f"select count(*) from kept_{t} where {k} is null"))
        repeated = f"select count(*) from (select {k} from kept_{t} where {k} is not null group by {k} having count(*) > 1)"
        parts.append(_check(t, "key not unique", k, repeated))
    return " union all ".join(parts)


def _reference_checks() -> str:
    parts = []
    for table, column, parent in (
        ("appointments", "Patient_ID", "patients"),
        ("appointments", "Doctor_ID", "doctors"),
        ("treatments", "Appointment_ID", "appointments"),
        ("billing", "Patient_ID", "patients"),
        ("billing", "Treatment_ID", "treatments"),
    ):
        unmatched = (
            f"select count(*) from kept_{table} c where c.{column} is not null "
            f"and not exists (select 1 from kept_{parent} p where p.{column} = c.{column})"
        )
        parts.append(_check(table, f"not found in {parent.capitalize()}", column, unmatched))
    return " union all ".join(parts)


# Text lengths of the core columns that the test tables fill.
_CORE_LENGTHS = {
    "patients": {
        "Patient_ID": 20, "First_Name": 50, "Last_Name": 50, "Gender": 10, "Contact_Number": 20, "Address": 200,
        "Insurance_Provider": 100, "Insurance_Number": 50, "Email": 100,
    },
    "doctors": {
        "Doctor_ID": 20, "First_Name": 50, "Last_Name": 50, "Specialization": 100, "Phone_Number": 20,
        "Hospital_Branch": 100, "Email": 100,
    },
    "appointments": {"Appointment_ID": 20, "Patient_ID": 20, "Doctor_ID": 20, "Reason_For_Visit": 200, "Status": 50},
    "treatments": {"Treatment_ID": 20, "Appointment_ID": 20, "Treatment_Type": 100, "Description": 500},
    "billing": {"Bill_ID": 20, "Patient_ID": 20, "Treatment_ID": 20, "Payment_Method": 50, "Payment_Status": 50},
}


def _delivered(table: str, column: str) -> str:
    """Genders are checked as delivered by a clinic that writes them out for every fifth patient."""
    if (table, column) != ("patients", "Gender"):
        return column
    return "case when cast(Patient_ID as integer) % 5 = 0 then 'not stated yet' else Gender end"


def _length_checks() -> str:
    return " union all ".join(
        _check(t, f"longer than {n}", c, f"select count(*) from {t} where length({_delivered(t, c)}) > {n}")
        for t, columns in _CORE_LENGTHS.items()
        for c, n in columns.items()
    )


def _without_parent(table: str, column: str, parent: str) -> str:
    return f"c.{column} is not null and not exists (select 1 from clean_{parent} p where p.{column} = c.{column})"


# References, parents first.
_REFERENCES = {
    "patients": (),
    "doctors": (),
    "appointments": (("Patient_ID", "patients"), ("Doctor_ID", "doctors")),
    "treatments": (("Appointment_ID", "appointments"),),
    "billing": (("Patient_ID", "patients"), ("Treatment_ID", "treatments")),
}


def _cascade(table: str) -> str:
    """What is left of a table when rows without a key and children of quarantined parents go as well, and their errors."""
    key = _KEYS[table]
    lost = [_without_parent(table, column, parent) for column, parent in _REFERENCES[table]]
    kept = " ".join(f"and not ({condition})" for condition in lost)
    errors = [f"select {key}, 'Parent quarantined' as Error_Reason from kept_{table} c where {condition}" for condition in lost]
    more = " union all ".join([_log_of(table), *errors])
    return (
        f"clean_{table} as (select * from kept_{table} c where {key} is not null {kept}), "
        f"all_errors_{table} as ({more})"
    )


_CASCADE = ", ".join(_cascade(t) for t in _REFERENCES)


def _rule_queries() -> dict[str, str]:
    out = {}
    for table, rules in _RULES.items():
        out |= {name: f"{_DIRTY} {sql}" for name, sql in rules.items()}
        out[f"errors_{table}"] = f"{_DIRTY} {_log_of(table)}"
    out["dq_summary"] = (
        f"{_DIRTY}, {_LOGS} " + _per_table("count(distinct {k}) as Quarantined_Rows", source="{t}_log")
    )
    out["load_exclude_quarantined"] = f"{_DIRTY}, {_LOGS}, {_KEPT} " + _per_table("{k} as Row_Key", source="kept_{t}")
    out["check_primary_key"] = f"{_DIRTY}, {_LOGS}, {_KEPT} {_key_checks()}"
    out["check_foreign_key"] = f"{_DIRTY}, {_LOGS}, {_KEPT} {_reference_checks()}"
    out["check_length"] = f"{_CLEAN} {_length_checks()}"
    number = "cast(regexp_extract(Appointment_ID, '[0-9]+') as bigint)"
    hot = f"select * replace (case when {number} % 3 = 0 then '12' else Patient_ID end as Patient_ID) from appointments"
    orphans = _RULES["appointments"]["dq_appointment_orphan_patient"].replace("from appointments c", f"from ({hot}) c")
    out["anti_join_hot_keys"] = f"{_DIRTY} {orphans}"
    out["load_cascade"] = f"{_DIRTY}, {_LOGS}, {_KEPT}, {_CASCADE} " + _per_table("{k} as Row_Key", source="clean_{t}")
    out["load_cascade_errors"] = f"{_DIRTY}, {_LOGS}, {_KEPT}, {_CASCADE} " + _per_table(
        "{k} as Row_Key, Error_Reason", source="all_errors_{t}"
    )
    out["load_log"] = _load_log()
    out["dq_collated"] = _collated_errors()
    return out


def _collated_errors() -> str:
    """The rules over keys in capital and references in small letters, compared without regard to case."""
    columns = {t: [key, *(c for c, _ in _REFERENCES[t])] for t, key in _KEYS.items()}
    spelled = ",\n".join(
        f"spelled_{t} as (select * replace ("
        + ", ".join(f"('{'K' if c == _KEYS[t] else 'k'}' || lower({c})) collate nocase as {c}" for c in names)
        + f") from {t})"
        for t, names in columns.items()
    )
    logs = ",\n".join(
        f"spelled_{t}_log as (" + " union all ".join(f"({_respelled(sql)})" for sql in rules.values()) + ")"
        for t, rules in _RULES.items()
    )
    return f"{_DIRTY}, {spelled}, {logs} " + _per_table("lower({k}) as Row_Key, Error_Reason", source="spelled_{t}_log")


def _respelled(sql: str) -> str:
    return re.sub(r"\bfrom (patients|doctors|appointments|treatments|billing)\b", r"from spelled_\1", sql)


def _load_log() -> str:
    """Three loads: the clean delivery, the dirty one that stops, and the dirty one with quarantine."""

    def counts(number: int, status: str, errors: str, left: str, published: bool) -> str:
        return _per_table(
            f"{number} as Load_Number, '{status}' as Status, count(*) as Read_Rows, 0 as Rejected_Rows, "
            f"({errors}) as Error_Rows, count(*) - (select count(*) from {left}) as Quarantined_Rows, "
            + (f"(select count(*) from {left})" if published else "0")
            + " as Published_Rows"
        )

    columns = "Load_Number, Status, Table_Name, Read_Rows, Rejected_Rows, Error_Rows, Quarantined_Rows, Published_Rows"
    dirty = f"{_DIRTY}, {_LOGS}, {_KEPT}, {_CASCADE}"
    loads = (
        f"{_CLEAN} select {columns} from ({counts(1, 'published', 'select 0', '{t}', True)})",
        f"{dirty} select {columns} from ({counts(2, 'failed', 'select count(*) from {t}_log', 'kept_{t}', False)})",
        f"{dirty} select {columns} from ({counts(3, 'published', 'select count(*) from all_errors_{t}', 'clean_{t}', True)})",
    )
    typed = ", ".join(c if c in ("Status", "Table_Name") else f"cast({c} as bigint) as {c}" for c in columns.split(", "))
    return f"select {typed} from (" + " union all ".join(f"({sql})" for sql in loads) + ")"


def _load_queries() -> dict[str, str]:
    out = {}
    for table in _KEYS:
        out[f"core_{table}"] = f"{_CLEAN} select * from {table}"
        out[f"source_{table}"] = f"{_CLEAN} select * from {table}"
    out["source_bad_rows"] = (
        "select cast(c_custkey as varchar) as Patient_ID, 'Unparseable row' as Error_Reason from customer where c_acctbal < 0"
    )
    codes = {"patients": 50001, "doctors": 50002, "appointments": 50003, "treatments": 50004, "billing": 50005}
    out["load_guard_empty"] = f"{_CLEAN} " + " union all ".join(
        f"select '{t.capitalize()}' as Table_Name, {code} as Error_Code, "
        f"case when count(*) = 0 then 'empty' else 'ok' end as Status from {t}{' where false' if t == 'treatments' else ''}"
        for t, code in codes.items()
    )
    # Times of orders by their number; 0 stands for no time at all.
    out["source_bad_times"] = """
        select cast(o_orderkey as varchar) as Appointment_ID, 'Unparseable row' as Error_Reason
        from orders where o_orderkey % 7 in (1, 2, 3)"""
    out["layout_treatment_lookup"] = f"""{_CLEAN}
        select Treatment_ID, Appointment_ID, Cost from treatments
        where Appointment_ID = (select max(Appointment_ID) from treatments)"""
    out["source_multiline"] = f"""{_CLEAN}
        select * replace (case cast(Patient_ID as bigint) % 3
                            when 0 then '"House", ' || Patient_ID || chr(10) || chr(10) || Last_Name || ',' || chr(13) || chr(10) || '"'
                            when 1 then 'say ""' || Patient_ID end as Address)
        from patients"""
    out["layout_doctor_lookup"] = f"""{_CLEAN}
        select Appointment_ID, Patient_ID, Doctor_ID, Appointment_Date from appointments where Doctor_ID = '5'"""
    out["layout_patient_bills"] = f"""{_CLEAN}
        select Bill_ID, Patient_ID, Treatment_ID, Amount from billing where Patient_ID = '12'"""
    for table in ("appointments", "billing"):
        out[f"core_{table}_by_month"] = f"{_CLEAN} select * from {table}"
    out["load_row_counts"] = f"{_CLEAN} " + _per_table("count(*) as Row_Count")
    out["load_publish"] = out["load_row_counts"]
    out["layout_billing_by_month"] = f"""{_CLEAN}
        select cast(date_trunc('month', Bill_Date) as date) as Bill_Month, count(*) as Bill_Count,
               cast(sum(Amount) as decimal(38,2)) as Total_Amount
        from billing group by 1"""
    out["layout_appointments_by_month"] = f"""{_CLEAN}
        select cast(date_trunc('month', Appointment_Date) as date) as Visit_Month, Status,
               count(*) as Appointment_Count
        from appointments group by 1, 2"""
    out["fact_chain"] = f"""{_CLEAN}
        select Appointment_ID, Patient_ID, Doctor_ID, Appointment_Date,
               count(distinct Treatment_ID) as Treatments, cast(sum(Amount) as decimal(38,2)) as Amount,
               cast(sum(Cost) as decimal(38,2)) as Weighted_Cost, count(Cost) as Cost_Weight
        from chain group by 1, 2, 3, 4"""
    out["visits_published"] = out["fact_chain"]
    return out


def _view_queries() -> dict[str, str]:
    share = _percent("count(*) filter (Payment_Status = 'Paid')", "count(Bill_ID)")
    rates = ", ".join(
        f"{_percent(f'count(*) filter (Status = {status!r})', 'count(*)')} as {name}_Rate"
        for status, name in (("Completed", "Completion"), ("No-show", "No_Show"), ("Cancelled", "Cancellation"))
    )
    return {
        "view_patient_analysis": f"""{_CLEAN}
            select Patient_ID, {_NAME} as Patient_Name, Gender, Insurance_Provider,
              (select count(*) from appointments a where a.Patient_ID = p.Patient_ID) as Total_Appointments,
              cast(coalesce((select sum(t.Cost) from appointments a join treatments t using (Appointment_ID)
                             where a.Patient_ID = p.Patient_ID), 0) as decimal(38,2)) as Total_Treatment_Cost,
              cast(coalesce((select sum(b.Amount) from billing b where b.Patient_ID = p.Patient_ID), 0)
                   as decimal(38,2)) as Total_Paid_Amount,
              (select max(a.Appointment_Date) from appointments a where a.Patient_ID = p.Patient_ID) as Last_Visit_Date
            from patients p""",
        "view_doctor_performance": f"""{_CLEAN}
            select Doctor_ID, {_NAME} as Doctor_Name, Specialization,
              (select count(*) from appointments a where a.Doctor_ID = d.Doctor_ID) as Total_Visits,
              (select count(*) from appointments a join treatments t using (Appointment_ID)
               where a.Doctor_ID = d.Doctor_ID) as Total_Treatments,
              cast(coalesce((select sum(c.Amount) from chain c where c.Doctor_ID = d.Doctor_ID), 0)
                   as decimal(38,2)) as Total_Revenue
            from doctors d""",
        "view_revenue_analysis": f"""{_CLEAN}
            select Treatment_Type, count(distinct t.Treatment_ID) as Total_Treatments,
              cast(sum(Amount) as decimal(38,2)) as Total_Revenue,
              {_mean_money("Cost", 6, "decimal(38,6)")} as Avg_Treatment_Cost,
              count(*) filter (Payment_Status = 'Paid') as Paid_Count,
              count(*) filter (Payment_Status = 'Pending') as Pending_Count,
              count(*) filter (Payment_Status = 'Failed') as Failed_Count,
              {share} as Payment_Success_Rate
            from treatments t join billing b on b.Treatment_ID = t.Treatment_ID
            group by Treatment_Type""",
        "view_appointment_analysis": f"""{_CLEAN}
            select Appointment_Date, dayname(Appointment_Date) as Day_Name, count(*) as Total_Appointments,
              count(*) filter (Status = 'Completed') as Completed_Count,
              count(*) filter (Status = 'Cancelled') as Cancelled_Count,
              count(*) filter (Status = 'No-show') as No_Show_Count,
              count(*) filter (Status = 'Scheduled') as Scheduled_Count, {rates}
            from appointments group by Appointment_Date""",
    }


def _report_queries() -> dict[str, str]:
    doctors = f"""
        select d.Doctor_ID, {_NAME} as Doctor_Name, Specialization,
          count(distinct Appointment_ID) as Total_Visits, count(distinct Patient_ID) as Total_Patients,
          cast(sum(Amount) as decimal(38,2)) as Total_Revenue"""
    doctor_rank = """, dense_rank() over (order by sum(Amount) desc nulls last) as Revenue_Rank
        from doctors d join chain c on c.Doctor_ID = d.Doctor_ID
        group by d.Doctor_ID, First_Name, Last_Name, Specialization"""
    patients = f"""
        select p.Patient_ID, {_NAME} as Patient_Name, count(distinct Appointment_ID) as Total_Visits,
          count(distinct Treatment_ID) as Total_Treatments, cast(sum(Amount) as decimal(38,2)) as Total_Spending"""
    patient_rank = """, dense_rank() over (order by sum(Amount) desc nulls last) as Spending_Rank"""
    patient_from = """
        from patients p join chain c on c.Patient_ID = p.Patient_ID
        group by p.Patient_ID, First_Name, Last_Name"""
    spend = _rounded(f"sum({_cents('Amount')})", "100 * count(distinct Appointment_ID)", 2, "decimal(10,2)")
    top_patients = f"{_CLEAN} {patients}, {spend} as Average_Spend {patient_rank} {patient_from}"
    segment_average = _rounded(
        "(select sum(Cents) from spending)", "(select 100 * count(Cents) from spending)", 6, "decimal(38,6)"
    )
    retention = f"""{_CLEAN}
        select Patient_ID, {_NAME} as Patient_Name, Appointment_Date,
          lag(Appointment_Date) over visits as Previous_Visit_Date,
          case when lag(Appointment_Date) over visits is null then 'New Patient' else 'Returning Patient' end
            as Patient_Status
        from patients join appointments using (Patient_ID)
        window visits as (partition by Patient_ID order by Appointment_Date nulls first)"""
    growth = _rounded("100 * (Cents - Before)", "Before", 2, "decimal(10,2)")
    age = """cast(date_part('year', date '2026-12-03') - date_part('year', Date_Of_Birth) as integer)
        - case when cast(Date_Of_Birth + to_years(cast(date_part('year', date '2026-12-03')
                    - date_part('year', Date_Of_Birth) as integer)) as date) > date '2026-12-03' then 1 else 0 end"""
    return {
        "report_top_doctors": f"{_CLEAN} {doctors} {doctor_rank}",
        "report_top_patients": top_patients,
        "global_dense_rank": top_patients,
        "report_monthly_revenue": f"""{_CLEAN},
            months as (
              select cast(year(Bill_Date) as integer) as Y, cast(month(Bill_Date) as integer) as M,
                     monthname(Bill_Date) as Name, sum(Amount) as Total, sum({_cents("Amount")}) as Cents
              from billing group by 1, 2, 3),
            ordered as (
              select *, lag(Total) over calendar as Total_Before, lag(Cents) over calendar as Before
              from months window calendar as (order by Y nulls first, M nulls first))
            select Y as Revenue_Year, M as Revenue_Month, Name as Revenue_Month_Name,
              cast(Total as decimal(38,2)) as Total_Revenue,
              cast(Total_Before as decimal(38,2)) as Previous_Month_Revenue,
              cast(Total - Total_Before as decimal(38,2)) as Revenue_Difference, {growth} as Growth_Percentage
            from ordered""",
        "report_patient_retention": retention,
        "retention_in_pieces": retention,
        "report_patient_segmentation": f"""{_CLEAN},
            spending as ({patients}, sum({_cents("Amount")}) as Cents {patient_rank} {patient_from})
            select Patient_ID, Patient_Name, Total_Visits, Total_Treatments, Total_Spending,
              {segment_average} as Avg_Patient_Spending, Spending_Rank,
              case when Total_Visits = 1 then 'One-Time Patient'
                   when Total_Visits >= 3 and Total_Spending > {segment_average} then 'VIP Patient'
                   else 'Regular Patient' end as Patient_Segment
            from spending""",
        "report_doctor_performance": f"""{_CLEAN} {doctors},
            {_mean_money("Cost", 2, "decimal(10,2)")} as Avg_Treatment_Cost {doctor_rank}""",
        "report_treatment_performance": f"""{_CLEAN}
            select Treatment_Type, count(distinct t.Treatment_ID) as Total_Treatments,
              cast(sum(Amount) as decimal(38,2)) as Total_Revenue,
              {_mean_money("Cost", 2, "decimal(10,2)")} as Avg_Treatment_Cost,
              dense_rank() over (order by sum(Amount) desc nulls last) as Revenue_Rank
            from treatments t join billing b on b.Treatment_ID = t.Treatment_ID
            group by Treatment_Type""",
        "report_appointment_status": f"""{_CLEAN}
            select Status, count(*) as Total_Appointments,
              (select count(*) from appointments) as Overall_Appointments,
              {_percent("count(*)", "(select count(*) from appointments)")} as Status_Percentage
            from appointments group by Status""",
        "report_payment_methods": f"""{_CLEAN}
            select Payment_Method, count(*) as Bill_Count, cast(sum(Amount) as decimal(38,2)) as Total_Amount,
              {_percent("count(*)", "(select count(*) from billing)", "decimal(5,1)")} as Pct_Of_Bills
            from billing group by Payment_Method""",
        "report_age_gender": f"""{_CLEAN},
            ages as (select Gender, coalesce({age}, 1000) as Age from patients),
            bands(Lowest, Highest, Label) as (values {_AGE_BANDS})
            select Label as Age_Group, Gender, count(*) as Patient_Count
            from ages join bands on Age between Lowest and Highest group by 1, 2""",
        "report_kpi_summary": f"""{_CLEAN}
            select (select count(*) from patients) as Total_Patients,
              (select count(*) from doctors) as Total_Doctors,
              (select count(*) from appointments) as Total_Appointments,
              (select count(*) from appointments where Status = 'Completed') as Completed_Appointments,
              (select count(*) from appointments where Status = 'No-show') as No_Show_Appointments,
              (select count(*) from appointments where Status = 'Cancelled') as Cancelled_Appointments,
              cast(sum(Amount) as decimal(38,2)) as Total_Revenue_Billed,
              cast(sum(Amount) filter (Payment_Status = 'Paid') as decimal(38,2)) as Total_Revenue_Collected,
              cast(sum(Amount) filter (Payment_Status = 'Pending') as decimal(38,2)) as Total_Revenue_Pending
            from billing""",
    }


def _summary_queries() -> dict[str, str]:
    period = f"""{_CLEAN}
        select date '1997-01-01' as Start_Date, date '1998-06-30' as End_Date, count(Bill_ID) as Total_Bills,
          cast(sum(Amount) as decimal(38,2)) as Total_Revenue,
          {_mean_money("Amount", 6, "decimal(38,6)")} as Average_Bill_Amount,
          max(Amount) as Highest_Bill, min(Amount) as Lowest_Bill
        from billing where Bill_Date >= date '1997-01-01' and Bill_Date <= date '1998-06-30'"""
    return {
        "proc_patient_analysis": f"""{_CLEAN}
            select Patient_ID, {_NAME} as Patient_Name, count(distinct Appointment_ID) as Total_Visits,
              count(distinct Treatment_ID) as Total_Treatments, cast(sum(Amount) as decimal(38,2)) as Total_Paid_Amount,
              max(Appointment_Date) as Last_Visit_Date
            from patients join chain using (Patient_ID) where Patient_ID = '12' group by 1, 2""",
        "proc_doctor_performance": f"""{_CLEAN}
            select Doctor_ID, {_NAME} as Doctor_Name, Specialization, count(distinct Patient_ID) as Total_Patients,
              count(distinct Appointment_ID) as Total_Visits, cast(sum(Amount) as decimal(38,2)) as Total_Revenue,
              {_mean_money("Cost", 6, "decimal(38,6)")} as Avg_Treatment_Cost
            from doctors join chain using (Doctor_ID) where Doctor_ID = '5' group by 1, 2, 3""",
        "proc_revenue_report": period,
        "layout_revenue_report": period,
        "insight_payment_status_share": f"""{_CLEAN}
            select Payment_Status, cast(sum(Amount) as decimal(38,2)) as Total_Amount,
              {_percent(f"sum({_cents('Amount')})", f"(select sum({_cents('Amount')}) from billing)", "decimal(5,1)")}
                as Pct_Of_Billed
            from billing group by Payment_Status""",
        "insight_inactive_patients": f"""{_CLEAN},
            visits as (select Patient_ID, count(Appointment_ID) as N
                       from patients left join appointments using (Patient_ID) group by Patient_ID)
            select count(*) filter (N > 0) as Active_Patients, count(*) filter (N = 0) as Inactive_Patients,
              {_rounded("sum(N)", "count(*) filter (N > 0)", 2, "decimal(10,2)")} as Visits_Per_Active_Patient
            from visits""",
        "insight_specialization_mix": f"{_CLEAN} select Specialization, count(*) as Doctor_Count from doctors group by 1",
        "insight_insurance_mix": f"{_CLEAN} select Insurance_Provider, count(*) as Patient_Count from patients group by 1",
        "insight_gender_mix": f"{_CLEAN} select Gender, count(*) as Patient_Count from patients group by 1",
        "insight_not_reached_rate": f"""{_CLEAN}
            select count(*) filter (Status in ('No-show', 'Cancelled')) as Not_Reached_Appointments,
              {_percent("count(*) filter (Status in ('No-show', 'Cancelled'))", "count(*)")} as Not_Reached_Rate
            from appointments""",
    }


def on_core_tables() -> dict[str, str]:
    """The reporting queries over five tables that already have the names and columns of the core."""
    reporting = _view_queries() | _report_queries() | _summary_queries()
    return {name: sql.replace(_CLEAN, f"with {_CHAIN}") for name, sql in reporting.items()}


def all_queries() -> dict[str, str]:
    own = _load_queries() | _rule_queries() | _view_queries() | _report_queries() | _summary_queries()
    summaries = ("patient_analysis", "doctor_performance", "revenue_report")
    return own | {f"sql_{name}": own[f"proc_{name}"] for name in summaries}
