"""Column expressions shared by the views, reports and summaries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"


def full_name() -> Column:
    """First and last name with a space; a missing part reads as empty."""
    empty = F.lit("")
    return F.concat(F.coalesce("First_Name", empty), F.lit(" "), F.coalesce("Last_Name", empty))


def money(total: Column) -> Column:
    return total.cast(MONEY)


def quotient(numerator: Column, denominator: Column) -> Column:
    """Division with 14 decimal places, NULL for a zero denominator.

    Spark keeps only 6 places when it divides two wide decimals, and rounding that
    again to 2 places can be off by one cent. The narrower operand types keep enough
    places for the final cast to be the only rounding that matters. ANSI mode raises
    if a value does not fit.
    """
    divisor = denominator.cast("decimal(20,2)")
    return numerator.cast("decimal(24,2)") / F.nullif(divisor, F.lit(0).cast("decimal(20,2)"))


def percent(part: Column, whole: Column, type_: str = "decimal(5,2)") -> Column:
    return quotient(part * 100, whole).cast(type_)


def average(total: Column, count: Column, type_: str = "decimal(38,6)") -> Column:
    return quotient(total, count).cast(type_)


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def age_years(born: Column, as_of: date) -> Column:
    """Completed years on ``as_of``; 29 February counts as 28 February in other years."""
    today = F.lit(as_of)
    years = F.year(today) - F.year(born)
    birthday_to_come = F.add_months(born, years * 12) > today
    return years - F.when(birthday_to_come, 1).otherwise(0)
