from wardline.functions.columns import (
    age_years,
    average,
    full_name,
    money,
    month_name,
    percent,
    quotient,
    weekday_name,
)

__all__ = [
    "age_years",
    "average",
    "full_name",
    "money",
    "month_name",
    "percent",
    "quotient",
    "weekday_name",
]
