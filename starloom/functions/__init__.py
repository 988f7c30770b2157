from starloom.functions.dates import calendar_parts, sas_days, sas_to_date
from starloom.functions.missing import is_missing, percentage
from starloom.functions.text import title_case

__all__ = [
    "calendar_parts",
    "is_missing",
    "percentage",
    "sas_days",
    "sas_to_date",
    "title_case",
]
