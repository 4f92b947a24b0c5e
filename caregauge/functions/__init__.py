"""Column functions shared by the operators and the measure plans."""

from caregauge.functions.codes import code_columns, icd_version, strip_dots
from caregauge.functions.dates import (
    add_days,
    age_on,
    as_date,
    day_number,
    in_year,
    in_years,
    inside_years,
    year_end,
    year_start,
)
from caregauge.functions.nested import any_of, concat_present

__all__ = [
    "add_days",
    "age_on",
    "any_of",
    "as_date",
    "code_columns",
    "concat_present",
    "day_number",
    "icd_version",
    "in_year",
    "in_years",
    "inside_years",
    "strip_dots",
    "year_end",
    "year_start",
]
