from starmart.functions.columns import (
    DATE_PARTS,
    date_from_text,
    date_parts,
    double_from_text,
    int_from_text,
    sas_date,
    stay_days,
    title_case,
)

__all__ = [
    "DATE_PARTS",
    "date_from_text",
    "date_parts",
    "double_from_text",
    "int_from_text",
    "sas_date",
    "stay_days",
    "title_case",
]
