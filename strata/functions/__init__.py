from strata.functions.keys import row_hash, stratum_id, uniform
from strata.functions.parse import first_int, month_text_date, month_text_year, percent_to_double, to_double
from strata.functions.text import fold_text

__all__ = [
    "first_int",
    "fold_text",
    "month_text_date",
    "month_text_year",
    "percent_to_double",
    "row_hash",
    "stratum_id",
    "to_double",
    "uniform",
]
