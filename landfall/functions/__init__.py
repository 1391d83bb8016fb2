"""Column expressions. All are built-in Spark functions, so they stay inside code generation."""

from landfall.functions.ages import age_group
from landfall.functions.dates import day_of_month, day_number_to_date, weekday_name
from landfall.functions.labels import (
    classify_code,
    decode_mode,
    decode_visa_category,
    port_label_city,
    port_label_state,
)
from landfall.functions.numbers import bad_number, text_to_double, text_to_int, to_int
from landfall.functions.text import (
    ascii_only,
    clean_city_text,
    clean_code,
    clean_state_code,
    clean_state_text,
    collapse_spaces,
)

__all__ = [
    "age_group",
    "ascii_only",
    "bad_number",
    "classify_code",
    "clean_city_text",
    "clean_code",
    "clean_state_code",
    "clean_state_text",
    "collapse_spaces",
    "day_number_to_date",
    "day_of_month",
    "decode_mode",
    "decode_visa_category",
    "port_label_city",
    "port_label_state",
    "text_to_double",
    "text_to_int",
    "to_int",
    "weekday_name",
]
