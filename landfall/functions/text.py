"""Text cleanup. A character outside the kept set is dropped, never converted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters each kind of field keeps.
CODE_CHARS = "A-Z0-9"
STATE_CODE_CHARS = "A-Z"
CITY_CHARS = "A-Z,a-z ()0-9"
STATE_CHARS = "A-Za-z 0-9"
ASCII_CHARS = r"\x00-\x7F"


def _keep(text: Column | str, chars: str) -> Column:
    return F.regexp_replace(text, f"[^{chars}]+", "")


def clean_code(text: Column | str) -> Column:
    """Keep capital letters and digits; lower case is dropped, not capitalised."""
    return _keep(text, CODE_CHARS)


def clean_state_code(text: Column | str) -> Column:
    return _keep(text, STATE_CODE_CHARS)


def clean_city_text(text: Column | str) -> Column:
    return _keep(text, CITY_CHARS)


def clean_state_text(text: Column | str) -> Column:
    return _keep(text, STATE_CHARS)


def ascii_only(text: Column | str) -> Column:
    return _keep(text, ASCII_CHARS)


def collapse_spaces(text: Column | str, collapse_all: bool = False) -> Column:
    """Turn each pair of spaces into one, then trim.

    One pass only, so four spaces become two; ``collapse_all`` shrinks every run to one.
    """
    return F.trim(F.regexp_replace(text, " {2,}" if collapse_all else "  ", " "))
