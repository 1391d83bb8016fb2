"""Labels of coded fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code lists of the arrival form.
MODE_LABELS = {1: "Air", 2: "Sea", 3: "Land", 9: "Not reported"}
VISA_CATEGORY_LABELS = {1: "Business", 2: "Pleasure", 3: "Student"}

# How labels of unusable codes begin, and the class each gets.
LABEL_CLASSES = {
    "INVALID": "invalid",
    "Collapsed": "collapsed",
    "No Country Code": "no_code",
    "No PORT Code": "no_code",
}
VALID_CLASS = "valid"


def _by_value(code: Column | str, labels: dict[int, str]) -> Column:
    key = F.col(code) if isinstance(code, str) else code
    (first, label), *rest = labels.items()
    chain = F.when(key == first, label)
    for value, label in rest:
        chain = chain.when(key == value, label)
    return chain


def decode_mode(code: Column | str) -> Column:
    """Label of a travel mode; null for any other code."""
    return _by_value(code, MODE_LABELS)


def decode_visa_category(code: Column | str) -> Column:
    """Label of a visa category; null for any other code."""
    return _by_value(code, VISA_CATEGORY_LABELS)


def _label_part(label: Column | str, group: int) -> Column:
    # Greedy first group: the split is at the last comma.
    return F.trim(F.regexp_extract(label, r"(?s)^(.*),([^,]*)$", group))


def _has_comma(label: Column | str) -> Column:
    return F.contains(F.col(label) if isinstance(label, str) else label, F.lit(","))


def port_label_city(label: Column | str) -> Column:
    """City part of a port label: all before the last comma, or the whole label."""
    return F.when(_has_comma(label), _label_part(label, 1)).otherwise(F.trim(label))


def port_label_state(label: Column | str) -> Column:
    """State or country part of a port label: all after the last comma, else null."""
    return F.when(_has_comma(label), _label_part(label, 2))


def classify_code(label: Column | str) -> Column:
    """Class of a code by its label: ``valid``, ``invalid``, ``collapsed`` or ``no_code``."""
    text = F.col(label) if isinstance(label, str) else label
    chain = F.when(text.isNull(), None)
    for prefix, name in LABEL_CLASSES.items():
        chain = chain.when(text.startswith(prefix), name)
    return chain.otherwise(VALID_CLASS)
