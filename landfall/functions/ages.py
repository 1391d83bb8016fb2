"""Age bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band names and bounds.
NOT_KNOWN = "NA"
INFANT = "infant"
CHILDREN = "children"
TEENS = "teens"
ADULT = "adult"
ELDERLY = "elderly"


def age_group(age: Column | str, zero_is_infant: bool = False) -> Column:
    """Band of an age in whole years.

    By default age 0 counts as not known, like null, and only negative ages are infants;
    ``zero_is_infant`` puts age 0 with the infants.
    """
    years = F.col(age) if isinstance(age, str) else age
    unknown = years.isNull() if zero_is_infant else (years.isNull() | (years == 0))
    return (
        F.when(unknown, NOT_KNOWN)
        .when(years <= 0, INFANT)
        .when(years <= 12, CHILDREN)
        .when(years <= 18, TEENS)
        .when(years <= 64, ADULT)
        .otherwise(ELDERLY)
    )
