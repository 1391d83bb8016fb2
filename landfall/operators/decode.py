"""Turning codes into labels with a code table."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions import classify_code, port_label_city, port_label_state
from landfall.operators.enrich import enrich

# State codes of the arrival form, spelled as the form spells them.
STATE_LABELS = {
    "AL": "ALABAMA",
    "AK": "ALASKA",
    "AZ": "ARIZONA",
    "AR": "ARKANSAS",
    "CA": "CALIFORNIA",
    "CO": "COLORADO",
    "CT": "CONNECTICUT",
    "DE": "DELAWARE",
    "DC": "DIST. OF COLUMBIA",
    "FL": "FLORIDA",
    "GA": "GEORGIA",
    "GU": "GUAM",
    "HI": "HAWAII",
    "ID": "IDAHO",
    "IL": "ILLINOIS",
    "IN": "INDIANA",
    "IA": "IOWA",
    "KS": "KANSAS",
    "KY": "KENTUCKY",
    "LA": "LOUISIANA",
    "ME": "MAINE",
    "MD": "MARYLAND",
    "MA": "MASSACHUSETTS",
    "MI": "MICHIGAN",
    "MN": "MINNESOTA",
    "MS": "MISSISSIPPI",
    "MO": "MISSOURI",
    "MT": "MONTANA",
    "NC": "N. CAROLINA",
    "ND": "N. DAKOTA",
    "NE": "NEBRASKA",
    "NV": "NEVADA",
    "NH": "NEW HAMPSHIRE",
    "NJ": "NEW JERSEY",
    "NM": "NEW MEXICO",
    "NY": "NEW YORK",
    "OH": "OHIO",
    "OK": "OKLAHOMA",
    "OR": "OREGON",
    "PA": "PENNSYLVANIA",
    "PR": "PUERTO RICO",
    "RI": "RHODE ISLAND",
    "SC": "S. CAROLINA",
    "SD": "S. DAKOTA",
    "TN": "TENNESSEE",
    "TX": "TEXAS",
    "UT": "UTAH",
    "VT": "VERMONT",
    "VI": "VIRGIN ISLANDS",
    "VA": "VIRGINIA",
    "WV": "W. VIRGINIA",
    "WA": "WASHINGTON",
    "WI": "WISCONSON",
    "WY": "WYOMING",
    "99": "All Other Codes",
}
OTHER_STATE = STATE_LABELS["99"]


def decode(
    df: DataFrame,
    codes: DataFrame,
    code: str,
    out: str,
    code_key: str = "code",
    code_label: str = "label",
    default: str | None = None,
) -> DataFrame:
    """Add the label of column ``code`` as ``out``; codes not in the table get ``default``.

    ``codes`` is any table of unique codes and labels, e.g. the country or the port list.
    """
    labels = codes.select(F.col(code_key).alias("_code"), F.col(code_label).alias(out))
    decoded = enrich(df, labels, code, "_code", [out])
    if default is None:
        return decoded
    return decoded.withColumn(out, F.coalesce(out, F.lit(default)))


def state_labels(spark: SparkSession) -> DataFrame:
    """The state code list as a table; its 55 rows are fixed, so it may be broadcast."""
    listed = F.from_json(F.lit(json.dumps(STATE_LABELS)), "map<string,string>")
    return F.broadcast(spark.range(0, 1, 1, 1).select(F.explode(listed).alias("code", "label")))


def split_port_label(
    df: DataFrame, label: str, city: str = "City", state: str = "State"
) -> DataFrame:
    """Add city and state, read from a port label."""
    return df.withColumns({city: port_label_city(label), state: port_label_state(label)})


def with_code_class(df: DataFrame, label: str | Column, out: str = "code_class") -> DataFrame:
    """Add the class of a code, read from its label."""
    return df.withColumn(out, classify_code(label))
