"""DataFrame operators shared by the plans."""

from landfall.operators.decode import (
    OTHER_STATE,
    decode,
    split_port_label,
    state_labels,
    with_code_class,
)
from landfall.operators.dedupe import distinct_of, first_per_key
from landfall.operators.enrich import NonUniqueKeyError, enrich
from landfall.operators.quality import (
    DEFAULT_RULES,
    DataQualityError,
    TableRule,
    bad_number_report,
    enforce,
    null_key_report,
    quality_report,
    row_count_report,
)
from landfall.operators.shape import rename_columns
from landfall.operators.summarise import sum_by, top

__all__ = [
    "DEFAULT_RULES",
    "DataQualityError",
    "NonUniqueKeyError",
    "OTHER_STATE",
    "TableRule",
    "bad_number_report",
    "decode",
    "distinct_of",
    "enforce",
    "enrich",
    "first_per_key",
    "null_key_report",
    "quality_report",
    "rename_columns",
    "row_count_report",
    "split_port_label",
    "state_labels",
    "sum_by",
    "top",
    "with_code_class",
]
