"""Reading and writing files."""

from landfall.sources import sample_tables
from landfall.sources.files import (
    bad_numbers,
    month_paths,
    read_arrivals,
    read_arrivals_text,
    read_csv,
    read_csv_text,
    read_table,
    typed,
)
from landfall.sources.scratch import scratch_folder
from landfall.sources.sinks import (
    append,
    overwrite,
    write_csv,
    write_partitioned,
)

__all__ = [
    "append",
    "bad_numbers",
    "month_paths",
    "overwrite",
    "read_arrivals",
    "read_arrivals_text",
    "read_csv",
    "read_csv_text",
    "read_table",
    "sample_tables",
    "scratch_folder",
    "typed",
    "write_csv",
    "write_partitioned",
]
