from earshot.sources.calendar import calendar, days_spanned
from earshot.sources.checked import Scan, scan_csv, scan_json
from earshot.sources.files import (
    csv_lines,
    csv_record,
    csv_values,
    json_lines,
    json_values,
    merge_plays,
    read_csv_table,
    read_exports,
    read_json_table,
    read_plays,
    read_user_tables,
    reconciled,
    union_by_name,
    write_csv,
    write_plays,
    write_plays_by_user,
)
from earshot.sources.shared import shared_folder

__all__ = [
    "Scan",
    "calendar",
    "csv_lines",
    "csv_record",
    "csv_values",
    "days_spanned",
    "json_lines",
    "json_values",
    "merge_plays",
    "read_csv_table",
    "read_exports",
    "read_json_table",
    "read_plays",
    "read_user_tables",
    "reconciled",
    "scan_csv",
    "scan_json",
    "shared_folder",
    "union_by_name",
    "write_csv",
    "write_plays",
    "write_plays_by_user",
]
