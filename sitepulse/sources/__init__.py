"""Reading and writing tables."""

from sitepulse.sources.readers import (
    canonical_names, day_slice, drop_header_rows, jdbc_options, look_back, month_slice,
    promote_header, read_jdbc, read_sheets, read_table, scope,
)
from sitepulse.sources.files import FileIndex
from sitepulse.sources.parts import KeyedTable, PartTable, TicketTable, read_parts, replace_day
from sitepulse.sources.tickets import apply_ticket_changes
from sitepulse.sources.writers import (
    append, current_version, json_records, nested_document, replace_customers, replace_slices,
    replace_table, write_csv, write_json, write_sheets,
)

__all__ = [
    "FileIndex", "KeyedTable", "PartTable", "TicketTable", "append", "apply_ticket_changes", "canonical_names", "current_version", "day_slice",
    "drop_header_rows", "jdbc_options", "json_records", "look_back", "month_slice",
    "nested_document", "promote_header", "read_jdbc", "read_parts", "read_sheets", "read_table",
    "replace_customers", "replace_day", "replace_slices", "replace_table", "scope", "write_csv", "write_json", "write_sheets",
]
