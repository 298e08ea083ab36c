"""Reading survey tables, control sheets and earlier reports."""

from surveyqa.sources.databases import (
    extract_database,
    jdbc_options,
    list_tables,
    read_jdbc_query,
    read_jdbc_table,
)
from surveyqa.sources.files import (
    count_lines,
    read_group_files,
    read_sheet,
    read_violation_file,
)
from surveyqa.sources.snapshots import load_snapshot, read_table, table_path, write_table

__all__ = [
    "count_lines",
    "extract_database",
    "jdbc_options",
    "list_tables",
    "load_snapshot",
    "read_group_files",
    "read_jdbc_query",
    "read_jdbc_table",
    "read_sheet",
    "read_table",
    "read_violation_file",
    "table_path",
    "write_table",
]
