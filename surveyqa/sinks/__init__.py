"""Writing violations, reports, extracts and statements."""

from surveyqa.sinks.files import (
    write_by,
    write_consolidated,
    write_sorted_report,
    write_statements,
)

__all__ = ["write_by", "write_consolidated", "write_sorted_report", "write_statements"]
