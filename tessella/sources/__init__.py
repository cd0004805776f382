"""Reading postings and writing tables."""

from .tables import (
    normalise_columns,
    read_postings_csv,
    read_postings_json,
    write_metrics,
    write_table,
)

__all__ = [
    "normalise_columns",
    "read_postings_csv",
    "read_postings_json",
    "write_metrics",
    "write_table",
]
