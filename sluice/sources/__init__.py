"""Readers: CSV (all-string, declared, headerless, other separators), monthly file sets,
empty relations, JDBC tables and message streams."""

from sluice.sources.files import (empty_like, read_csv, read_monthly,
                                  read_reports, with_file_month)
from sluice.sources.jdbc import read_table_jdbc

__all__ = ["empty_like", "read_csv", "read_monthly",
           "read_reports", "with_file_month", "read_table_jdbc"]
