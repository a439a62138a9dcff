"""Writers: CSV report folders, Parquet file sets, per-month partitions, CSV append,
JDBC report refresh."""

from sluice.sinks.files import (append_csv, export_csv, write_parquet, write_monthly_files,
                                write_partitioned, write_reports)
from sluice.sinks.jdbc import load_reports_jdbc
from sluice.sinks.catalog import append_table, create_table, replace_table, reset_table

__all__ = ["append_csv", "export_csv", "write_parquet", "write_monthly_files", "write_partitioned",
           "write_reports", "load_reports_jdbc", "append_table", "create_table",
           "replace_table", "reset_table"]
