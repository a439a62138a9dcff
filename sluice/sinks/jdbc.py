"""Full refresh of report tables in a database over JDBC.

Each report is written with ``mode('overwrite')`` + ``truncate`` (the table and its grants
stay, the rows are replaced) in batches; a failure raises instead of being logged and
skipped.  Needs the JDBC driver on the classpath; nothing here starts a database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def load_reports_jdbc(reports: dict[str, DataFrame], url: str,
                      properties: dict | None = None, batch_size: int = 10_000,
                      write_partitions: int | None = None) -> None:
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    props.setdefault("truncate", "true")
    for name, df in reports.items():
        out = df.coalesce(write_partitions) if write_partitions else df
        out.write.jdbc(url, name, mode="overwrite", properties=props)
