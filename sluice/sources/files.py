"""File sources.

* ``read_csv`` – header CSV read as all strings (no inference pass over the data), or
  with a declared schema in PERMISSIVE mode: a field that does not fit its type becomes
  null and the row is kept; ``capture_bad=True`` adds the raw line of such rows.
* ``read_monthly`` – one read over a folder of monthly files (not one read per file),
  filtered by a file-name glob; ``with_file_month`` parses ``yyyy-MM`` from the path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT_COL = "_corrupt_record"


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
             header: bool = True, sep: str = ",", capture_bad: bool = False,
             glob: str | None = None, recursive: bool = False) -> DataFrame:
    """CSV -> DataFrame.  Without ``schema`` every column is a string (names from the
    header, or ``_c0 ..`` without one)."""
    reader = (spark.read.option("header", header).option("sep", sep)
              .option("mode", "PERMISSIVE"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if schema is not None:
        if capture_bad:
            schema = StructType(list(schema.fields) + [StructField(CORRUPT_COL, StringType())])
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", False)
    paths = path if isinstance(path, list) else [path]
    return reader.csv(paths)


def read_monthly(spark: SparkSession, folder: str, pattern: str = "*.csv",
                 schema: StructType | None = None, fmt: str = "csv",
                 header: bool = True) -> DataFrame:
    """All files below ``folder`` whose *file name* matches ``pattern``, as one relation
    with a ``source_file`` column.  Partition inference is off (``recursiveFileLookup``),
    so the month comes from the path through ``with_file_month``."""
    if fmt == "csv":
        df = read_csv(spark, folder, schema=schema, header=header, glob=pattern,
                      recursive=True)
    else:
        reader = (spark.read.format(fmt).option("pathGlobFilter", pattern)
                  .option("recursiveFileLookup", True))
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.load(folder)
    return df.withColumn("source_file", F.col("_metadata.file_path"))


# Fixed value: a year-month in a path, after ``/``, ``_`` or ``=`` and before ``/``, ``.`` or ``_``,
# e.g. ``..._2021-04.parquet`` or ``month=2021-04/`` (not digits inside a part-file UUID).
YEAR_MONTH_IN_PATH = r"[/_=](\d{4})-(\d{2})[/._]"


def with_file_month(df: DataFrame, path_col: str = "source_file") -> DataFrame:
    """Add ``file_year``/``file_month`` parsed from the last ``yyyy-MM`` in the path (null without one)."""
    pattern = r".*" + YEAR_MONTH_IN_PATH
    return (df.withColumn("file_year", F.regexp_extract(path_col, pattern, 1).try_cast("int"))
            .withColumn("file_month", F.regexp_extract(path_col, pattern, 2).try_cast("int")))


def read_drifted(spark: SparkSession, root: str, schema: StructType, renamed: dict[str, str] | None = None,
                 fmt: str = "parquet", recursive: bool = False) -> DataFrame:
    """Files of one set whose schema changed over time, as one relation with the columns of ``schema``.

    ``renamed`` maps older column names to the present one: where a file has only the old column, its values are taken.  Columns that
    a file lacks are null; columns that ``schema`` does not name are dropped; types are cast to those of ``schema``.
    Partition folders of ``root`` stay columns (their values prune files)."""
    reader = spark.read.format(fmt).option("mergeSchema", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    df = reader.load(root)
    present = {c.lower(): c for c in df.columns}
    older: dict[str, list[str]] = {}
    for old, new in (renamed or {}).items():
        older.setdefault(new.lower(), []).append(old.lower())

    def column(field: StructField) -> F.Column:
        names = [present[n] for n in [field.name.lower(), *older.get(field.name.lower(), [])] if n in present]
        found = F.coalesce(*[F.col(f"`{n}`") for n in names]) if names else F.lit(None)
        return found.cast(field.dataType).alias(field.name)
    return df.select(*[column(f) for f in schema.fields])


def empty_like(spark: SparkSession, schema: StructType | DataFrame) -> DataFrame:
    """Empty relation with the given (or borrowed) schema."""
    st = schema.schema if isinstance(schema, DataFrame) else schema
    return spark.createDataFrame([], st)


def with_file_order(df: DataFrame, col: str = "file_seq", load_col: str | None = None) -> DataFrame:
    """Add a sequence that follows the order of rows: the load (``load_col``, a number written by
    ``append_csv``; else the file's modification time), then (file path, split start, position inside the
    split).  Part files have random names, so the path alone does not tell which load is later, and
    Spark packs splits by size, so the partition id alone does not give file order."""
    load = F.col(load_col).cast("bigint") if load_col else F.unix_millis("_metadata.file_modification_time")
    return df.withColumn(col, F.struct(load.alias("load"), F.col("_metadata.file_path").alias("file"),
                                       F.col("_metadata.file_block_start").alias("block"),
                                       F.monotonically_increasing_id().alias("pos")))


def read_reports(spark: SparkSession, folder: str, suffix: str = ".csv") -> dict[str, DataFrame]:
    """Report folders written by ``write_reports`` (``<name>.csv/``) back as
    ``{name: DataFrame}`` – the table name comes from the folder name.  Only the folder
    names are listed on the driver; the rows are read by Spark."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.endswith(suffix):
            out[name[: -len(suffix)]] = read_csv(spark, f"{folder.rstrip('/')}/{name}")
    return out
