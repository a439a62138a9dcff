"""JSON encode/decode of records carried as message values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def encode_json(*cols: Column | str) -> Column:
    """``{"a": .., "b": ..}`` text of the given columns (field order kept)."""
    return F.to_json(F.struct(*cols))


def decode_json(value: Column | str, schema: StructType | str) -> Column:
    """Parse UTF-8 bytes or text into a struct; malformed input gives a null struct."""
    col = F.col(value) if isinstance(value, str) else value
    return F.from_json(col.cast("string"), schema, {"mode": "PERMISSIVE"})
