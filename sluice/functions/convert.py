"""Typed conversion of text fields: bad values become null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_to_int(c: Column | str, type_name: str = "int") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(type_name)


def text_to_bool(c: Column | str) -> Column:
    """``'True'``/``'true'`` -> true, any other text -> false, null stays null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.lower(col) == F.lit("true")
