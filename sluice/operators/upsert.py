"""Keyed upsert, last row wins.

Target and batch are reduced together in one aggregate per key: the greatest (from the batch, sequence)
wins, with partial aggregation on the map side, so a hot key costs one row per task and
each input is read once.  A batch row without a sequence has no place in the order and is refused, and
so is (as a unique constraint would) a target with several rows of a key; both raise when
the result is computed, without a job at planning time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _checked(seq: str) -> Column:
    """The sequence column; a null one (or a struct that starts with a null) raises."""
    return F.when(F.col(seq).isNull(), F.raise_error(F.lit(f"null sequence {seq} in batch"))) \
        .otherwise(F.col(seq))


def dedup_last(batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row per key: the one with the greatest ``seq`` (``seq`` must be unique per key and not null)."""
    row = F.struct(*[F.col(c) for c in batch.columns if c not in keys])  # null fields survive max_by
    best = batch.groupBy(*keys).agg(F.max_by(row, _checked(seq)).alias("__row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in batch.columns])


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], seq: str,
           check_target: bool = True) -> DataFrame:
    """Target with the batch applied: per key, the batch's last row (by ``seq``) replaces
    the target row; new keys are inserted; other target rows are kept as they are."""
    columns = target.columns
    rest = [c for c in columns if c not in keys]

    def tagged(df: DataFrame, new: bool, order: Column) -> DataFrame:
        return df.select(*keys, F.struct(F.lit(new).alias("new"), order.alias("seq")).alias("__order"),
                         F.struct(F.lit(True).alias("__set"), *[F.col(c) for c in rest]).alias("__row"))

    old = tagged(target, False, F.lit(None).cast(batch.schema[seq].dataType))
    both = old.unionByName(tagged(batch, True, _checked(seq)))
    best = both.groupBy(*keys).agg(F.max_by("__row", "__order").alias("__row"),
                                   F.count_if(~F.col("__order.new")).alias("__old"))
    out = best.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in columns], "__old")
    if check_target:
        twice = F.raise_error(F.lit(f"duplicate keys {keys} in upsert target"))
        out = out.where(F.when(F.col("__old") > 1, twice.cast("boolean")).otherwise(F.lit(True)))
    return out.drop("__old")
