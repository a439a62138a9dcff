"""Writes that check their rows in the same pass.

Row and null counts are observed while the rows are written, so a check costs no second scan; a broken limit
raises after the write and before the path is handed on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    """Limits that the written rows break; ``rates`` holds what was observed."""

    def __init__(self, broken: list[str], rates: dict) -> None:
        super().__init__("; ".join(broken))
        self.rates = rates


def write_checked(df: DataFrame, write: Callable[[DataFrame], None], limits: dict[str, float] | None = None,
                  rejected: Column | None = None, expected_rows: int | None = None) -> dict:
    """Write ``df`` with ``write`` and return what was observed: ``rows``, ``nulls`` (share per column) and
    ``rejects`` (share of rows where ``rejected`` is true).

    ``limits``: the greatest share of nulls by column name, of rejects under ``"*"``.  ``expected_rows``: the rows the inputs had
    (a union keeps all of them).  A broken limit raises ``CheckFailed``.  No rows: every share is 0."""
    seen = Observation(f"checked-{uuid.uuid4().hex}")
    bad = rejected if rejected is not None else F.lit(False)
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejects"),
                         *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null {c}") for c in df.columns])
    write(watched)
    found = seen.get
    rows = max(found["rows"], 1)
    rates = {"rows": found["rows"], "rejects": found["rejects"] / rows,
             "nulls": {c: found[f"null {c}"] / rows for c in df.columns}}
    broken = []
    for name, most in (limits or {}).items():
        share = rates["rejects"] if name == "*" else rates["nulls"][name]
        if share > most:
            broken.append(f"{'rejects' if name == '*' else 'nulls of ' + name}: {share:.6f} over {most}")
    if expected_rows is not None and expected_rows != found["rows"]:
        broken.append(f"rows: {found['rows']} written, {expected_rows} expected")
    if broken:
        raise CheckFailed(broken, rates)
    return rates
