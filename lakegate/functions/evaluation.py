"""Keeping an expensive expression from being evaluated more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that a later filter reads instead of recomputing.

    Catalyst moves a filter below a projection by copying the projected
    expressions into it, once per reference; for parsed JSON that multiplies the
    work. A generator's output cannot be copied, and ``inline`` over a single
    struct yields exactly one row.
    """
    one_row = F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))
    return frame.select("*", F.inline(one_row))
