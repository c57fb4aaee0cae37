"""Columns that are computed once per row, whatever reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns behind a one-row generator.

    The optimizer merges projections and moves filters below them by copying the
    expressions, so an expensive column that is read five times is computed five
    times, and columns built on each other multiply. It does not copy the output of
    a generator. The price: these columns are computed even if nothing reads them.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))
