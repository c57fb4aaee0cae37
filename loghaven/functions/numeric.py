"""Rounding that does not depend on the order in which partial sums were added."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int) -> Column:
    """Round half up to ``digits`` as DOUBLE, by way of a twelve-digit decimal.

    Two runs may add the same doubles in a different order and differ in the last
    bit; taking the value to a decimal first keeps such pairs on one side of a tie.
    """
    return F.round(value.cast("double").cast("decimal(30,12)"), digits).cast("double")
