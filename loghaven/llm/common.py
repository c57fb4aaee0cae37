"""Word and hash expressions and small table helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are runs of anything but these ASCII spaces.
SPACES = r"[\x20\x09-\x0D]+"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.array_remove(F.split(text_or_empty(text), SPACES), "")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus))


def same_or_null(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """doc_id, label: one row per labelled id; ids or labels that are null give none, and of
    contradicting labels the lower one counts."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(F.col(column).cast("int")).alias("label"))
    )
