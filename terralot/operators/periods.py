"""Periods of delivery: slices by date with ids moved, and ids that straddle a cut."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def renumbered(id_column: str, offset: int):
    """YYYY-N as YYYY-(N + offset)."""
    parts = F.split(F.col(id_column), "-")
    return F.concat_ws("-", parts[0], (parts[1].cast("long") + F.lit(offset)).cast("string"))


def straddling(lines: DataFrame, cut: str, id_column: str = "id_mutation", date_column: str = "date_mutation") -> DataFrame:
    """Ids with lines on both sides of the cut: a slice with any must stop."""
    before = lines.filter(F.col(date_column) < cut).select(id_column)
    return before.intersect(lines.filter(F.col(date_column) >= cut).select(id_column))


def extract(lines: DataFrame, cut: str, offset: int, id_column: str = "id_mutation", date_column: str = "date_mutation") -> DataFrame:
    """Lines before the cut, with ids moved by `offset`; an error, before anything is written, if an id straddles the cut."""
    first = straddling(lines, cut, id_column, date_column).limit(5).collect()
    if first:
        raise ValueError(f"ids on both sides of {cut}: {[r[0] for r in first]}")
    return lines.filter(F.col(date_column) < cut).withColumn(id_column, renumbered(id_column, offset))
