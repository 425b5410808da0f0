"""First-wins de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key by the order; null keys are keys like any other.  A minimum per key, pre-aggregated before
    the shuffle, so that a key that very many rows share is no burden."""
    packed = df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(F.struct(*df.columns), F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])).alias("_row"))
    return packed.select("_row.*")


def two_stage(df: DataFrame, category: str, place: str, lat: str, lon: str, order: list[Column]) -> DataFrame:
    """First by category and place id (rows without an id pass), then by category and position, rows without an id first."""
    blank = F.coalesce(F.trim(place), F.lit("")) == ""
    cat = F.lower(F.trim(category))
    named = first_wins(df.where(~blank), [cat, F.lower(place)], order)
    both = df.where(blank).unionByName(named)
    return first_wins(both, [cat, F.col(lat), F.col(lon)], [F.when(blank, 0).otherwise(1), *order])


def thin(df: DataFrame, x: Column, y: Column, spacing: float, order: list[Column]) -> DataFrame:
    """The first row of each square cell."""
    return first_wins(df, [F.floor(x / spacing), F.floor(y / spacing)], order)
