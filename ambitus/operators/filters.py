"""Filters of placemarks and imported places, each with the rows kept, removed and counted."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambitus.functions.text import strip, without_marks
from ambitus.operators.dedupe import first_wins
from ambitus.operators.extract import meta
from ambitus.operators.requests import coordinates, in_bounds


def partition(rows: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, removed); a null condition removes."""
    ok = F.coalesce(keep, F.lit(False))
    return rows.where(ok), rows.where(~ok)


def keep_summary(rows: DataFrame, keep: Column, by: str) -> DataFrame:
    """(by, kept, removed): how many rows of each group a filter keeps."""
    ok = F.coalesce(keep, F.lit(False))
    return rows.groupBy(by).agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("removed"))


def off_street(metadata: Column, existing_only: bool = True) -> Column:
    """Whether a way is off the street, and there already, by its class and state."""
    classes, states = ([F.lower(meta(metadata, f"{p}_{k}")) for p in ("HC", "LC")] for k in ("Class", "Status"))
    off = F.coalesce(classes[0] == "off-street", F.lit(False)) | F.coalesce(classes[1] == "off-street", F.lit(False))
    there = F.coalesce(states[0] == "existing", F.lit(False)) | F.coalesce(states[1] == "existing", F.lit(False))
    return off & there if existing_only else off


def touches(points: Column, lines: Column, polygons: Column, south: float, north: float, west: float, east: float) -> Column:
    """Whether any coordinate of a placemark lies in the closed box."""
    return F.exists(coordinates(points, lines, polygons), lambda c: in_bounds(c["latitude"], c["longitude"], *[F.lit(float(x)) for x in (south, north, west, east)]))


def in_folders(folder: Column, allowed: list[str]) -> Column:
    """Whether the innermost folder of a placemark is one of the allowed ones, ignoring case."""
    return F.lower(F.trim(F.element_at(F.split(folder, "/"), -1))).isin([a.lower() for a in allowed])


def by_source(source: Column, rules: dict[str, Column], default: Column | None = None) -> Column:
    """The condition of the row's own source file; rows of other files by the default (kept)."""
    out = F.when(F.lit(False), F.lit(True))
    for name, condition in rules.items():
        out = out.when(F.lower(source) == name.lower(), condition)
    return F.coalesce(out.otherwise(F.lit(True) if default is None else default), F.lit(False))


def name_contains(word: str, *columns: Column, names: Column | None = None) -> Column:
    """Whether a word occurs in any of the texts or in an array of names, ignoring case."""
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(F.contains(F.lower(c), F.lit(word.lower())), F.lit(False))
    return out if names is None else out | F.coalesce(F.exists(names, lambda n: F.contains(F.lower(n), F.lit(word.lower()))), F.lit(False))


def import_reason(title: Column, query: Column, category: Column, sub_entities: list[str], of_category: str) -> Column:
    """Why an imported row is left out, null if it is not: its title is the brand itself, or names a part of a place."""
    part = F.lower(title).rlike("|".join(re.escape(s.lower()) for s in sub_entities)) if sub_entities else F.lit(False)
    return F.when(F.lower(strip(title)) == F.lower(strip(query)), "brand_header").when((F.lower(category) == of_category) & part, "sub_entity")


def import_candidates(candidates: DataFrame, reason: Column, key: str, order: list[Column]) -> DataFrame:
    """Candidates with their reason; of several kept ones of one key all but the first are duplicate_id."""
    c = candidates.withColumn("reason", reason).withColumn("_row", F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    firsts = first_wins(c.where(F.col("reason").isNull()).select(key, "_row"), [F.col(key)], [F.col("_row")]).select(F.col(key).alias("_k"), F.col("_row").alias("_first"))
    c = c.join(firsts, c[key].eqNullSafe(firsts["_k"]), "left")
    return c.withColumn("reason", F.when(F.col("reason").isNull() & (F.col("_row") != F.col("_first")), F.lit("duplicate_id")).otherwise(F.col("reason"))).drop("_row", "_k", "_first")


def brand_of(title: Column, brands: list[str]) -> Column:
    """The first of the brands with which the title begins, apart from case, accents and blanks; null if none does."""
    plain = without_marks(title)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for b in brands:
        out = out.when(F.startswith(plain, F.lit(b.lower())), F.lit(b))
    return out


def drop_empty_folders(kept: DataFrame, folders: DataFrame) -> DataFrame:
    """The folders (source_file, folder) that still hold a kept placemark, directly or below."""
    paths = kept.select("source_file", F.split("folder", "/").alias("_p")).distinct()
    up = paths.select("source_file", F.explode(F.transform(F.sequence(F.lit(1), F.size("_p")), lambda n: F.array_join(F.slice("_p", 1, n), "/"))).alias("folder")).distinct()
    return folders.join(up, ["source_file", "folder"], "left_semi")
