"""Nearest features of each category to probe points, and the categories out of reach."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ambitus.functions.geo import MILES_PER_DEGREE, planar_miles
from ambitus.session import cut

#: Features that a first round looks for around a probe, in multiples of k.
FIRST_TIMES_K = 6
#: Each further round looks this many times as far.
WIDER = 4.0


def nearest_per_category(features: DataFrame, probes: DataFrame, k: int, probe_key: str = "probe_id") -> DataFrame:
    """(probe_id, category_key, rank, label, distance_miles, latitude, longitude): the k nearest features of each category.

    features: latitude, longitude, category, label.  Distances are planar (69 miles a degree, longitude shrunk by the probe's
    latitude).  Features are put into square cells of each category's own size, which follows its density; a probe names the cells
    that a circle around it touches, and cells are joined by equality.  Where the circle holds k features, the nearest are among
    them and the probe is done with the category; the others go on with a circle WIDER times as wide, until it spans all features.
    A round keeps k rows for each probe and category before the shuffle.  A category of fewer than k features gives them all.
    Null positions are left out, for probes too; equal distances are told apart by label, then position."""
    spark = features.sparkSession
    f = features.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(F.lower(F.trim("category")).alias("category_key"), "label", F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"))
    p = probes.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(F.col(probe_key).alias("_probe"), F.col("latitude").cast("double").alias("_plat"), F.col("longitude").cast("double").alias("_plon"))
    kinds = f.groupBy("category_key").agg(F.count("*").alias("n"), F.min("latitude").alias("s"), F.max("latitude").alias("t"), F.min("longitude").alias("w"), F.max("longitude").alias("e")).collect()  # one row a category
    far = p.agg(F.min("_plat").alias("s"), F.max("_plat").alias("t"), F.min("_plon").alias("w"), F.max("_plon").alias("e")).first()
    names = []
    for r in kinds if far["s"] is not None else []:
        high, wide = max(r["t"] - r["s"], 1e-6), max(r["e"] - r["w"], 1e-6)
        reach = max(math.sqrt(high * wide * k * FIRST_TIMES_K / (math.pi * r["n"])), 1e-6)
        span = max(abs(r["t"] - far["s"]), abs(far["t"] - r["s"])) + max(abs(r["e"] - far["w"]), abs(far["e"] - r["w"]))
        names.append((r["category_key"], float(reach), float(span), int(min(k, r["n"]))))
    known = F.broadcast(spark.createDataFrame(names, "_kind string, _reach double, _span double, _want int"))  # one row a category
    open_ = cut(p.withColumn("category_key", F.explode(F.array(*[F.lit(n[0]) for n in names]).cast("array<string>"))).join(known, F.col("category_key").eqNullSafe(F.col("_kind"))).drop("_kind"))
    f = f.join(known, F.col("category_key").eqNullSafe(F.col("_kind"))).drop("_kind")
    out, scale = None, 1.0
    while True:
        r = F.least(F.col("_reach") * scale, F.col("_span"))  # degrees of latitude
        cell = lambda x, size: F.floor(x / size).cast("long")
        held = f.select(F.col("category_key").alias("_kind"), "label", "latitude", "longitude", cell(F.col("latitude"), r).alias("_i"), cell(F.col("longitude"), r).alias("_j"))
        # the circle is wider in degrees of longitude; never wider than all features
        wide = F.least(r / F.greatest(F.cos(F.radians("_plat")), F.lit(1e-9)), F.col("_span"))
        spread = open_.withColumn("_i", F.explode(F.sequence(cell(F.col("_plat") - r, r), cell(F.col("_plat") + r, r)))).withColumn("_j", F.explode(F.sequence(cell(F.col("_plon") - wide, r), cell(F.col("_plon") + wide, r))))
        last = F.col("_reach") * scale >= F.col("_span")
        near = spread.join(held.withColumnsRenamed({"_i": "_hi", "_j": "_hj"}), (F.col("_i") == F.col("_hi")) & (F.col("_j") == F.col("_hj")) & F.col("category_key").eqNullSafe(F.col("_kind"))).withColumn("distance_miles", planar_miles("latitude", "longitude", "_plat", "_plon"))
        near = near.where(last | (F.col("distance_miles") <= r * MILES_PER_DEGREE))
        w = Window.partitionBy("_probe", "category_key").orderBy("distance_miles", F.lower("label"), "label", "latitude", "longitude")
        near = cut(near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("_probe", "category_key", "rank", "label", "distance_miles", "latitude", "longitude", "_want"))
        full = near.groupBy("_probe", "category_key", "_want").agg(F.count("*").alias("_got")).where(F.col("_got") >= F.col("_want")).select(F.col("_probe").alias("_p"), F.col("category_key").alias("_kind"))
        same = F.col("_probe").eqNullSafe(F.col("_p")) & F.col("category_key").eqNullSafe(F.col("_kind"))
        done = near.join(full, same, "left_semi").drop("_want")
        out = done if out is None else out.unionByName(done)
        if all(n[1] * scale >= n[2] for n in names):
            return out.withColumnRenamed("_probe", probe_key)
        left = cut(open_.join(full, same, "left_anti"))
        if left.isEmpty():
            return out.withColumnRenamed("_probe", probe_key)
        open_, scale = left, scale * WIDER


def reach(nearest: DataFrame, radius_miles: float, probe_key: str = "probe_id") -> DataFrame:
    """(probe_id, category_key, has_match): whether the nearest feature of a category is within the radius."""
    return nearest.groupBy(probe_key, "category_key").agg((F.min("distance_miles") <= radius_miles).alias("has_match"))


def nested(nearest: DataFrame, radius_miles: float, probe_key: str = "probe_id") -> DataFrame:
    """(probe_id, categories, missing): categories in order, each with its nearest features, and the names of those without a match."""
    one = F.struct("rank", "label", F.round("distance_miles", 6).alias("distance_miles"), "latitude", "longitude")
    by = nearest.groupBy(probe_key, "category_key").agg(F.sort_array(F.collect_list(one)).alias("nearest"), (F.min("distance_miles") <= radius_miles).alias("has_match"))
    out = by.groupBy(probe_key).agg(F.sort_array(F.collect_list(F.struct("category_key", "has_match", "nearest"))).alias("categories"))
    return out.withColumn("missing", F.transform(F.filter("categories", lambda c: ~c["has_match"]), lambda c: c["category_key"]))


def report_lines(found: DataFrame, probes: DataFrame, radius_miles: float, probe_key: str = "probe_id") -> DataFrame:
    """(probe_id, report): the nested result as text: the probe's position and the radius, each category with its nearest features
    (label, miles with three decimals, position), and the categories without a match.  probes: probe_id, latitude, longitude."""
    line = lambda x: F.concat_ws(" | ", x["label"], F.concat(F.format_number(x["distance_miles"], 3), F.lit(" mi")), x["latitude"].cast("string"), x["longitude"].cast("string"))
    blocks = F.transform("categories", lambda c: F.concat(F.lit("["), c["category_key"], F.lit("]\n"), F.array_join(F.transform(c["nearest"], line), "\n"), F.lit("\n")))
    missing = F.when(F.size("missing") > 0, F.concat(F.lit("Missing within radius: "), F.concat_ws(", ", "missing"))).otherwise(F.lit("All categories have at least one point within radius."))
    at = probes.select(F.col(probe_key), F.concat(F.lit("Coordinate: "), F.col("latitude").cast("string"), F.lit(", "), F.col("longitude").cast("string"), F.lit(f"\nRadiusMiles: {radius_miles:g}\n")).alias("_head"))
    return found.join(at, probe_key).select(probe_key, F.concat_ws("\n", "_head", F.array_join(blocks, "\n"), missing).alias("report"))


def assert_reached(nearest: DataFrame, radius_miles: float, probe_key: str = "probe_id") -> None:
    """Raises ValueError naming up to twenty (probe, category) whose nearest feature is out of reach."""
    away = reach(nearest, radius_miles, probe_key).where(~F.col("has_match")).orderBy(probe_key, "category_key").limit(20).collect()
    if away:
        raise ValueError("missing within radius: " + ", ".join(f"{r[probe_key]}: {r['category_key']}" for r in away))
