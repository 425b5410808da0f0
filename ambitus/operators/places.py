"""Place lists: categories, brand filters, names, search expansion, clean-up joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ambitus.functions import text as X
from ambitus.functions.geo import haversine

from .dedupe import first_wins


def map_categories(records: DataFrame, groups: DataFrame, include: list[str] = ()) -> DataFrame:
    """Adds category_key (the target of the record's category, or its own) and grouped_from; keeps only included targets, all if
    none are named.  groups: source, target."""
    g = groups.select(F.lower(F.trim("source")).alias("_s"), F.lower(F.trim("target")).alias("_t")).where("_s <> ''").dropDuplicates(["_s"])
    own = F.lower(F.trim("category"))
    out = records.join(g, own == F.col("_s"), "left").withColumn("category_key", F.coalesce("_t", own)).withColumn("grouped_from", F.when(F.col("_t") != own, own)).drop("_s", "_t")
    keep = [c.strip().lower() for c in include if c.strip()]
    return out.where(F.col("category_key").isin(*keep)) if keep else out


def with_radius(records: DataFrame, radii: DataFrame, default: float, category: str = "category") -> DataFrame:
    """Adds radius_miles of the record's category (ignoring case), or the default."""
    r = radii.select(F.lower(F.trim("category")).alias("_c"), F.col("radius_miles").alias("_r")).dropDuplicates(["_c"])
    return records.join(r, F.lower(F.trim(category)) == F.col("_c"), "left").withColumn("radius_miles", F.coalesce("_r", F.lit(float(default)))).drop("_c", "_r")


def reject_reason(name: Column, address: Column, types: Column, aliases: Column, keywords: list[str], allowed: list[str]) -> Column:
    """Why a record is rejected, null if it is kept: a keyword in its name or address, then none of the brand's aliases in its
    name (as a phrase, or all words), then no allowed type.  aliases: array of texts; null or empty passes."""
    both = F.concat_ws(" ", F.lower(F.coalesce(name, F.lit(""))), F.lower(F.coalesce(address, F.lit(""))))
    words = F.array(*[F.lit(k.lower()) for k in keywords]) if keywords else F.array().cast("array<string>")
    hit = F.get(F.filter(words, lambda k: F.contains(both, k)), F.lit(0))
    n = X.tokens_text(name)
    known = F.coalesce(F.size(aliases), F.lit(0)) > 0
    brand = F.exists(aliases, lambda a: X.contains_phrase(n, X.tokens_text(a)) | X.contains_words(n, X.tokens_text(a)))
    typed = F.arrays_overlap(F.transform(F.coalesce(types, F.array().cast("array<string>")), lambda t: F.lower(t)), F.array(*[F.lit(a.lower()) for a in allowed]))
    return F.when(hit.isNotNull(), F.concat(F.lit("reject_keyword:"), hit)).when(known & ~F.coalesce(brand, F.lit(False)), F.lit("missing_required_brand_tokens")).when(~F.coalesce(typed, F.lit(False)), F.lit("type_mismatch"))


def normalize_names(records: DataFrame, order: list[Column], category: str = "category", name: str = "name", query: str = "query", place: str = "placeId", address: str = "formattedAddress") -> DataFrame:
    """Adds normalized_name: unique names stay; a name that several records of a category share gets its street, and the end of
    the id where streets are shared or missing as well.  Of several rows with one (id, query, type) only the first is changed."""
    base = X.base_name(F.col(name), F.col(query))
    r = records.withColumn("_base", base)
    hint = X.street_hint(F.col(address))
    r = r.withColumn("_hinted", F.when(hint.isNotNull(), F.concat_ws(" | ", "_base", hint)).otherwise(F.col("_base")))
    r = r.withColumn("_g", F.lower(F.concat_ws("::", category, "_base"))).withColumn("_h", F.lower("_hinted"))
    r = r.withColumn("_k", F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate((place, query, "sourceQueryType"))]))
    # counts and firsts are pre-aggregated and joined back, so that a name or id of very many rows is no window in one task
    shared = r.groupBy("_g", "_h").agg(F.count("*").alias("_m"))
    named = shared.groupBy("_g").agg(F.sum("_m").alias("_n"))
    firsts = r.groupBy("_k").agg(F.min(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("_o"), F.count("*").alias("_c"))
    r = r.withColumn("_own", F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).join(shared, ["_g", "_h"], "left").join(named, "_g", "left").join(firsts, "_k", "left")
    full = F.when(F.col("_n") == 1, F.col("_base")).when(F.col("_m") == 1, F.col("_hinted")).otherwise(F.concat_ws(" | ", "_hinted", X.stable_suffix(F.col(place))))
    return r.withColumn("normalized_name", F.when(F.col("_own") == F.col("_o"), full).otherwise(F.col("_base"))).drop("_base", "_n", "_hinted", "_m", "_g", "_h", "_k", "_own", "_o", "_c")


def audit(judged: DataFrame, group: str = "category") -> DataFrame:
    """(group, raw, kept, rejected) of records with a reason column."""
    return judged.groupBy(group).agg(F.count("*").alias("raw_count"), F.count_if(F.col("reason").isNull()).alias("kept_count"), F.count_if(F.col("reason").isNotNull()).alias("rejected_count"))


def expand_searches(searches: DataFrame, query: str, templates: str) -> DataFrame:
    """(all columns, search, ord): each search as it is and once for each of its templates that is not blank."""
    filled = F.transform(F.filter(F.col(templates), lambda t: F.trim(t) != ""), lambda t: X.fill_template(t, F.col(query)))
    return searches.select("*", F.posexplode(F.concat(F.array(F.trim(query)), F.coalesce(filled, F.array().cast("array<string>")))).alias("ord", "search"))


def join_on_address(left: DataFrame, right: DataFrame, left_address: str, right_address: str, order: list[Column], keep: list[str]) -> DataFrame:
    """left with the first right row (by the order) of the same street key: columns keep, and resolution."""
    r = right.withColumn("_key", X.street_key(F.col(right_address))).where("_key <> ''")
    r = first_wins(r.select("_key", *keep, *[o.alias(f"_o{i}") for i, o in enumerate(order)]), [F.col("_key")], [F.col(f"_o{i}") for i in range(len(order))]).select("_key", *[F.col(c).alias(f"matched_{c}") for c in keep])
    out = left.withColumn("_key", X.street_key(F.col(left_address)))
    return out.join(r, "_key", "left").withColumn("resolution", F.when(F.col(f"matched_{keep[0]}").isNotNull(), F.lit("address_match")).otherwise(F.lit("unresolved"))).drop("_key")


def nearest_parent(children: DataFrame, parents: DataFrame, key: str, by: str, miles: float = 0.5, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """(key, parent, distance_miles): the nearest parent of another key with the same ``by`` value within the distance.  The
    parents come through the cell join on (cell, by), so a ``by`` value with very many rows is spread over its places."""
    from .near import points_near_points

    p = parents.withColumn("_radius", F.lit(float(miles)))
    pairs = points_near_points(children.withColumnRenamed(key, "_child"), p.withColumnRenamed(key, "_parent"), "_child", "_parent", "_radius", lat, lon, by=by)
    a = children.select(F.col(key).alias("_child"), F.col(lat).alias("_la"), F.col(lon).alias("_lo")).dropDuplicates(["_child"])
    b = parents.select(F.col(key).alias("_parent"), F.col(lat).alias("_lb"), F.col(lon).alias("_lob")).dropDuplicates(["_parent"])
    d = pairs.where("_child <> _parent").join(a, "_child").join(b, "_parent").withColumn("distance_miles", haversine("_la", "_lo", "_lb", "_lob"))
    best = d.groupBy("_child").agg(F.min(F.struct(F.col("distance_miles").alias("d"), F.col("_parent").alias("p"))).alias("x"))
    return best.select(F.col("_child").alias(key), F.col("x.p").alias("parent"), F.col("x.d").alias("distance_miles"))
