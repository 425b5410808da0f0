"""Building, judging and cleaning lists of places: configurations, filters by tables of names and words, audits, official lists."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ambitus.functions import text as X
from ambitus.operators.dedupe import first_wins, two_stage
from ambitus.operators.places import expand_searches, normalize_names, reject_reason
from ambitus.operators.requests import InvalidRequest
from ambitus.operators.tiles import tiles


@dataclass
class ListConfig:
    """Bounds, tile steps and groups of searches of a list that is gathered tile by tile."""

    bounds: dict[str, float]
    lat_step: float
    lon_step: float
    groups: list[dict]

    @classmethod
    def from_json(cls, text: str, supported: list[str] = ()) -> ListConfig:
        """Raises InvalidRequest naming all faults.  supported: names a group may have, any if none are given."""
        d = json.loads(text)
        b = d.get("bounds") or {}
        config = cls(b, float(d.get("tileLatitudeStep", 0.05)), float(d.get("tileLongitudeStep", 0.05)), d.get("groups") or [])
        wrong = ["tile steps must be greater than zero"] * (not (config.lat_step > 0 and config.lon_step > 0))
        if not all(k in b for k in ("north", "south", "east", "west")) or b["north"] <= b["south"] or b["east"] <= b["west"]:
            wrong.append("the bounds are empty")
        wrong += ["at least one group of searches is needed"] * (not config.groups)
        for g in config.groups:
            name = (g.get("name") or "").strip()
            wrong += ["a group has no name"] * (not name) + [f"{name}: the mode must be tiled"] * ((g.get("mode") or "tiled").lower() != "tiled")
            wrong += [f"{name}: the group is not supported"] * bool(supported and name and name.lower() not in supported) + [f"{name}: there are no searches"] * (not g.get("searches"))
            wrong += [f"{name}: a search lacks its query or category" for s in g.get("searches") or [] if not (s.get("query") or "").strip() or not (s.get("category") or "").strip()]
        if wrong:
            raise InvalidRequest("; ".join(wrong))
        return config

    def searches(self, spark: SparkSession) -> DataFrame:
        """(group_name, query, category, templates, ord, search): every search and its expansions."""
        rows = [(g["name"], s["query"], s["category"], list((s.get("expansion") or {}).get("templates") or []) if (s.get("expansion") or {}).get("enabled") else []) for g in self.groups for s in g["searches"]]
        return expand_searches(spark.createDataFrame(rows, "group_name string, query string, category string, templates array<string>"), "query", "templates")

    def fetches(self, spark: SparkSession) -> DataFrame:
        """Each search in each tile: what has to be asked of the places service."""
        grid = tiles(spark, self.bounds["north"], self.bounds["south"], self.bounds["west"], self.bounds["east"], self.lat_step, self.lon_step)
        return self.searches(spark).crossJoin(F.broadcast(grid))  # a configured grid


def judge(records: DataFrame, aliases: DataFrame, keywords: DataFrame, allowed: DataFrame) -> DataFrame:
    """Records with a further column reason: null if a record is kept, else why it is not.

    aliases: (query, alias), the names a record found by a query may have; a query without any passes.  keywords: (keyword),
    that must not occur in the name or address, looked for in their order.  allowed: (category, type), of which a record of the
    category must have one; a category without any passes.  Cases are ignored throughout."""
    words = [r[0] for r in keywords.select("keyword").distinct().orderBy("keyword").collect()]  # a configured list
    names = aliases.groupBy(F.lower("query").alias("_q")).agg(F.array_sort(F.collect_set("alias")).alias("_aliases"))
    kinds = allowed.groupBy(F.lower("category").alias("_c")).agg(F.array_sort(F.collect_set(F.lower("type"))).alias("_allowed"))
    r = records.join(names, F.lower("query") == F.col("_q"), "left").join(kinds, F.lower(F.trim("category")) == F.col("_c"), "left")
    reason = reject_reason(F.col("name"), F.col("formattedAddress"), F.col("types"), F.col("_aliases"), words, [])
    own = F.transform(F.coalesce("types", F.array().cast("array<string>")), lambda t: F.lower(t))
    typed = F.col("_allowed").isNull() | F.arrays_overlap(own, F.coalesce("_allowed", F.array().cast("array<string>")))
    reason = F.when(reason != "type_mismatch", reason).when(~F.coalesce(typed, F.lit(False)), F.lit("type_mismatch"))
    return r.withColumn("reason", reason).drop("_q", "_aliases", "_c", "_allowed")


def rejected(judged: DataFrame) -> DataFrame:
    """The records that are not kept, with the reason."""
    return judged.where(F.col("reason").isNotNull()).select("query", "name", "formattedAddress", "sourceQueryType", "placeId", "latitude", "longitude", "reason", "types")


def master_list(judged: DataFrame, order: list[Column]) -> DataFrame:
    """The kept records, de-duplicated in two stages, with normalised names."""
    kept = two_stage(judged.where(F.col("reason").isNull()).drop("reason"), "category", "placeId", "latitude", "longitude", order)
    return normalize_names(kept, order)


def full_audit(judged: DataFrame, final: DataFrame, group: str = "category") -> DataFrame:
    """(group, raw_count, kept_count, rejected_count, final_count, by_query): counts before and after, and the final records of
    each query as an array of structs in the order of the query."""
    g = lambda df: F.lower(F.trim(df[group]))
    raw = judged.groupBy(g(judged).alias("group_name")).agg(F.count("*").alias("raw_count"), F.count_if(F.col("reason").isNull()).alias("kept_count"), F.count_if(F.col("reason").isNotNull()).alias("rejected_count"))
    query = final.groupBy(g(final).alias("group_name"), "query").agg(F.count("*").alias("n"))
    own = query.groupBy("group_name").agg(F.sum("n").alias("final_count"), F.array_sort(F.collect_list(F.struct("query", "n"))).alias("by_query"))
    return raw.join(own, "group_name", "left").withColumn("final_count", F.coalesce("final_count", F.lit(0)))


def plain_text(s: Column) -> Column:
    """Lower case, & as and, everything but ASCII letters and digits as one blank."""
    return F.trim(F.regexp_replace(F.replace(F.lower(F.coalesce(s, F.lit(""))), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def first_word_in(text: Column, words: list[str]) -> Column:
    """The first of the words that the text contains, null if it contains none."""
    return F.get(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w)), F.lit(0)) if words else F.lit(None).cast("string")


def clean(records: DataFrame, aliases: DataFrame, words: DataFrame) -> DataFrame:
    """Records with a further column reason: brand_mismatch if the name has none of the query's aliases (as a phrase, or all
    words), non_club_entity:<word> if it holds a word that the query's places must not have, else null.

    aliases: (query, alias); words: (query, word, ord).  A query without aliases passes the first test."""
    names = aliases.groupBy(F.lower("query").alias("_q")).agg(F.array_sort(F.collect_set(plain_text(F.col("alias")))).alias("_aliases"))
    bad = words.groupBy(F.lower("query").alias("_w")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "word"))), lambda x: x["word"]).alias("_words"))
    r = records.join(names, F.lower("query") == F.col("_q"), "left").join(bad, F.lower("query") == F.col("_w"), "left").withColumn("_n", plain_text(F.col("name")))
    match = F.exists("_aliases", lambda a: X.contains_phrase(F.col("_n"), a) | X.contains_words(F.col("_n"), a))
    hit = F.get(F.filter("_words", lambda w: F.contains(F.col("_n"), w)), F.lit(0))
    return r.withColumn("reason", F.when(F.col("_aliases").isNotNull() & ~match, F.lit("brand_mismatch")).when(hit.isNotNull(), F.concat(F.lit("non_club_entity:"), hit))).drop("_q", "_w", "_aliases", "_words", "_n")


def canonical_score(name: Column, query: Column, types: Column, matches: Column, support: Column) -> Column:
    """How well a record stands for its brand: 100 each for a matching name and for being no support entity, 25 for a type of its
    kind, 10 each for a super market and for the name being the query."""
    own, asked = plain_text(name), plain_text(query)
    typed = F.arrays_overlap(F.coalesce(types, F.array().cast("array<string>")), F.array(*[F.lit(t) for t in ("grocery_store", "supermarket", "gym")]))
    parts = ((matches, 100), (~support, 100), (typed, 25), (F.contains(own, F.lit("super market")), 10), (own == asked, 10))
    out = F.lit(0)
    for condition, n in parts:
        out = out + F.when(F.coalesce(condition, F.lit(False)), n).otherwise(0)
    return out


def without_support(records: DataFrame, support: Column, parents: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): records that are support entities of a nearby parent (see ``places.nearest_parent``) are removed.

    support: whether a record is such an entity; parents: (key, parent, distance_miles)."""
    found = parents.select(F.col(key).alias("_k"), F.col("parent").alias("parent_id"), "distance_miles")
    hit = records.join(found, F.col(key) == F.col("_k"), "left").drop("_k").withColumn("_gone", F.coalesce(support, F.lit(False)) & F.col("parent_id").isNotNull())
    return hit.where(~F.col("_gone")).drop("_gone", "parent_id", "distance_miles"), hit.where("_gone").drop("_gone")


def address_key(address: Column) -> Column:
    """Comparison key of an address with all its rules: ``building X`` and the country dropped, suite words as ste, punctuation
    as blanks, street words shortened."""
    s = F.regexp_replace(F.lower(F.coalesce(address, F.lit(""))), r"\bbuilding\s+[a-z0-9]+\b", "")
    s = F.regexp_replace(s, "[^a-z0-9]+", " ")
    s = F.regexp_replace(F.regexp_replace(s, r"\b(usa|united states)\b", ""), r"\b(suite|ste|unit)\b", " ste ")
    for long, short in X.STREET_WORDS.items():
        if long not in ("lane", "suite"):
            s = F.regexp_replace(s, rf"\b{long}\b", f" {short} ")
    return X.collapse(s)


def official_records(official: DataFrame, legacy: DataFrame, order: list[Column]) -> DataFrame:
    """Official rows as place records: a made-up id, and coordinates of their own, of the first legacy record at the same address,
    or none; resolution says which.

    official: brand, category, name, formattedAddress, sourceUrl, types, latitude, longitude; legacy: formattedAddress, latitude,
    longitude and what the order names."""
    old = legacy.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).withColumn("_key", address_key(F.col("formattedAddress"))).where("_key <> ''")
    old = first_wins(old.select("_key", "latitude", "longitude", *[o.alias(f"_o{i}") for i, o in enumerate(order)]), [F.col("_key")], [F.col(f"_o{i}") for i in range(len(order))])
    old = old.select("_key", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"))
    o = official.withColumn("_key", address_key(F.col("formattedAddress"))).join(old, "_key", "left")
    own = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    link = F.when(F.coalesce(F.col("sourceUrl"), F.lit("")) != "", F.col("sourceUrl")).otherwise(F.coalesce("formattedAddress", F.lit("")))
    return o.select(
        F.col("brand").alias("query"), "category", F.concat_ws("::", F.lit("official"), F.coalesce("brand", F.lit("")), link).alias("placeId"), "name", "formattedAddress",
        F.when(own, F.col("latitude")).otherwise(F.col("_lat")).alias("latitude"), F.when(own, F.col("longitude")).otherwise(F.col("_lon")).alias("longitude"), "types",
        F.lit("official-one-time").alias("sourceQueryType"), F.array("name").alias("searchNames"),
        F.when(own, "official").when(F.col("_lat").isNotNull(), "legacy-address-match").otherwise("unresolved").alias("resolution"),
    )


def before_after(before: DataFrame, after: DataFrame, group: str) -> DataFrame:
    """(group, before_count, after_count, removed_count): sizes of each group in two versions of a list; null groups count."""
    a, b = (d.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("n")) for d in (before, after))
    j = a.withColumnRenamed("n", "_a").join(b.withColumnsRenamed({"n": "_b", "_g": "_h"}), F.col("_g").eqNullSafe(F.col("_h")), "full")
    old, new = F.coalesce("_a", F.lit(0)), F.coalesce("_b", F.lit(0))
    return j.select(F.coalesce("_g", "_h").alias(group), old.alias("before_count"), new.alias("after_count"), (old - new).alias("removed_count"))
