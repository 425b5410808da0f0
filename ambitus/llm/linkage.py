"""Linking records of several tables that describe the same thing, by a label model over heuristic votes."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambitus.functions.geo import haversine, is_position
from ambitus.operators.components import connected_components
from ambitus.operators.near import points_near_points
from ambitus.session import cut

from .address_parse import TYPE_OF
from .canonical import Reference, explained, with_hits
from .canonical_match import LEGAL, SHORT_WORDS, is_missing, words_of
from .label_model import LabelModel

#: Miles between two positions up to which records are compared, up to which the vote is "same", and from which it is "different".
COMPARE_MILES = 0.12
NEAR_MILES = 0.05
FAR_MILES = 0.08
FUNCTIONS = ("brand", "address", "street", "number", "town", "position", "label", "key")
#: Share of each vote (different, none, same) that a function is taken to cast among pairs of one thing and of different things,
#: before anything is learned.  An objection of a function is rare among pairs of one thing.
LEAN_SAME = (0.01, 0.29, 0.70)
LEAN_OTHER = (0.50, 0.30, 0.20)
_FEATURES = ("src", "family", "variant", "short", "label", "akey", "number", "street", "town", "lat", "lon", "ext_key", "hint", "own")


def _unlisted(primary: str | None, other: str | None) -> tuple[str | None, str]:
    """First word of a name that is in no list, and the word after it."""
    family, variant = None, ""
    for text in (primary, other):
        first = [p for p in re.split(r"\s+[-–—|]\s+|[|(,;]", text or "") if p.strip()][:1]
        ws = ["".join(words_of(w)) for w in first[0].split()] if first else []
        ws = [w for w in ws if w and w != "the"]
        if ws:
            family = family or ws[0]
            if ws[0] == family and not variant and len(ws) > 1:
                variant = ws[1]
    return family, variant


@lru_cache(100_000)
def _skipped(brand: str) -> frozenset[str]:
    return frozenset(words_of(brand)) | LEGAL


def _label(name: str | None, brand: str) -> list[str]:
    """Words of a name that tell the branch: without the brand's words, numbers and whatever is a street."""
    text = (name or "").split("|")[0]
    text = re.sub(r"\(([^)]*)\)", lambda m: " " if any(c.isdigit() for c in m[1]) or any(w in TYPE_OF for w in words_of(m[1])) else f" {m[1]} ", text)
    skip = _skipped(brand)
    return sorted({w for w in words_of(text) if SHORT_WORDS.get(w, w) not in skip and w not in skip and not w.isdigit()})


def described_as(brand: str | None, name: str | None, typed: bool, of_brand: tuple, of_name: tuple) -> tuple[str | None, str, bool, list[str]]:
    """(family, variant, short, label) of a record; of_brand and of_name are the hits of its two texts, typed whether the brand
    counts before the name where neither is in the list."""
    no_brand = is_missing(brand)
    entry, _, short, family, text = of_name if no_brand else of_brand
    if not no_brand and (not entry or short):
        if not entry or (of_name[0] and of_name[3] == family and not of_name[2]):
            entry, _, short, family, text = of_name
    if entry:
        return f"={family}", str(entry), bool(short), _label(name, text)
    first, second = _unlisted(brand if is_missing(name) or typed else name, brand)
    if first is None:
        return None, "", False, []
    return f"?{first}", second, not second, _label(name, " ".join(x for x in (first, second, "" if no_brand else brand) if x))


def describe(records: DataFrame, reference: Reference) -> DataFrame:
    """One row an id: records (id, src, brand, name, typed, lat, lon, ext_key, hint) with family, variant, short and label.

    brand is what the record gives as its brand, name what it is called; either may be missing, the first that means an entry of
    the reference list counts.  A brand that is in no list is told by the first two words of its name.  An id given twice with
    different values is described by one of its rows, the smallest; a record that names nothing has no row."""
    columns = ["src", "brand", "name", "typed", "lat", "lon", "ext_key", "hint"]
    r = records.where(F.col("id").isNotNull()).groupBy("id").agg(F.min(F.struct(*columns)).alias("_r")).select("id", "_r.*")
    out = "family string, variant string, short boolean, label array<string>"
    if reference.shared is not None:
        shared = reference.shared

        @F.pandas_udf(out)
        def tell(brand: pd.Series, name: pd.Series, typed: pd.Series) -> pd.DataFrame:
            rows = []
            for b, n, t in zip(brand, name, typed):
                hit = explained(shared.value, b)
                rows.append(described_as(b, n, bool(t), hit, explained(shared.value, n) if not hit[0] or hit[2] else hit))
            return pd.DataFrame(rows, columns=["family", "variant", "short", "label"]).astype({"short": "bool"})

        r = r.withColumn("_t", tell("brand", "name", "typed"))
    else:

        @F.pandas_udf(out)
        def tell_hits(brand: pd.Series, name: pd.Series, typed: pd.Series, of_brand: pd.DataFrame, of_name: pd.DataFrame) -> pd.DataFrame:
            hits = (list(h.itertuples(index=False, name=None)) for h in (of_brand, of_name))
            return pd.DataFrame([described_as(b, n, bool(t), x, y) for b, n, t, x, y in zip(brand, name, typed, *hits)], columns=["family", "variant", "short", "label"]).astype({"short": "bool"})

        r = with_hits(with_hits(r, "brand", reference, "_b"), "name", reference, "_n").withColumn("_t", tell_hits("brand", "name", "typed", "_b", "_n"))
    key = F.when(F.trim("ext_key") != "", F.col("ext_key"))
    key = F.when(~F.lower(F.trim(key)).isin("null", "n/a", "na", "-", "none"), key)
    return r.select("id", "src", "_t.*", "lat", "lon", key.alias("ext_key"), "hint").where(F.col("family").isNotNull())


def with_places(described: DataFrame, addresses: DataFrame) -> DataFrame:
    """Described records with akey, number, street, town and a position, each from the record itself or, where it has none, from
    the records of the same table and external key (if these name one address only) and from the records at the same address.
    own: whether the address is the record's own."""
    a = addresses.groupBy("id").agg(F.min(F.struct(F.col("address_key").alias("akey"), "number", F.col("name").alias("street"), "town")).alias("_a"))
    placed = is_position("lat", "lon")
    d = cut(described.join(a, "id", "left").withColumn("_at", F.when(placed, F.struct("lat", "lon"))).drop("lat", "lon"))  # read several times
    of_key = d.where(F.col("ext_key").isNotNull()).groupBy("src", "ext_key").agg(F.min("_a").alias("_lo"), F.max("_a.akey").alias("_hi"), F.min("_at").alias("_kat"))
    of_key = of_key.select("src", "ext_key", F.when(F.col("_lo.akey") == F.col("_hi"), F.col("_lo")).alias("_ka"), "_kat")
    d = d.join(of_key, ["src", "ext_key"], "left").withColumn("own", F.col("_a").isNotNull())
    d = d.withColumn("_a", F.coalesce("_a", "_ka")).withColumn("_at", F.coalesce("_at", "_kat")).select("id", "src", "family", "variant", "short", "label", "ext_key", "hint", "own", "_a.*", "_at")
    of_address = d.where(F.col("akey").isNotNull() & F.col("_at").isNotNull()).groupBy("akey").agg(F.min("_at").alias("_aat"))
    d = d.join(of_address, "akey", "left").withColumn("_at", F.coalesce("_at", "_aat"))
    return d.select("id", *[F.col("_at")[c].alias(c) if c in ("lat", "lon") else F.col(c) for c in _FEATURES])


def _vote(same: Column, different: Column) -> Column:
    return F.when(F.coalesce(same, F.lit(False)), 1).when(F.coalesce(different, F.lit(False)), -1).otherwise(0)


def vote(pairs: DataFrame) -> DataFrame:
    """Adds one column of votes for each function to pairs of placed records (columns a and b, structs), and miles."""
    a, b = F.col("a"), F.col("b")
    d = haversine(a["lat"], a["lon"], b["lat"], b["lon"])
    placed = a["lat"].isNotNull() & b["lat"].isNotNull()
    towns = F.split(F.concat_ws(" ", a["town"], b["town"]), " ")
    la, lb = (F.array_except(x["label"], towns) for x in (a, b))
    full = ~a["short"] & ~b["short"]
    # an address in a web address: "...-town-number"
    hint = F.coalesce(F.when(a["town"].isNull(), a["hint"]), F.when(b["town"].isNull(), b["hint"]))
    town, number = F.coalesce(a["town"], b["town"]), F.coalesce(a["number"], b["number"])
    tail = F.concat(F.lit("-"), F.regexp_replace(town, " ", "-"), F.lit("-"))
    hinted = hint.isNotNull() & town.isNotNull()
    hinted_number = F.regexp_extract(hint, r"-(\d+)$", 1)
    same_town = (a["town"] == b["town"]) | (hinted & F.contains(hint, tail))
    return (
        pairs.withColumn("brand", _vote((a["variant"] == b["variant"]) & full, (a["variant"] != b["variant"]) & full))
        .withColumn("address", _vote(a["akey"] == b["akey"], a["akey"] != b["akey"]))
        .withColumn("street", _vote(a["street"] == b["street"], a["street"] != b["street"]))
        .withColumn("number", _vote((a["number"] == b["number"]) | (hinted & (hinted_number == number)), (a["number"] != b["number"]) | (hinted & (hinted_number != "") & (hinted_number != number))))
        .withColumn("town", _vote(same_town, (a["town"] != b["town"]) | (hinted & ~F.contains(hint, tail))))
        .withColumn("position", _vote(placed & (d <= NEAR_MILES), placed & (d > FAR_MILES)))
        .withColumn("label", _vote((F.size(la) > 0) & (la == lb), (F.size(la) > 0) & (F.size(lb) > 0) & (la != lb)))
        .withColumn("key", _vote((a["src"] == b["src"]) & (a["ext_key"] == b["ext_key"]), F.lit(False)))
        .withColumn("miles", F.when(placed, d))
    )


def candidates(d: DataFrame, across: bool = True) -> DataFrame:
    """Pairs (ida, idb), smaller id first, that are worth a vote.  d: records with places.

    Records of one family with the same town and house number, whatever the street; of one family and within COMPARE_MILES; of one
    family where a web address ends with the other's town and house number.  All are equi-joins on at least the family and a
    place, so that a brand with very many records is spread over its places.

    across: records of different tables, all of them.  Otherwise records of one table, and then each record is paired with the
    first record of its brand and address and of its external key, not with every other one: their number follows the records."""
    slim = d.select("id", "src", "family", "variant", "short", "akey", "number", "town", "lat", "lon", "ext_key", "hint")
    full = F.col("akey").isNotNull() & ~F.col("short")
    if across:
        a, b = (slim.where(F.col("number").isNotNull()).select(F.col("id").alias(f"id{x}"), F.col("src").alias(f"src{x}"), "family", "town", "number") for x in "ab")
        same = a.join(b, ["family", "town", "number"]).where((F.col("srca") != F.col("srcb")) & (F.col("ida") < F.col("idb"))).select("ida", "idb")
        one_side = slim
    else:
        stars = []
        for rows, keys in ((slim.where(full), ["family", "variant", "akey"]), (slim.where(F.col("ext_key").isNotNull()), ["src", "ext_key"])):
            first = rows.groupBy(*keys).agg(F.min("id").alias("ida"))
            stars.append(rows.select(F.col("id").alias("idb"), *keys).join(first, keys).where("ida < idb").select("ida", "idb"))
        heads = slim.where(full).groupBy("family", "variant", "akey").agg(F.min("id").alias("ida"), F.min("town").alias("town"), F.min("number").alias("number")).drop("variant", "akey")
        free = slim.where(~full & F.col("number").isNotNull()).select(F.col("id").alias("idb"), "family", "town", "number")
        stars.append(heads.join(free, ["family", "town", "number"]).select(F.least("ida", "idb").alias("ida"), F.greatest("ida", "idb").alias("idb")))
        same = stars[0].unionByName(stars[1]).unionByName(stars[2])
        one_side = slim.where(~full)
    at = F.col("lat").isNotNull()
    near = points_near_points(
        slim.where(at).select(F.col("id").alias("p"), "family", "lat", "lon"), one_side.where(at).select(F.col("id").alias("t"), "family", "lat", "lon", F.lit(COMPARE_MILES).alias("radius")), "p", "t", "radius", "lat", "lon", refine=0, by="family"
    )
    src = slim.select("id", "src")
    if across:
        near = near.join(src.withColumnsRenamed({"id": "p", "src": "srcp"}), "p").join(src.withColumnsRenamed({"id": "t", "src": "srct"}), "t").where(F.col("srcp") != F.col("srct"))
    near = near.where(F.col("p") != F.col("t")).select(F.least("p", "t").alias("ida"), F.greatest("p", "t").alias("idb"))
    told = slim.where(F.col("akey").isNull() & F.col("hint").isNotNull()).select(F.col("id").alias("t"), F.col("src").alias("srct"), "family", F.regexp_extract("hint", r"([^-]+)-\d+$", 1).alias("last"), F.regexp_extract("hint", r"-(\d+)$", 1).alias("number"))
    named = slim.where(F.col("akey").isNotNull()).select(F.col("id").alias("p"), "src", "family", F.element_at(F.split("town", " "), -1).alias("last"), "number")
    told = told.join(named, ["family", "last", "number"]).where((F.col("src") != F.col("srct")) if across else (F.col("p") != F.col("t"))).select(F.least("p", "t").alias("ida"), F.greatest("p", "t").alias("idb"))
    return same.unionByName(near).unionByName(told).distinct()


def _posteriors(voted: DataFrame, rounds: int) -> tuple[DataFrame, LabelModel]:
    k = len(FUNCTIONS)
    rows = voted.groupBy(*FUNCTIONS).agg(F.count("*").alias("n")).collect()  # at most 3**8 rows, whatever the data
    votes = np.array([[r[f] for f in FUNCTIONS] for r in rows], dtype=int).reshape(-1, k)
    model = LabelModel(k, rounds, lean=(LEAN_OTHER, LEAN_SAME)).fit(votes, np.array([r["n"] for r in rows]))
    p = model.posterior(votes) if len(rows) else []
    table = voted.sparkSession.createDataFrame([(*map(int, v), float(x)) for v, x in zip(votes, p)], ", ".join(f"{f} int" for f in FUNCTIONS) + ", confidence double")
    return table, model


def voted_pairs(placed: DataFrame, across: bool = True) -> DataFrame:
    """Candidate pairs with their votes, miles, whose address is missing (free) and the address of the other (at)."""
    full = placed.select("id", F.struct(*_FEATURES).alias("x"))
    pairs = candidates(placed, across).join(full.select(F.col("id").alias("ida"), F.col("x").alias("a")), "ida").join(full.select(F.col("id").alias("idb"), F.col("x").alias("b")), "idb")
    lone = F.when(F.col("a.akey").isNull() & F.col("b.akey").isNotNull(), F.col("ida")).when(F.col("b.akey").isNull() & F.col("a.akey").isNotNull(), F.col("idb"))
    return vote(pairs).select("ida", "idb", *FUNCTIONS, "miles", lone.alias("free"), F.when(lone.isNotNull(), F.coalesce("a.akey", "b.akey")).alias("at"))


def scored(voted: DataFrame, rounds: int = 60, confidence: Column | None = None) -> DataFrame:
    """Votes with the model's confidence: the posterior of the pair's pattern of votes.  confidence: a column to put in its place
    (for tests of what the model decides)."""
    table, _ = _posteriors(voted, rounds)
    return voted.join(F.broadcast(table if confidence is None else table.withColumn("confidence", confidence)), list(FUNCTIONS))


def link(placed: DataFrame, across: bool = True, threshold: float = 0.5, rounds: int = 60, confidence: Column | None = None) -> DataFrame:
    """(ida, idb, confidence): pairs of records that are the same thing, smaller id first, with the model's confidence.

    placed: from ``with_places``.  Every candidate pair is voted on by the functions of FUNCTIONS (brand, whole address, street,
    house number, town, position, branch label, external key), each for same, different or nothing.  The label model, fitted to
    the counts of the vote patterns, gives each pattern a posterior; the pairs from the threshold on are links.  Which
    combinations of votes suffice, and which objections outweigh them, is learned.

    A record without an address lies at one address at most: if its links name several, the one of greatest confidence stands,
    then the nearest.  Null ids are left out; an empty table gives no rows."""
    voted = cut(voted_pairs(placed, across))
    links = scored(voted, rounds, confidence).where(F.col("confidence") >= threshold)
    best = links.where(F.col("free").isNotNull()).groupBy("free").agg(F.max_by("at", F.struct(F.round("confidence", 6), F.col("label") + F.col("key"), -F.coalesce("miles", F.lit(9.0)), "at")).alias("_best"))
    links = links.join(best, "free", "left").where(F.col("free").isNull() | (F.col("at") == F.col("_best")))
    return links.select("ida", "idb", "confidence")


def groups(links: DataFrame) -> DataFrame:
    """(id, component): records joined by links, directly or through others; the component is its smallest id."""
    return connected_components(links.select(F.col("ida").alias("a"), F.col("idb").alias("b"))).select(F.col("node").alias("id"), "component")


__all__ = ["FUNCTIONS", "candidates", "describe", "groups", "link", "scored", "vote", "voted_pairs", "with_places"]
