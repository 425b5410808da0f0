"""Address records that name the same place in different writing."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambitus.session import cut

from .address_parse import ENGLISH, LOCALES, NO_REGION, TOKEN, Address, Gazetteer, Locale, deletes, fold, parse, segments_of, within_one

#: Entries (postcodes, towns, region and country words) of the learned gazetteer that are broadcast: with the deletion index of
#: the towns about 2 KB each at most.  Beyond it the entries that an address may name are joined to it.
MAX_GAZETTEER = 100_000
#: A street word is taken for a typing error of one that is at least this many times as frequent and one edit away.
TYPO_RATIO = 3.0

PARTS = ("number", "name", "street_type", "direction", "town", "region", "zip")


def _fold(c):
    """Folding in SQL for the gazetteer: lower case, blanks joined, the usual accents dropped."""
    accents = "àáâãäåāăąçćčèéêëēěęìíîïīłñńòóôõöøōśšťùúûüūýÿźżž"
    plain = "aaaaaaaaaccceeeeeeeiiiiilnnooooooosstuuuuuyyzzz"
    return F.regexp_replace(F.translate(F.lower(F.trim(c)), accents, plain), r"[\s.]+", " ")


def learn_places(records: DataFrame, locale: Locale = ENGLISH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(zips: zip, town, region), (regions: word, region) and (countries: word) that the records themselves show.

    A postcode belongs to the town and region named with it most often, in address tails ("Town, RG 10000") and in the town,
    region and zip columns, if that is at least twice and two fifths of the times; other spellings are typing errors.  A long
    region name stands for the two-letter one of the postcodes it occurs with, a word after the postcode is a country."""
    t = F.col("text")
    part = lambda g: F.regexp_extract(t, locale.tail, g)
    town, region, zip_, country = locale.groups
    nowhere = F.lit(NO_REGION)
    tails = records.select(_fold(part(town)).alias("town"), (_fold(part(region)) if region else nowhere).alias("region"), part(zip_).alias("zip"), _fold(part(country)).alias("country"))
    columns = records.select(_fold("town").alias("town"), (_fold("region") if region else nowhere).alias("region"), F.trim("zip").alias("zip"), F.lit("").alias("country"))
    seen = tails.unionByName(columns).where((F.col("town") != "") & (F.col("region") != "") & F.col("zip").rlike(r"^\d{5}$") & ~F.col("town").rlike(r"\d"))
    seen = cut(seen.groupBy("town", "region", "zip", "country").agg(F.count("*").alias("n")))
    short = seen.where(F.length("region") == 2).groupBy("zip", "town", "region").agg(F.sum("n").alias("n"))
    best = short.groupBy("zip").agg(F.max_by(F.struct("town", "region"), F.struct("n", "town", "region")).alias("b"), F.max("n").alias("top"), F.sum("n").alias("all"))
    zips = best.where((F.col("top") >= 2) & (F.col("top") >= 0.4 * F.col("all"))).select("zip", "b.town", "b.region")
    known = zips.select("zip", F.col("region").alias("_r"))
    long = seen.where(F.length("region") > 2).groupBy("zip", F.col("region").alias("word")).agg(F.sum("n").alias("n")).join(known, "zip")
    long = long.groupBy("word", "_r").agg(F.sum("n").alias("n"))
    long = long.groupBy("word").agg(F.max_by("_r", F.struct("n", "_r")).alias("region"), F.max("n").alias("top"), F.sum("n").alias("all"))
    regions = long.where((F.col("top") >= 2) & (F.col("top") > 0.5 * F.col("all"))).select("word", "region").unionByName(zips.select(F.col("region").alias("word"), "region").distinct())
    countries = seen.where(F.col("country") != "").groupBy(F.col("country").alias("word")).agg(F.sum("n").alias("n")).where("n >= 2").select("word")
    return zips, regions, countries


def _gazetteer(entries: list) -> Gazetteer:
    """entries: (kind, word, town, regions) of kinds zip, town, region and country."""
    of = {k: [e for e in entries if e["kind"] == k] for k in ("zip", "town", "region", "country")}
    return Gazetteer({e["word"]: tuple(e["regions"]) for e in of["town"]}, {e["word"]: (e["town"], e["regions"][0]) for e in of["zip"]}, {e["word"]: e["regions"][0] for e in of["region"]}, frozenset(e["word"] for e in of["country"]))


def gazetteer_entries(zips: DataFrame, regions: DataFrame, countries: DataFrame) -> DataFrame:
    """(kind, word, town, regions): one row for each postcode, town, region word and country word."""
    none = F.lit(None).cast("string")
    z = zips.select(F.lit("zip").alias("kind"), F.col("zip").alias("word"), "town", F.array("region").alias("regions"))
    t = zips.groupBy("town").agg(F.sort_array(F.collect_set("region")).alias("regions")).select(F.lit("town").alias("kind"), F.col("town").alias("word"), none.alias("town"), "regions")
    r = regions.groupBy("word").agg(F.min("region").alias("region")).select(F.lit("region").alias("kind"), "word", none.alias("town"), F.array("region").alias("regions"))
    c = countries.select(F.lit("country").alias("kind"), "word", none.alias("town"), F.array().cast("array<string>").alias("regions"))
    return z.unionByName(t).unionByName(r).unionByName(c)


def parse_records(records: DataFrame, max_gazetteer: int = MAX_GAZETTEER, locale: Locale = ENGLISH) -> DataFrame:
    """(id, number, name, street_type, direction, town, region, zip) for each record (id, text, town, region, zip); parts that
    the record does not show are ''.

    The gazetteer learned from the records is counted; up to max_gazetteer entries are broadcast, beyond it each record is joined
    to the entries that its words may name.  Both ways give the same parts."""
    id_type = records.schema["id"].dataType
    schema = T.StructType([T.StructField("id", id_type)] + [T.StructField(c, T.StringType()) for c in PARTS])
    entries = cut(gazetteer_entries(*learn_places(records, locale)))
    rows = entries.limit(max_gazetteer + 1).collect()
    if len(rows) > max_gazetteer:
        return _parse_joined(records, entries, schema, locale)
    shared = records.sparkSession.sparkContext.broadcast(_gazetteer(rows))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _parsed(pdf["id"], [parse(x, shared.value, t, r, z, locale) for x, t, r, z in zip(pdf["text"], pdf["town"], pdf["region"], pdf["zip"])])

    return records.select("id", "text", "town", "region", "zip").mapInPandas(run, schema)


def _parse_joined(records: DataFrame, entries: DataFrame, schema: T.StructType, locale: Locale) -> DataFrame:
    """The same with a gazetteer of any size: each distinct text is joined to the entries that its words, or runs of words with
    one character deleted, may name, and parsed with these alone."""
    longest = entries.where("kind = 'town'").agg(F.max(F.size(F.split("word", " ")))).first()[0] or 1
    columns = ["text", "town", "region", "zip"]

    @F.pandas_udf("array<string>")
    def keys(text: pd.Series, town: pd.Series, region: pd.Series, zip_: pd.Series) -> pd.Series:
        return pd.Series([sorted(_keys(*x, longest, locale)) for x in zip(text, town, region, zip_)], dtype=object)

    @F.pandas_udf("array<string>")
    def town_keys(town: pd.Series) -> pd.Series:
        return pd.Series([sorted(deletes(t)) for t in town], dtype=object)

    base = records.select("id", *columns).distinct().withColumn("_row", F.struct("id", *columns))
    wanted = base.select("_row", F.explode(keys(*columns)).alias("_key"))
    entry = F.struct("kind", "word", "town", "regions").alias("_e")
    known = entries.where("kind = 'town'").select(F.explode(town_keys("word")).alias("_key"), entry).unionByName(entries.where("kind <> 'town'").select(F.col("word").alias("_key"), entry))
    hits = wanted.join(known, "_key").groupBy("_row").agg(F.collect_set("_e").alias("_es"))
    rows = base.join(hits, "_row", "left").select("id", *columns, "_es")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, town, region, zip_, es in zip(pdf["text"], pdf["town"], pdf["region"], pdf["zip"], pdf["_es"]):
                gaz = _gazetteer([e.asDict() if hasattr(e, "asDict") else e for e in (es if es is not None else [])])
                out.append(parse(text, gaz, town, region, zip_, locale))
            yield _parsed(pdf["id"], out)

    return rows.mapInPandas(run, schema)


def _keys(text: str | None, town: str | None, region: str | None, zip_: str | None, longest: int, locale: Locale = ENGLISH) -> set[str]:
    """All keys under which a gazetteer entry that the record may name is stored: single words for postcodes, regions and
    countries, runs of up to ``longest`` words for towns, with and without their blanks, and their deletions."""
    out: set[str] = {fold(x or "").strip() for x in (town, region, zip_)}
    whole = " ".join(TOKEN.findall(fold(town or "")))
    out |= {whole} | deletes(whole)
    for words in segments_of(text, locale):
        for n in range(1, longest + 1):
            for i in range(len(words) - n + 1):
                gram = " ".join(words[i : i + n])
                out |= {gram, gram.replace(" ", "")} | (deletes(gram) if n <= 2 else set())
    return out


def _parsed(ids: pd.Series, parts: list[Address]) -> pd.DataFrame:
    return pd.DataFrame({"id": ids.to_numpy(), "number": [a.number for a in parts], "name": [a.name for a in parts], "street_type": [a.street_type for a in parts],
                         "direction": [a.pre or a.post for a in parts], "town": [a.town for a in parts], "region": [a.region for a in parts], "zip": [a.zip for a in parts]})


def _corrections(names: DataFrame, ratio: float, locale: Locale) -> DataFrame:
    """(word, right): typing errors among the words of street names.  names: (name, n)."""
    words = cut(names.select(F.explode(F.split("name", " ")).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n")).where((F.length("word") >= 4) & ~F.col("word").rlike(r"^\d")))

    @F.pandas_udf("array<string>")
    def cut_one(w: pd.Series) -> pd.Series:
        return pd.Series([sorted(deletes(x)) for x in w])

    @F.pandas_udf("boolean")
    def one_edit(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([within_one(x, y) for x, y in zip(a, b)])

    keyed = words.select("word", "n", F.explode(cut_one("word")).alias("key"))
    bad = keyed.where(~F.col("word").isin(*sorted(set(locale.terms.values())), "")).select("key", "word", F.col("n").alias("n0"))
    good = keyed.select("key", F.col("word").alias("right"), F.col("n").alias("n1"))
    pairs = bad.join(good, "key").where((F.col("n1") >= ratio * F.col("n0")) & (F.col("word") != F.col("right"))).select("word", "right", "n1").distinct()
    return pairs.where(one_edit("word", "right")).groupBy("word").agg(F.max_by("right", F.struct("n1", "right")).alias("right"))


def _resolve(combos: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """For each (type, direction) of one number and name, what it stands for: missing parts are filled in if all combinations
    that agree with it also agree with each other."""

    def agree(x, y):
        return all(not p or not q or p == q for p, q in zip(x, y))

    out = []
    for c in combos:
        near = [d for d in combos if agree(c, d)]
        if all(agree(x, y) for i, x in enumerate(near) for y in near[:i]):
            out.append(tuple(next((d[k] for d in sorted(near) if d[k]), "") for k in (0, 1)))
        else:
            out.append(c)
    return out


def address_keys(records: DataFrame, typo_ratio: float = TYPO_RATIO, max_gazetteer: int = MAX_GAZETTEER, locale: str = "en") -> DataFrame:
    """(id, address_key, number, name, town, region): the place each record's address denotes, for the records that name a street.

    records: id, text, and town, region, zip (null where the record has no such column); further columns are ignored.

    locale: en, es, fr or de (``address_parse.LOCALES``); records of several countries are keyed country by country.

    The text is cut into components by dictionaries of the locale: unit, postcode, region, town, country, house number,
    direction, street name, street type; order, case, accents, abbreviations and number words don't matter.  Rules for missing
    components, level by level:

    * town: by its name, within one edit; else by the postcode; a town that is named wins over a contradicting postcode;
      region: by the town, or by the postcode if towns of that name lie in several regions;
    * street name: words one edit away from a word at least typo_ratio times as frequent are corrected;
    * street type and direction: a missing one is filled in from the other records of the same town, number and name, if these
      leave only one possibility; if they leave several, the record stays a place of its own;
    * unit and suite are left aside; a record without house number, street name or town has no key (and no row).

    Null, empty or unreadable texts have no row; a record that comes twice has one.  Columns are matched with records only by
    equal keys, so that a place with very many records is no more work than many places.
    """
    parsed = cut(parse_records(records, max_gazetteer, LOCALES[locale]).where((F.col("number") != "") & (F.col("name") != "") & (F.col("town") != "")).distinct())
    names = parsed.groupBy("name").agg(F.count("*").alias("n"))
    wrong = _corrections(names, typo_ratio, LOCALES[locale])
    words = names.select("name", F.posexplode(F.split("name", " ")).alias("pos", "word")).join(wrong, "word", "left")
    right = words.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("right", "word").alias("w")))).alias("ws"), F.max(F.col("right").isNotNull()).alias("changed"))
    right = right.where("changed").select("name", F.concat_ws(" ", F.transform("ws", lambda x: x["w"])).alias("_right"))
    parsed = parsed.join(right, "name", "left").withColumn("name", F.coalesce("_right", "name")).drop("_right")
    block = ["town", "region", "number", "name"]
    combos = parsed.select(*block, "street_type", "direction").distinct().groupBy(*block).agg(F.sort_array(F.collect_set(F.struct("street_type", "direction"))).alias("combos")).where(F.size("combos") > 1)

    @F.pandas_udf("array<struct<street_type string, direction string, t string, d string>>")
    def resolve(column: pd.Series) -> pd.Series:
        out = []
        for cs in column:
            cs = [(c["street_type"], c["direction"]) for c in cs]
            out.append([{"street_type": a[0], "direction": a[1], "t": b[0], "d": b[1]} for a, b in zip(cs, _resolve(cs))])
        return pd.Series(out)

    filled = combos.select(*block, F.explode(resolve("combos")).alias("x")).select(*block, "x.*")
    out = parsed.join(filled, [*block, "street_type", "direction"], "left")
    key = F.concat_ws("|", "region", "town", "name", F.coalesce("t", "street_type"), F.coalesce("d", "direction"), "number")
    return out.select("id", key.alias("address_key"), "number", "name", "town", "region").distinct()


def same_address_pairs(keys: DataFrame) -> DataFrame:
    """(id_a, id_b), smaller id first: distinct records of one address key."""
    k = keys.select("id", "address_key").distinct()
    a, b = (k.select(F.col("id").alias(f"id_{x}"), "address_key") for x in "ab")
    return a.join(b, "address_key").where(F.col("id_a") < F.col("id_b")).select("id_a", "id_b").distinct()
