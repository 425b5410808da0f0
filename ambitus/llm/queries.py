"""Queries of the operators of this subpackage over the test tables, with their SQL where SQL can express them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambitus.functions.geo import is_position
from ambitus.session import cut, read

from . import addresses, canonical, leakage, linkage, lookalike, mixing, survivor


def address_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text, town, region, zip) of the address records of the three tables."""
    none = F.lit(None).cast("string")
    master, official = (read(spark, sf_dir, t).select(F.col("record_id").alias("id"), F.col("formattedAddress").alias("text"), none.alias("town"), none.alias("region"), none.alias("zip")) for t in ("gyms_master", "official_brand_records"))
    shots = read(spark, sf_dir, "gym_screenshots").select(F.col("record_id").alias("id"), F.col("address").alias("text"), F.col("city").alias("town"), F.col("state").alias("region"), "zip")
    return master.unionByName(official).unionByName(shots)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records with the same address."""
    keys = addresses.address_keys(address_records(spark, sf_dir))
    return addresses.same_address_pairs(keys).select(F.col("id_a").alias("record_id_a"), F.col("id_b").alias("record_id_b"))


def p1_address_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's address key."""
    return addresses.address_keys(address_records(spark, sf_dir)).select(F.col("id").alias("record_id"), "address_key")


def gym_records(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = ("master", "official", "shots")) -> DataFrame:
    """(id, src, brand, name, typed, lat, lon, ext_key, hint) of the gym records of the tables named."""
    none = F.lit(None).cast("string")
    nowhere = F.lit(None).cast("double")
    yes, no = F.lit(True).alias("typed"), F.lit(False).alias("typed")
    each = {
        "master": read(spark, sf_dir, "gyms_master").select(F.col("record_id").alias("id"), F.lit("master").alias("src"), F.col("query").alias("brand"), "name", no, F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("placeId").alias("ext_key"), none.alias("hint")),
        "official": read(spark, sf_dir, "official_brand_records").select(F.col("record_id").alias("id"), F.lit("official").alias("src"), "brand", "name", no, F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), none.alias("ext_key"), F.lower("sourceUrl").alias("hint")),
        "shots": read(spark, sf_dir, "gym_screenshots").select(F.col("record_id").alias("id"), F.lit("shots").alias("src"), "brand", F.col("location_name").alias("name"), yes, nowhere.alias("lat"), nowhere.alias("lon"), none.alias("ext_key"), none.alias("hint")),
    }
    out = each[tables[0]]
    for t in tables[1:]:
        out = out.unionByName(each[t])
    return out


def _placed(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The described records with their places, and the address keys."""
    brands = read(spark, sf_dir, "brand_list")
    used = canonical.usage(read(spark, sf_dir, "gyms_master"), "query", brands, "brand_id", "brand")
    keys = cut(addresses.address_keys(address_records(spark, sf_dir)))
    described = linkage.describe(gym_records(spark, sf_dir, tables), canonical.reference_of(brands, "brand_id", "brand", used))
    return cut(linkage.with_places(described, keys)), keys


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.link(_placed(spark, sf_dir, ("master", "official", "shots"))[0])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records of different tables that are the same gym."""
    return _links(spark, sf_dir).select(F.col("ida").alias("record_id_a"), F.col("idb").alias("record_id_b"))


def p2_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs with the confidence of the label model."""
    return _links(spark, sf_dir).select(F.col("ida").alias("record_id_a"), F.col("idb").alias("record_id_b"), F.round("confidence", 6).alias("confidence"))


def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each linked record once: its gym (the smallest id that links lead to), its number of links and their greatest confidence."""
    links = cut(_links(spark, sf_dir))
    ends = links.select(F.col("ida").alias("id"), "confidence").unionByName(links.select(F.col("idb").alias("id"), "confidence"))
    own = ends.groupBy("id").agg(F.count("*").alias("n_links"), F.round(F.max("confidence"), 6).alias("confidence"))
    return linkage.groups(links).join(own, "id").select(F.col("id").alias("record_id"), F.col("component").alias("gym"), "n_links", "confidence")


def _gyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gyms_master with the gym each record belongs to and what a survivor is judged on."""
    placed, keys = _placed(spark, sf_dir, ("master",))
    gym = linkage.groups(linkage.link(placed, across=False))
    m = read(spark, sf_dir, "gyms_master")
    trust = read(spark, sf_dir, "source_types").select("sourceQueryType", "trust_rank").dropDuplicates(["sourceQueryType"])
    present = lambda c: F.when(~canonical.missing(F.col(c)), F.col(c))
    has_street = keys.select(F.col("id").alias("record_id"), F.lit(True).alias("has_address")).distinct()
    out = m.join(gym.withColumnRenamed("id", "record_id"), "record_id").join(trust, "sourceQueryType", "left").join(has_street, "record_id", "left")
    return out.select(
        "record_id", F.col("component").alias("gym"), present("name").alias("name"), F.when(F.col("has_address"), F.col("formattedAddress")).alias("formattedAddress"), present("query").alias("query"),
        F.coalesce("has_address", F.lit(False)).alias("has_address"), (~canonical.missing(F.col("placeId"))).alias("has_place"), is_position("latitude", "longitude").alias("has_position"),
        (F.coalesce(F.size(F.array_compact("searchNames")), F.lit(0)) > 0).alias("has_names"), "types", "gathered_at", F.col("trust_rank").cast("long").alias("trust_rank"),
    ).distinct()


#: The fields of a gym record: texts, and those that a survivor is judged on.
JUDGED = {"texts": ["name", "formattedAddress", "query"], "filled": ["has_place", "has_address", "has_position", "has_names"], "sets": ["types"], "latest": ["gathered_at"], "lowest": ["trust_rank"]}



def _trust():
    """Votes of a record: more for a more trusted source."""
    return F.lit(1.0) / (F.lit(1.0) + F.coalesce("trust_rank", F.lit(9)))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of gyms with several records, but for the survivor, with the survivor."""
    out = survivor.survivors(_gyms(spark, sf_dir), "gym", "record_id", **JUDGED, weight=_trust())
    return out.where(F.col("record_id") != F.col("survivor")).select("record_id", F.col("survivor").alias("survivor_id")).distinct()


def p4_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each gym's values closest to the consensus of its records."""
    return survivor.merged(_gyms(spark, sf_dir), "gym", "record_id", JUDGED["texts"], _trust())


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose query is no brand as written, with the brand meant, or 0."""
    out = canonical.map_to_reference(read(spark, sf_dir, "gyms_master"), "record_id", "query", read(spark, sf_dir, "brand_list"), "brand_id", "brand", fallback="name")
    return out.select("record_id", "brand_id").distinct()


def p6_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed values that mean no listed brand, with their row counts."""
    return canonical.misses(read(spark, sf_dir, "gyms_master"), "query", read(spark, sf_dir, "brand_list"), "brand_id", "brand")


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.find_leaks(read(spark, sf_dir, "documents"), "doc_id", "text", read(spark, sf_dir, "eval_items"), "item_id", ["prompt", "answer"])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the test items of which they hold twelve consecutive words."""
    return _leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p7_leaked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test items that leaked."""
    return leakage.leaked_items(_leaks(spark, sf_dir), "item_id", "doc_id")


def p7_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document in which something leaked: how many items, the longest run in words and its first word."""
    longest = F.max_by("doc_word", F.struct("n_words", -F.col("doc_word")))
    return _leaks(spark, sf_dir).groupBy("doc_id").agg(F.count_distinct("item_id").alias("n_items"), F.max("n_words").alias("longest"), longest.alias("at_word"))


def p7_clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents that stay after the leaked ones are removed."""
    return leakage.remove_leaked(read(spark, sf_dir, "documents"), _leaks(spark, sf_dir), "doc_id").select("doc_id")


def p8_mix_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the mixture with their copies."""
    return mixing.mix(read(spark, sf_dir, "documents"), "doc_id", "text", "source", read(spark, sf_dir, "mix_targets"))[0]


def p8_mix_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares reached by the mixture."""
    return mixing.mix(read(spark, sf_dir, "documents"), "doc_id", "text", "source", read(spark, sf_dir, "mix_targets"))[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents that look the same and are different strings."""
    return lookalike.lookalike_pairs(read(spark, sf_dir, "documents"), "doc_id", "text")


def p9_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look-alike classes with their number of documents and of different strings."""
    c = lookalike.lookalike_classes(read(spark, sf_dir, "documents"), "doc_id", "text")
    return c.groupBy("class_id").agg(F.count("*").alias("n_docs"), F.count_distinct("member").alias("n_strings"))


def p9_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a digest of its one form: that of the first of the documents that look like it."""
    return lookalike.canonical_text(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text").select("doc_id", F.md5("canonical_text").alias("form_md5"))


QUERIES = {
    "p1_found": p1_found, "p1_address_keys": p1_address_keys, "p2_found": p2_found, "p2_links": p2_links, "p2_records": p2_records, "p4_found": p4_found, "p4_merged": p4_merged, "p6_found": p6_found, "p6_misses": p6_misses, "p7_found": p7_found, "p7_leaked_items": p7_leaked_items, "p7_documents": p7_documents, "p7_clean_documents": p7_clean_documents,
    "p8_mix_rows": p8_mix_rows, "p8_mix_shares": p8_mix_shares, "p9_found": p9_found, "p9_classes": p9_classes, "p9_canonical": p9_canonical,
}


def _invisible_sql() -> str:
    return re.sub(r"\\u([0-9A-Fa-f]{4})", r"\\x{\1}", lookalike.INVISIBLE)


def _plain_sql(col: str, composed: bool = True) -> str:
    m = lookalike.plain_map()
    q = lambda s: "'" + s.replace("'", "''") + "'"
    out = f"translate(regexp_replace({col}, '{_invisible_sql()}', '', 'g'), {q(''.join(m))}, {q(''.join(m.values()))})"
    for a, b in lookalike.LIGATURES.items():
        out = f"replace({out}, '{a}', '{b}')"
    return f"nfc_normalize({out})" if composed else out


_P9 = f"""WITH t AS (SELECT DISTINCT doc_id, text, {_plain_sql("text")} AS form FROM documents WHERE text IS NOT NULL),
v AS (SELECT * FROM t WHERE regexp_matches(form, '[^\\s\\p{{C}}]'))"""
_WORDS = f"""regexp_extract_all(lower({_plain_sql("regexp_replace(regexp_replace(regexp_replace({c}, '</?[a-zA-Z][^<>]*>', '', 'g'), '&nbsp;', ' ', 'g'), '[\\\\][nrt]', ' ', 'g')")}), '[\\p{{L}}\\p{{N}}]+')"""
_P7 = f"""WITH i AS (SELECT item_id, unnest([prompt, answer]) t FROM eval_items),
iw AS (SELECT item_id, {_WORDS.replace("{c}", "t")} w FROM i),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) k FROM iw WHERE len(w) >= 12)),
dw AS (SELECT doc_id, {_WORDS.replace("{c}", "text")} w FROM documents WHERE text IS NOT NULL),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 11], ' ') g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) k FROM dw WHERE len(w) >= 12)),
f AS (SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g))"""
SQL = {
    "p9_found": _P9 + " SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM v a JOIN v b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text",
    "p9_classes": _P9 + " SELECT min(doc_id) AS class_id, count(*) AS n_docs, count(DISTINCT text) AS n_strings FROM v GROUP BY form HAVING count(DISTINCT text) > 1",
    "p9_canonical": f"""WITH t AS (SELECT doc_id, text, {_plain_sql("text", False)} AS plain, {_plain_sql("text")} AS form FROM documents)
SELECT doc_id, md5(CASE WHEN regexp_matches(form, '[^\\s\\p{{C}}]') THEN first_value(plain) OVER (PARTITION BY form ORDER BY doc_id) ELSE plain END) AS form_md5 FROM t""",
    "p7_found": _P7 + " SELECT doc_id, item_id FROM f",
    "p7_clean_documents": _P7 + " SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM f)",
}
