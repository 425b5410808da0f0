"""Mapping freely typed values to a reference list; values that mean no entry are reported."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambitus.session import cut

from .canonical_match import MISSING, ReferenceIndex, head_of, initials_of, keys_of, lookup_keys, words_of

#: Entries of a reference list that is broadcast as one index, about 2 KB each; the index of a longer list is a table.
MAX_INDEXED = 50_000

_MEMO_LIMIT = 500_000
HIT = "entry long, cost double, short boolean, family string, entry_text string"
_NO_HIT = (0, float("inf"), False, None, None)


def missing(value: Column) -> Column:
    """Whether a text is null or one of the spellings of a missing value."""
    bare = F.lower(F.regexp_replace(value, r"^[\s\p{Z}\p{Cf}]+|[\s\p{Z}\p{Cf}]+$", ""))
    return F.coalesce(bare.isin(*sorted(MISSING)), F.lit(True))


def usage(values: DataFrame, value: str, reference: DataFrame, ref_id: str, ref_text: str) -> DataFrame:
    """(ref_id, used): how many rows hold exactly the text of each entry."""
    n = values.groupBy(F.col(value).alias("_text")).agg(F.count("*").alias("_n"))
    ref = reference.select(F.col(ref_id).alias("_id"), F.col(ref_text).alias("_text"))
    return ref.join(n, "_text", "left").groupBy("_id").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("used")).withColumnRenamed("_id", ref_id)


@dataclass
class Reference:
    """A reference list ready for look-ups: one index on every worker, or the same index as tables of families and of keys."""

    max_edits: int
    shared: object = None
    families: DataFrame | None = None
    keys: DataFrame | None = None
    longest: int = 0


def explained(index: ReferenceIndex, value: str | None) -> tuple:
    """(entry, cost, short, family, entry_text) of a typed text; workers keep what they have looked up, since values repeat."""
    memo = index.memo
    if value not in memo:
        if len(memo) >= _MEMO_LIMIT:
            memo.clear()
        entry, cost, short = index.explain(value)
        memo[value] = (entry, cost, short, index.heads.get(entry), index.entries.get(entry)) if entry else _NO_HIT
    return memo[value]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["entry", "cost", "short", "family", "entry_text"]).astype({"entry": "int64", "cost": "float64", "short": "bool", "family": "object", "entry_text": "object"})


def reference_of(reference: DataFrame, ref_id: str, ref_text: str, used: DataFrame | None = None, max_edits: int = 2, max_indexed: int = MAX_INDEXED) -> Reference:
    """The list prepared for ``nearest_entry``.  It is counted first: up to max_indexed entries become one broadcast index.  The
    index of a longer list is a table of deletion keys beside a table of families (entries with the same head).  Which words are
    generic and which initials are shared is found over the whole list either way, so that the answers are the same."""
    ref = reference.select(F.col(ref_id).cast("long").alias("_id"), F.col(ref_text).alias("_text")).where(F.col("_id").isNotNull() & ~missing(F.col("_text")))
    ref = ref.groupBy("_id").agg(F.min("_text").alias("_text"))
    if used is not None:
        ref = ref.join(used.select(F.col(ref_id).cast("long").alias("_id"), F.col("used").alias("_used")), "_id", "left")
    else:
        ref = ref.withColumn("_used", F.lit(0))
    ref = ref.withColumn("_used", F.coalesce(F.col("_used").cast("long"), F.lit(0)))
    rows = ref.limit(max_indexed + 1).collect()
    if len(rows) <= max_indexed:
        index = ReferenceIndex({r["_id"]: r["_text"] for r in rows}, {r["_id"]: r["_used"] for r in rows}, max_edits)
        return Reference(max_edits, ref.sparkSession.sparkContext.broadcast(index))
    return _as_tables(ref, max_edits)


def _as_tables(ref: DataFrame, max_edits: int) -> Reference:
    @F.pandas_udf("words array<string>, initials string")
    def analysed(text: pd.Series) -> pd.DataFrame:
        words = [words_of(t) for t in text]
        return pd.DataFrame({"words": words, "initials": [initials_of(w) for w in words]})

    @F.pandas_udf("string")
    def head(words: pd.Series, generic: pd.Series) -> pd.Series:
        return pd.Series([head_of(list(w), set(g)) for w, g in zip(words, generic)], dtype=object)

    @F.pandas_udf("keys array<string>, longest int")
    def forms(family: pd.Series) -> pd.DataFrame:
        out = []
        for f in family:
            index = _family_index([f], max_edits)
            out.append((sorted({k for x in index.forms for k in keys_of(x, max_edits)}), index.longest))
        return pd.DataFrame(out, columns=["keys", "longest"])

    known = cut(ref.withColumn("_a", analysed("_text")).select("_id", "_text", "_used", F.col("_a.words").alias("_words"), F.col("_a.initials").alias("_initials")))
    word = known.select("_id", F.explode(F.array_distinct("_words")).alias("_w"), F.get("_words", F.lit(0)).alias("_first"))
    generic = word.groupBy("_w").agg(F.min("_first").alias("_lo"), F.max("_first").alias("_hi")).where("_lo <> _hi").select("_w")
    own = word.join(generic, "_w").groupBy("_id").agg(F.sort_array(F.collect_set("_w")).alias("_generic"))
    shared = known.groupBy("_initials").agg(F.count("*").alias("_n")).where("_n > 1").select("_initials", F.lit(True).alias("_shared"))
    none = F.array().cast("array<string>")
    entries = known.join(own, "_id", "left").join(shared, "_initials", "left").withColumn("_generic", F.coalesce("_generic", none))
    entries = entries.withColumn("_head", head("_words", "_generic"))
    one = F.struct(F.col("_id").alias("id"), F.col("_text").alias("text"), F.col("_used").alias("used"), F.col("_generic").alias("generic"), F.when(F.col("_shared"), F.col("_initials")).alias("shared"))
    families = cut(entries.groupBy("_head").agg(F.sort_array(F.collect_list(one)).alias("_family")))
    keyed = cut(families.withColumn("_f", forms("_family")).select("_head", F.col("_f.keys").alias("_keys"), F.col("_f.longest").alias("_longest")))
    longest = keyed.agg(F.max("_longest")).first()[0] or 0
    return Reference(max_edits, None, families, keyed.select("_head", F.explode("_keys").alias("_key")), longest)


def _family_index(families: list, max_edits: int) -> ReferenceIndex:
    rows = [e for f in families for e in f]
    generic = {w for e in rows for w in e["generic"]}
    return ReferenceIndex({e["id"]: e["text"] for e in rows}, {e["id"]: e["used"] for e in rows}, max_edits, generic, {e["shared"] for e in rows if e["shared"] is not None})


def look_up(texts: DataFrame, column: str, reference: Reference) -> DataFrame:
    """(column, hit) for each distinct text: what ``explained`` gives, whichever form the list has.  A null text has no row."""
    t = texts.select(F.col(column).alias("_value")).where(F.col("_value").isNotNull()).distinct()
    if reference.shared is not None:
        return t.select(F.col("_value").alias(column), nearest_entry(F.col("_value"), reference).alias("hit"))
    edits, longest = reference.max_edits, reference.longest

    @F.pandas_udf("array<string>")
    def keys(value: pd.Series) -> pd.Series:
        return pd.Series([sorted(lookup_keys(v, longest, edits)) for v in value], dtype=object)

    @F.pandas_udf(HIT)
    def explain(value: pd.Series, families: pd.Series) -> pd.DataFrame:
        return _frame([explained(_family_index(list(f), edits), v) if f is not None and len(f) else _NO_HIT for v, f in zip(value, families)])

    near = t.select("_value", F.explode(keys("_value")).alias("_key")).join(reference.keys, "_key").select("_value", "_head").distinct()
    with_families = near.join(reference.families, "_head").groupBy("_value").agg(F.collect_list("_family").alias("_families"))
    return t.join(with_families, "_value", "left").select(F.col("_value").alias(column), explain("_value", "_families").alias("hit"))


def nearest_entry(typed: Column, reference: Reference) -> Column:
    """The hit of a typed text as a column, for a list that is broadcast: struct of entry (0 if none is meant), weighted
    distance, short (only the head of a family of entries is named), family (that head) and the entry's text."""
    shared = reference.shared

    @F.pandas_udf(HIT)
    def explain(values: pd.Series) -> pd.DataFrame:
        return _frame([explained(shared.value, v) for v in values])

    return explain(typed)


def with_hits(rows: DataFrame, column: str, reference: Reference, name: str = "hit") -> DataFrame:
    """rows with a further column: the hit of the text in ``column``."""
    if reference.shared is not None:
        return rows.withColumn(name, nearest_entry(F.col(column), reference))
    found = look_up(rows, column, reference).select(F.col(column).alias("_looked"), F.col("hit").alias("_looked_up"))
    none = F.struct(F.lit(0).cast("long").alias("entry"), F.lit(float("inf")).alias("cost"), F.lit(False).alias("short"), F.lit(None).cast("string").alias("family"), F.lit(None).cast("string").alias("entry_text"))
    return rows.join(found, F.col(column) == F.col("_looked"), "left").withColumn(name, F.coalesce("_looked_up", none)).drop("_looked", "_looked_up")


def map_to_reference(values: DataFrame, key: str, value: str, reference: DataFrame, ref_id: str, ref_text: str, fallback: str | None = None, max_edits: int = 2, max_indexed: int = MAX_INDEXED) -> DataFrame:
    """(key, ref_id, cost) for each distinct (key, value) whose value is not exactly the text of an entry.

    The value is looked up in a symmetric-delete dictionary of the list (size checked: broadcast, or joined by deletion key
    beyond max_indexed entries, with the same answers) and the candidates are ranked by weighted Damerau-Levenshtein distance
    and by how often each entry is used in ``values`` as it is written.  A missing value (null, empty, blank, "N/A" and the
    like) is replaced by the fallback column, if one is given.  ref_id is 0 and cost infinite where no entry is meant: these are
    the misses.  An empty list makes every row a miss.  Repeated rows count once; a null key is kept as a key.  Any length of
    text is looked up whole: by its words before the first separator, then by all of them.
    """
    used = usage(values, value, reference, ref_id, ref_text)
    ready = reference_of(reference, ref_id, ref_text, used, max_edits, max_indexed)
    text = F.col(value)
    back = F.col(fallback) if fallback else F.lit(None).cast("string")
    rows = values.select(F.col(key).alias("_key"), text.alias("_value"), F.when(missing(text), back).otherwise(text).alias("_typed")).distinct()
    exact = reference.select(F.col(ref_text).alias("_value")).distinct()
    rows = rows.join(exact, "_value", "left_anti").select("_key", "_typed")
    found = with_hits(rows, "_typed", ready, "_hit")
    return found.select(F.col("_key").alias(key), F.col("_hit.entry").alias(ref_id), F.col("_hit.cost").alias("cost")).distinct()


def misses(values: DataFrame, value: str, reference: DataFrame, ref_id: str, ref_text: str, max_edits: int = 2) -> DataFrame:
    """(value, n): the typed values that mean no entry, with how many rows hold them."""
    counted = values.where(~missing(F.col(value))).groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("n"))
    got = map_to_reference(counted.withColumn("_k", F.col("_v")), "_k", "_v", reference, ref_id, ref_text, None, max_edits)
    return counted.join(got.where(F.col(ref_id) == 0).select(F.col("_k").alias("_v")), "_v").select(F.col("_v").alias(value), "n")


__all__ = ["explained", "look_up", "map_to_reference", "misses", "missing", "nearest_entry", "reference_of", "usage", "with_hits", "words_of"]
