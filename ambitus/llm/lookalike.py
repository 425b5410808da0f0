"""One form for texts that look the same but differ in their characters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambitus.session import cut

# Letters of other scripts that are drawn like Latin ones, in the order of their code points.
LOOKALIKES = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ϳ": "j", "Ѕ": "S", "І": "I", "Ј": "J", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "У": "Y", "Х": "X", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d",
    "һ": "h", "ԛ": "q", "ԝ": "w", "Ԛ": "Q", "Ԝ": "W", "ӏ": "l", "Ӏ": "I", "հ": "h", "ո": "n", "ս": "u", "օ": "o", "Օ": "O", "Ս": "U",
    "K": "K", "‐": "-", "‑": "-", "﹣": "-", "﹘": "-",
}
# Ligatures, letter by letter.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
#: Blanks of one character: each counts as a space.
BLANKS = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
#: Characters that are not drawn: soft hyphen, joiners, marks of direction, invisible operators, variation selectors.
INVISIBLE = "[\\u00AD\\u034F\\u061C\\u115F\\u1160\\u17B4\\u17B5\\u180B-\\u180F\\u200B-\\u200F\\u202A-\\u202E\\u2060-\\u206F\\u3164\\uFE00-\\uFE0F\\uFEFF\\uFFA0\\x{E0000}-\\x{E0FFF}]"


def plain_map() -> dict[str, str]:
    """Every one-to-one replacement: full-width forms by rule, blanks, look-alikes."""
    wide = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    return wide | {c: " " for c in BLANKS} | LOOKALIKES


def invisible_chars() -> str:
    """Every character of INVISIBLE."""
    out = []
    for low, high in re.findall(r"\\[ux]\{?([0-9A-F]+)\}?(?:-\\[ux]\{?([0-9A-F]+)\}?)?", INVISIBLE):
        out += map(chr, range(int(low, 16), int(high or low, 16) + 1))
    return "".join(out)


def plain_form(text: Column) -> Column:
    """The text with look-alikes, full-width forms, ligatures and blanks in their plain form and without invisible characters.
    Accents stay as they are: composed and decomposed ones are made equal by the collation."""
    m = plain_map()
    ascii_only = F.octet_length(text) == F.length(text)  # such a text is plain already
    out = F.translate(text, "".join(m) + invisible_chars(), "".join(m.values()))  # one pass; what has no counterpart is dropped
    for a, b in LIGATURES.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(ascii_only, text).otherwise(out)


def skeleton(form: Column) -> Column:
    """A digest that texts equal under the collation share: only the unaccented ASCII letters and digits of the plain form."""
    ascii_only = F.octet_length(form) == F.length(form)
    plain = F.regexp_replace(F.regexp_replace(form, r"[^\p{M}]\p{M}+", ""), r"[^\x00-\x7F]+", "")
    bare = F.translate(F.when(ascii_only, form).otherwise(plain), "".join(chr(c) for c in range(1, 128) if not chr(c).isalnum()), "")
    return F.xxhash64(bare, F.length(bare))


def lookalike_classes(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, class_id, member): one row for each document that looks the same as one of another string.

    class_id is the smallest id of a document of the class; member is a hash of the document's own string, so that documents of
    one class with different members look alike without being equal.  Texts are grouped by their plain form under Spark's
    accent- and case-sensitive UNICODE collation, in SQL; whole texts are only shuffled for documents that share the digest of
    their skeleton with another string.  Null texts, and texts with nothing visible, are in no class; repeated rows count once.
    """
    d = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    shown = d.withColumn("_plain", plain_form(F.col("_text"))).where(F.col("_plain").rlike(r"[^\s\p{C}]"))
    marked = cut(shown.select("_id", F.xxhash64("_text", F.length("_text")).alias("_raw"), skeleton(F.col("_plain")).alias("_skel")))  # the only pass over all texts
    several = marked.groupBy("_skel").agg(F.min("_raw").alias("_lo"), F.max("_raw").alias("_hi")).where(F.col("_lo") != F.col("_hi")).select("_skel")
    cand = marked.join(several, "_skel", "left_semi").select("_id", "_raw").distinct()
    # one row a string: copies never meet in the grouping by whole texts
    firsts = cand.groupBy("_raw").agg(F.min("_id").alias("_first"))
    strings = firsts.join(d.select(F.col("_id").alias("_first"), F.col("_text")), "_first").where(F.xxhash64("_text", F.length("_text")) == F.col("_raw"))
    collated = strings.groupBy("_raw", "_first").agg(F.min("_text").alias("_text")).select("_raw", "_first", F.collate(plain_form(F.col("_text")), "UNICODE").alias("_form"))
    heads = collated.groupBy("_form").agg(F.min("_first").alias("_class"), F.min("_raw").alias("_lo"), F.max("_raw").alias("_hi")).where(F.col("_lo") != F.col("_hi")).select("_form", "_class")
    members = collated.select("_raw", "_form").join(heads, "_form").select("_class", "_raw")
    return cand.join(members, "_raw").select(F.col("_id").alias(doc_id), F.col("_class").alias("class_id"), F.col("_raw").alias("member"))


def lookalike_pairs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id_a, doc_id_b), smaller id first: documents that look the same and are not the same string."""
    c = lookalike_classes(docs, doc_id, text).select(F.col(doc_id).alias("_id"), "class_id", "member")
    a, b = (c.select(F.col("_id").alias(f"{doc_id}_{x}"), "class_id", F.col("member").alias(f"_m{x}")) for x in "ab")
    left, right = F.col(f"{doc_id}_a"), F.col(f"{doc_id}_b")
    return a.join(b, "class_id").where((left < right) & (F.col("_ma") != F.col("_mb"))).select(left, right).distinct()


def canonical_text(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """All rows with a further column ``canonical_text``: the text of the canonical member (the smallest id) of its class, in
    plain form; the plain form of its own text where it looks like no other string; null for a null text."""
    classes = lookalike_classes(docs, doc_id, text).select(F.col(doc_id).alias("_cid"), F.col("class_id").alias("_class")).distinct()
    heads = classes.select("_class").distinct()
    own = docs.select(F.col(doc_id).alias("_class"), plain_form(F.col(text)).alias("_canon")).join(heads, "_class", "left_semi").groupBy("_class").agg(F.min("_canon").alias("_canon"))
    known = classes.join(own, "_class").select("_cid", "_canon")
    out = docs.join(known, docs[doc_id] == known["_cid"], "left")
    return out.withColumn("canonical_text", F.coalesce("_canon", plain_form(F.col(text)))).drop("_cid", "_canon")


