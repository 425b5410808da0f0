"""Text expressions for names, addresses and identifiers."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Street words and their short forms.
STREET_WORDS = {"street": "st", "avenue": "ave", "boulevard": "blvd", "road": "rd", "drive": "dr", "lane": "ln", "parkway": "pkwy", "highway": "hwy", "place": "pl", "court": "ct", "suite": "ste", "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw"}


def normalize(s: Column) -> Column:
    """Hyphens and underscores as blanks, trimmed, lower case."""
    return F.lower(F.trim(F.translate(s, "-_", "  ")))


def normalize_metadata(s: Column) -> Column:
    """As ``normalize``; null for a blank text or the word null."""
    return F.when((F.trim(s) != "") & (F.lower(F.trim(s)) != "null"), normalize(s))


def strip(s: Column) -> Column:
    """Without blanks of any kind at both ends."""
    return F.regexp_replace(s, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def collapse(s: Column) -> Column:
    return F.regexp_replace(F.trim(s), r"\s+", " ")


def base_name(name: Column, query: Column) -> Column:
    return collapse(F.when(F.coalesce(F.trim(name), F.lit("")) != "", name).otherwise(F.coalesce(query, F.lit(""))))


def street_hint(address: Column) -> Column:
    """Street of an address: its first part without the house number; null if nothing is left."""
    hint = collapse(F.regexp_replace(F.split(F.coalesce(address, F.lit("")), ",")[0], r"^\s*\d+[A-Za-z\-]*\s+", ""))
    return F.when(hint != "", hint)


def stable_suffix(key: Column) -> Column:
    k = F.trim(F.coalesce(key, F.lit("")))
    return F.when(k == "", F.lit("id")).otherwise(F.right(k, F.lit(4)))


def tokens_text(s: Column) -> Column:
    """Letters and digits in lower case, everything else as one blank."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(s, F.lit(""))), r"[^\p{L}\p{Nd}]+", " "))


def contains_phrase(text: Column, phrase: Column) -> Column:
    """Whether the words of the phrase follow each other in the text; both as of ``tokens_text``."""
    return F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), phrase, F.lit(" ")))


def contains_words(text: Column, phrase: Column) -> Column:
    """Whether all words of the phrase are in the text, in any order."""
    return F.size(F.array_except(F.split(phrase, " "), F.split(text, " "))) == 0


def street_key(address: Column, country: str = "") -> Column:
    """Comparison key of an address: lower case, punctuation as blanks, country dropped, street words shortened."""
    s = F.regexp_replace(F.lower(F.coalesce(address, F.lit(""))), r"[^a-z0-9]+", " ")
    if country:
        s = F.regexp_replace(s, rf"\b{country.lower()}\s*$", " ")
    for long, short in STREET_WORDS.items():
        s = F.regexp_replace(s, rf"\b{long}\b", short)
    return collapse(s)


def place_hash(*parts: Column) -> Column:
    """First 24 hex digits of the SHA-256 of the parts joined by bars, upper case."""
    return F.upper(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 24))


def xml_escape(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def xml_clean(s: Column) -> Column:
    """Without the characters that XML 1.0 forbids."""
    return F.regexp_replace(s, r"[^\x09\x0A\x0D\x20-\uD7FF\uE000-\uFFFD]", "")


def file_label(s: Column, default: str = "diagnostic") -> Column:
    out = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(s, F.lit(""))), r'[<>:"/\\|?*\x00-\x1f]', "-"), r"\s+", "-")
    return F.when(out == "", F.lit(default)).otherwise(out)


def fill_template(template: Column, query: Column) -> Column:
    """The template with {query} (in any case) replaced, else the query followed by the template."""
    mark = "\x01"
    marked = F.regexp_replace(template, r"(?i)\{query\}", mark)
    return F.trim(F.when(F.contains(marked, F.lit(mark)), F.replace(marked, F.lit(mark), query)).otherwise(F.concat_ws(" ", query, F.trim(template))))


def distinct_ignoring_case(values: Column) -> Column:
    """First of the values that differ in case alone; nulls and blanks left out."""
    v = F.filter(values, lambda x: F.coalesce(F.trim(x), F.lit("")) != "")
    low = F.transform(v, lambda x: F.lower(x))
    return F.filter(v, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)


@F.pandas_udf(T.StringType())
def without_marks(s: pd.Series) -> pd.Series:
    """Without combining marks, lower case, blanks collapsed."""
    return s.map(lambda t: None if t is None else " ".join("".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn").lower().split()))


@F.pandas_udf(T.StringType())
def html_unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else html.unescape(t))


def table_cells(description: Column) -> Column:
    """Key-value pairs of the two-cell rows of an HTML table, as an array of structs (key, value), trimmed, in order."""
    row = r"(?is)<tr>\s*<td>(.*?)</td>\s*<td>(.*?)</td>\s*</tr>"
    keys, values = (F.regexp_extract_all(F.coalesce(description, F.lit("")), F.lit(row), F.lit(i)) for i in (1, 2))
    return F.zip_with(keys, values, lambda k, v: F.struct(F.trim(k).alias("key"), F.trim(v).alias("value")))
