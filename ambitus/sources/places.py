"""Place records from JSON lines, official record files and nested map exports."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACE_SCHEMA = "query string, category string, placeId string, name string, formattedAddress string, latitude double, longitude double, types array<string>, sourceQueryType string, searchNames array<string>"
_TOKEN = re.compile(r'[\[\]{},:]|"(?:[^"\\]|\\.)*"|[^\s\[\]{},:"]+|"', re.S)


def read_places(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Place records; a malformed line fails the read.  Missing searchNames become the name, blank ones are left out."""
    df = spark.read.schema(PLACE_SCHEMA).option("mode", "FAILFAST").json(paths)
    return with_search_names(df)


def with_search_names(df: DataFrame) -> DataFrame:
    named = F.filter("searchNames", lambda x: F.coalesce(F.trim(x), F.lit("")) != "")
    return df.withColumn("searchNames", F.coalesce(named, F.array("name")))


def read_official(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the ``records`` array of a JSON document."""
    return spark.read.option("multiLine", True).json(path).select(F.explode("records").alias("r")).select("r.*")


def harvest(documents: DataFrame, text: str) -> DataFrame:
    """(doc, title, id, latitude, longitude): entries of the shape [title, id, [_, _, latitude, longitude]] anywhere in nested JSON,
    under arrays and objects and however deep; what stands before the first bracket is skipped.  Title and id are texts that are
    not blank, the coordinates numbers.  A text that is not JSON has no entries.  doc is the column ``doc``."""
    rows = documents.select("doc", F.regexp_replace(F.col(text), r"^[^\[]*", "").alias("t"))
    return rows.mapInPandas(_entries, T.StructType([rows.schema["doc"], *[T.StructField(n, t()) for n, t in (("title", T.StringType), ("id", T.StringType), ("latitude", T.DoubleType), ("longitude", T.DoubleType))]]))


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        at, found = [], []
        for k, t in enumerate(pdf["t"]):
            own = list(_visit(_parse(t))) if t else []
            at += [k] * len(own)
            found += own
        out = pd.DataFrame(found, columns=["title", "id", "latitude", "longitude"]).astype({"title": object, "id": object, "latitude": "float64", "longitude": "float64"})
        out.insert(0, "doc", pdf["doc"].iloc[at].reset_index(drop=True))
        yield out


def _visit(root: object) -> Iterator[tuple[str, str, float, float]]:
    open_ = [root]
    while open_:
        x = open_.pop()
        if isinstance(x, list) and len(x) >= 3 and all(isinstance(v, str) and v.strip() for v in x[:2]) and isinstance(x[2], list) and len(x[2]) >= 4:
            lat, lon = x[2][2:4]
            if all(isinstance(v, (int, float)) and not isinstance(v, bool) and abs(v) < 1e300 for v in (lat, lon)):
                yield x[0], x[1], float(lat), float(lon)
        open_ += [v for v in reversed(x) if isinstance(v, (list, tuple))] if isinstance(x, (list, tuple)) else []


def _parse(text: str) -> object:
    """Arrays as lists, objects as tuples of their values (a repeated key keeps each); None if it is not JSON."""
    try:
        return json.loads(text, object_pairs_hook=lambda pairs: tuple(v for _, v in pairs))
    except RecursionError:
        return _parse_deep(text)
    except ValueError:
        return None


def _parse_deep(text: str) -> object:
    """The same without recursion, for texts nested deeper than the parser goes."""
    stack: list[tuple[str, list]] = [("", [])]
    for m in _TOKEN.finditer(text):
        t = m[0]
        if t in "[{":
            stack.append((t, []))
        elif t in "]}":
            kind, own = stack.pop()
            if kind + t not in ("[]", "{}"):
                return None
            stack[-1][1].append(own if kind == "[" else tuple(own))
        elif t == ":":
            if not stack[-1][1]:
                return None
            stack[-1][1].pop()  # the key
        elif t != ",":
            try:
                stack[-1][1].append(json.loads(t))
            except ValueError:
                return None
    return stack[0][1][0] if len(stack) == 1 and len(stack[0][1]) == 1 else None
