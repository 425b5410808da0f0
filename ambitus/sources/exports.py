"""Further sources: aggregate map exports, trace events, screenshot lists, registries, and files found by a rough name."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRACE_SCHEMA = "serviceType string, implementationType string, methodName string, outcome string, timestampUtc timestamp, durationMs double, exceptionType string"
SCREENSHOT_SCHEMA = "brand string, location_name string, address string, city string, state string, zip string, status string, source_file string"


def aggregate_rows(documents: DataFrame, text: str) -> DataFrame:
    """(doc, ord, title, address, place_id, latitude, longitude): the places of an aggregate export, which has them at fixed
    paths: rows [0][8][*], and of each row title [1][2] (else [2]), address [1][4], coordinates [1][5][2..3], ids [1][6], path
    [1][7].  Rows without a title, an id or numbers as coordinates are left out; a text that is not JSON gives no rows."""
    rows = documents.select("doc", F.regexp_replace(F.col(text), r"^[^\[]*", "").alias("t"))
    fields = [("ord", T.IntegerType), ("title", T.StringType), ("address", T.StringType), ("place_id", T.StringType), ("latitude", T.DoubleType), ("longitude", T.DoubleType)]
    return rows.mapInPandas(_aggregates, T.StructType([rows.schema["doc"], *[T.StructField(n, t()) for n, t in fields]]))


def _items(x: object, at: int) -> list:
    v = x[at] if isinstance(x, list) and len(x) > at else None
    return v if isinstance(v, list) else []


def _word(x: list, at: int) -> str:
    v = x[at] if len(x) > at else None
    return v.strip() if isinstance(v, str) else ""


def aggregate_places(text: str | None) -> Iterator[tuple[int, str, str, str, float, float]]:
    try:
        body = json.loads(text or "")
    except (ValueError, RecursionError):
        return
    for n, row in enumerate(_items(_items(body, 0), 8)):
        details = _items(row, 1)
        title, at, ids = _word(details, 2) or _word(row if isinstance(row, list) else [], 2), _items(details, 5), _items(details, 6)
        own = _word(details, 7) or (f"{ids[0]}:{ids[1]}" if len(ids) >= 2 else "")
        if len(details) >= 8 and title and own and len(at) >= 4 and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in at[2:4]):
            yield n, title, _word(details, 4), own, float(at[2]), float(at[3])


def _aggregates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["ord", "title", "address", "place_id", "latitude", "longitude"]
    for pdf in batches:
        at, found = [], []
        for k, t in enumerate(pdf["t"]):
            own = list(aggregate_places(t))
            at += [k] * len(own)
            found += own
        out = pd.DataFrame(found, columns=names).astype({"ord": "int32", "title": object, "address": object, "place_id": object, "latitude": "float64", "longitude": "float64"})
        out.insert(0, "doc", pdf["doc"].iloc[at].reset_index(drop=True))
        yield out


def read_traces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema(TRACE_SCHEMA).option("mode", "FAILFAST").json(path)


def trace_summary(traces: DataFrame, files: DataFrame) -> DataFrame:
    """(implementationType, methodName, outcome, hits, source_file): calls of each method by outcome, with the file of the type.

    files: (type, source_file); a type in no file has a null there, one in several the first."""
    of = files.groupBy(F.col("type").alias("_t")).agg(F.min("source_file").alias("source_file"))
    hits = traces.groupBy("implementationType", "methodName", "outcome").agg(F.count("*").alias("hits"))
    return hits.join(of, hits["implementationType"] == of["_t"], "left").drop("_t")


def touched_files(summary: DataFrame) -> DataFrame:
    """The distinct files that any call touched."""
    return summary.where(F.col("source_file").isNotNull()).select("source_file").distinct()


def read_screenshots(spark: SparkSession, path: str) -> DataFrame:
    """The CSV list of places read off screenshots; zip codes stay texts."""
    return spark.read.schema(SCREENSHOT_SCHEMA).option("header", True).option("mode", "FAILFAST").csv(path)


def read_registry(spark: SparkSession, path: str, array: str = "sources") -> DataFrame:
    """The entries of a JSON registry, one row each."""
    return spark.read.option("multiLine", True).json(path).select(F.explode(array).alias("r")).select("r.*")


def rough_name(name: str) -> str:
    """Lower case, without accents and whatever is no ASCII letter or digit."""
    plain = "".join(c for c in unicodedata.normalize("NFD", name) if unicodedata.category(c) != "Mn")
    return re.sub("[^a-z0-9]", "", plain.lower())


def find_file(folder: str, name: str) -> str:
    """The path of the file whose name is the same but for case, accents, blanks and punctuation, the first in order; the
    extension may be missing.  Raises FileNotFoundError if there is none."""
    wanted = rough_name(name)
    for own in sorted(os.listdir(folder)):
        if wanted in (rough_name(own), rough_name(os.path.splitext(own)[0])):
            return os.path.join(folder, own)
    raise FileNotFoundError(f"no file like {name} in {folder}")
