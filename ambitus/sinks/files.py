"""Writers of files: JSON lines, texts under their own names, documents with styles, KMZ archives."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambitus.functions.text import xml_escape
from ambitus.sinks.kml import HEAD, TAIL, placemark

# Colours (opacity, blue, green, red) of the two kinds of geometry.
STYLES = {"park": ("ff2e8b57", "7f2e8b57"), "trail": ("ff0055ff", "7f0055ff")}


def camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(w[:1].upper() + w[1:] for w in rest)


def write_json_lines(rows: DataFrame, path: str, by: str | None = None) -> None:
    """Rows as JSON lines with names in camel case; by: a column whose values become folders (one for each brand, say)."""
    out = rows.select(*[F.col(c).alias(c if c == by else camel(c)) for c in rows.columns])
    w = out.write.mode("overwrite")
    (w.partitionBy(by) if by else w).json(path)


def write_named(documents: DataFrame, name: str, text: str, folder: str) -> DataFrame:
    """(name, bytes): each text written to a file of its own name under a folder that all executors share, from the tasks that
    hold them; a file is written beside its place and moved there, so that a task that runs twice leaves it whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for pdf in batches:
            sizes = []
            for n, t in zip(pdf["name"], pdf["text"]):
                body = t if isinstance(t, bytes) else (t or "").encode()
                path = os.path.join(folder, os.path.basename(n))
                with open(f"{path}.{os.getpid()}.tmp", "wb") as f:
                    f.write(body)
                os.replace(f.name, path)
                sizes.append(len(body))
            yield pd.DataFrame({"name": pdf["name"], "bytes": pd.Series(sizes, dtype="int64")})

    return documents.select(F.col(name).alias("name"), F.col(text).alias("text")).mapInPandas(run, "name string, bytes long")


def styled_documents(features: DataFrame, key: str) -> DataFrame:
    """(key, document): original geometries, a folder of parks and one of trails, each in the order of its names ignoring case,
    with a style each; polygons keep their holes.  features: key, category, label, lines, polygons.

    A document is one text by its format; the key (source file, area, tile) keeps it within bounds."""
    label = F.coalesce("label", F.lit(""))
    marks = F.concat(
        F.transform("polygons", lambda q: placemark(label, q[0], F.lit("polygon"), F.slice(q, 2, F.greatest(F.size(q) - 1, F.lit(0))))),
        F.transform("lines", lambda x: placemark(label, x, F.lit("linestring"))),
    )
    rows = features.where(F.lower("category").isin(*STYLES)).select(F.col(key).alias("_k"), F.lower("category").alias("_c"), F.lower(label).alias("_l"), F.array_join(marks, "").alias("_x"))
    rows = rows.withColumn("_x", F.replace("_x", F.lit("</name>"), F.concat(F.lit("</name><styleUrl>#"), "_c", F.lit("</styleUrl>"))))
    folder = rows.groupBy("_k", "_c").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_l", "_x"))), lambda r: r["_x"]), "").alias("_x"))
    folder = folder.withColumn("_x", F.concat(F.lit("<Folder><name>"), xml_escape(F.initcap("_c")), F.lit("s</name>"), "_x", F.lit("</Folder>")))
    style = "".join(f'<Style id="{k}"><LineStyle><color>{line}</color><width>2</width></LineStyle><PolyStyle><color>{area}</color></PolyStyle></Style>' for k, (line, area) in STYLES.items())
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_c", "_x"))), lambda r: r["_x"]), "")
    return folder.groupBy("_k").agg(F.concat(F.lit(HEAD + style), body, F.lit(TAIL)).alias("document")).withColumnRenamed("_k", key)


def rewrite_kmz(content: bytes, change: Callable[[str], str]) -> bytes:
    """The archive with the text of doc.kml changed and everything else as it is; raises ValueError without doc.kml."""
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        if "doc.kml" not in old.namelist():
            raise ValueError("the archive holds no doc.kml")
        for entry in old.infolist():
            body = old.read(entry.filename)
            new.writestr(entry, change(body.decode("utf-8-sig")).encode() if entry.filename == "doc.kml" else body)
    return out.getvalue()


def routed(name: Column, routes: dict[str, tuple[str, str]]) -> tuple[Column, Column]:
    """(folder, new name) of a file by a table from old names; a file that is not in it goes to the folder other as it is."""
    folder, new = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for old, (where, as_) in routes.items():
        folder, new = folder.when(F.lower(name) == old.lower(), where), new.when(F.lower(name) == old.lower(), as_)
    return folder.otherwise("other"), new.otherwise(name)
