"""KML and KMZ documents as rows of placemarks."""

from __future__ import annotations

import html
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COORD = "struct<latitude:double,longitude:double>"
SCHEMA = f"source_file string, placemark_index int, folder string, name string, description string, metadata map<string,string>, points array<{_COORD}>, lines array<array<{_COORD}>>, polygons array<array<array<{_COORD}>>>"
_ROW = re.compile(r"<tr>\s*<td>(.*?)</td>\s*<td>(.*?)</td>\s*</tr>", re.I | re.S)
_FORBIDDEN = re.compile("[^\x09\x0a\x0d\x20-\ud7ff\ue000-\ufffd]")


def read_files(spark: SparkSession, path: str, exclude: str | None = None) -> DataFrame:
    """(source_file, content) of the .kml and .kmz files under a folder, but for those whose name matches ``exclude`` (ignoring
    case); of files with the same bytes the one whose path comes first.  Only digests are shuffled: contents stay where they are
    read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{kml,kmz}").load(path).withColumn("source_file", F.element_at(F.split("path", "/"), -1))
    f = f.where(~F.lower("source_file").rlike(exclude.lower())) if exclude else f
    first = f.select("path", F.concat_ws(":", "length", F.sha2("content", 256)).alias("_id")).groupBy("_id").agg(F.min("path").alias("path")).select("path")
    return f.join(first, "path", "left_semi").select("source_file", "content")


def placemarks(files: DataFrame, strict: bool = True) -> DataFrame:
    """Placemarks of documents (source_file, content): in document order, numbered by file, with folder path, metadata (extended
    data, later values of a key win, overlaid with the two-cell rows of an HTML table in the description, ignoring case) and
    geometry: points, lines, polygons (first ring outer), of nested collections too.  Altitudes, empty lines and empty rings are
    left out.  A document that cannot be read (broken XML, no KML root, a KMZ without doc.kml) fails the query; if not strict it
    gives no rows, and ``broken`` names it.  A null content gives no rows."""
    return files.select("source_file", "content").mapInPandas(_parse(strict), SCHEMA)


def broken(files: DataFrame) -> DataFrame:
    """(source_file, error) of the documents that cannot be read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for name, content in zip(pdf["source_file"], pdf["content"]):
                try:
                    parse_document(content)
                except ValueError as e:
                    out.append((name, str(e)))
            if out:
                yield pd.DataFrame(out, columns=["source_file", "error"])

    return files.select("source_file", "content").mapInPandas(run, "source_file string, error string")


def _parse(strict: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[tuple] = []
            for name, content in zip(pdf["source_file"], pdf["content"]):
                try:
                    out += [(name, i, *row) for i, row in enumerate(parse_document(content))]
                except ValueError as e:
                    if strict:
                        raise ValueError(f"{name}: {e}") from e
            if out:  # an empty frame has no types
                yield pd.DataFrame(out, columns=["source_file", "placemark_index", "folder", "name", "description", "metadata", "points", "lines", "polygons"])

    return run


def parse_document(content: bytes) -> list[tuple]:
    """Rows of a document; raises ValueError if it cannot be read."""
    if content is None:
        return []
    if content[:2] == b"PK":
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                content = z.read("doc.kml")
        except (KeyError, zipfile.BadZipFile) as e:
            raise ValueError("the archive holds no doc.kml") from e
    try:
        root = ElementTree.fromstring(_FORBIDDEN.sub("", content.decode("utf-8-sig", "replace")).encode())
    except ElementTree.ParseError as e:
        raise ValueError(f"broken XML: {e}") from e
    if _tag(root) != "kml":
        raise ValueError("the root is no kml element")
    out: list[tuple] = []
    _walk(root, (), out)
    return out


def with_table(metadata: dict[str, str], description: str | None) -> dict[str, str]:
    """Metadata overlaid with the key-value rows of an HTML table, entities resolved; a key that is there in another case is
    replaced."""
    rows = {html.unescape(k).strip(): html.unescape(v).strip() for k, v in _ROW.findall(description or "")}
    low = {k.lower() for k in rows}
    return {k: v for k, v in metadata.items() if k.lower() not in low} | rows if rows else metadata


def _tag(e: ElementTree.Element) -> str:
    return e.tag.rsplit("}", 1)[-1]


def _child(e: ElementTree.Element, tag: str) -> str | None:
    return next(((c.text or "").strip() for c in e if _tag(c) == tag), None)


def _walk(e: ElementTree.Element, folders: tuple[str, ...], out: list[tuple]) -> None:
    for c in e:
        if _tag(c) == "Placemark":
            metadata: dict[str, str] = {}
            points, lines, polygons = [], [], []
            for x in c.iter():
                if _tag(x) == "Data":
                    metadata[x.get("name", "")] = _child(x, "value") or ""
                elif _tag(x) == "SimpleData":
                    metadata[x.get("name", "")] = (x.text or "").strip()
                elif _tag(x) == "Point":
                    points += _coordinates(_child(x, "coordinates"))[:1]
                elif _tag(x) == "LineString":
                    lines += [line for line in [_coordinates(_child(x, "coordinates"))] if line]
                elif _tag(x) == "Polygon":
                    rings = [_coordinates(_child(r, "coordinates")) for tag in ("outerBoundaryIs", "innerBoundaryIs") for b in x if _tag(b) == tag for r in b]
                    polygons += [[r for r in rings if r]] if any(rings) else []
            description = _child(c, "description")
            out.append(("/".join(folders), _child(c, "name"), description, with_table(metadata, description), points, lines, polygons))
        elif _tag(c) in ("Folder", "Document", "kml"):
            _walk(c, (*folders, _child(c, "name") or "") if _tag(c) == "Folder" else folders, out)


def _coordinates(text: str | None) -> list[dict[str, float]]:
    out = []
    for part in (text or "").split():
        xyz = part.split(",")
        try:
            out.append({"latitude": float(xyz[1]), "longitude": float(xyz[0])})
        except (IndexError, ValueError):
            continue
    return out
