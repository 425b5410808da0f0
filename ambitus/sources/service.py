"""A places service as a data source: each search in each tile is one partition."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "query string, category string, placeId string, name string, formattedAddress string, latitude double, longitude double, types array<string>, sourceQueryType string"
PAYLOAD = "places array<struct<id:string,displayName:struct<text:string>,formattedAddress:string,location:struct<latitude:double,longitude:double>,types:array<string>>>"
# Answers after which a request is tried again, and the seconds waited before each further try.
RETRY = (429, 500, 502, 503, 504)
WAITS = (2.0, 5.0)


def body_of(search: dict) -> dict:
    """The body of a text search within a rectangle."""
    low, high = ({"latitude": search[a], "longitude": search[b]} for a, b in (("south", "west"), ("north", "east")))
    return {"textQuery": search["search"], "locationRestriction": {"rectangle": {"low": low, "high": high}}}


def ask(send: Callable[[dict], tuple[int, str]], search: dict, waits: tuple[float, ...] = WAITS, sleep: Callable[[float], None] = time.sleep) -> str:
    """The answer's text; busy answers are asked again after each wait, other failures and the last one raise IOError."""
    for wait in (*waits, None):
        status, text = send(body_of(search))
        if status == 200:
            return text
        if status not in RETRY or wait is None:
            raise OSError(f"the places service answered {status} to {search['search']}")
        sleep(wait)
    raise AssertionError


def http_sender(url: str, key: str, mask: str) -> Callable[[dict], tuple[int, str]]:
    def send(body: dict) -> tuple[int, str]:
        headers = {"Content-Type": "application/json", "X-Goog-Api-Key": key, "X-Goog-FieldMask": mask}
        request = urllib.request.Request(url, json.dumps(body).encode(), headers)
        try:
            with urllib.request.urlopen(request, timeout=60) as r:
                return r.status, r.read().decode()
        except urllib.error.HTTPError as e:
            return e.code, ""

    return send


def canned_sender(folder: str) -> Callable[[dict], tuple[int, str]]:
    """Answers from files named after the search: for tests and for work without a network."""

    def send(body: dict) -> tuple[int, str]:
        try:
            with open(f"{folder}/{body['textQuery']}.json", encoding="utf-8") as f:
                return 200, f.read()
        except FileNotFoundError:
            return 200, "{}"

    return send


def places_of(text: str, search: dict) -> Iterator[tuple]:
    """Place rows of an answer; places without a location are left out, missing texts are empty."""
    for p in json.loads(text).get("places") or []:
        at = p.get("location")
        if at:
            yield search.get("query", ""), search.get("category", ""), p.get("id") or "", (p.get("displayName") or {}).get("text") or "", p.get("formattedAddress") or "", float(at.get("latitude", 0.0)), float(at.get("longitude", 0.0)), list(p.get("types") or []), "base" if not search.get("ord") else "expanded"


class PlacesSource(DataSource):
    """Options: searches (a JSON array of searches with query, category, search, ord, north, south, east, west), and either folder
    (canned answers) or url, key and mask."""

    @classmethod
    def name(cls) -> str:
        return "places_service"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(s) for s in json.loads(self.options["searches"])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        send = canned_sender(o["folder"]) if o.get("folder") else http_sender(o["url"], o["key"], o["mask"])
        yield from places_of(ask(send, partition.value), partition.value)


def read_service(spark: SparkSession, fetches: DataFrame, **options: str) -> DataFrame:
    """Place records of all fetches (of ``lists.ListConfig.fetches``); their number is that of the configured tiles and searches."""
    spark.dataSource.register(PlacesSource)
    searches = [r.asDict() for r in fetches.select("query", "category", "search", "ord", "north", "south", "east", "west").collect()]
    return spark.read.format("places_service").options(searches=json.dumps(searches), **options).load()


def payload_records(answers: DataFrame, text: str, query: str, category: str) -> DataFrame:
    """Place records of stored answers: as ``places_of``, in columns."""
    p = answers.select(F.col(query).alias("query"), F.col(category).alias("category"), F.explode(F.from_json(text, PAYLOAD)["places"]).alias("p")).where(F.col("p.location").isNotNull())
    empty = lambda c: F.coalesce(c, F.lit(""))
    return p.select("query", "category", empty(F.col("p.id")).alias("placeId"), empty(F.col("p.displayName.text")).alias("name"), empty(F.col("p.formattedAddress")).alias("formattedAddress"), F.col("p.location.latitude").alias("latitude"), F.col("p.location.longitude").alias("longitude"), F.coalesce("p.types", F.array().cast("array<string>")).alias("types"), F.lit("base").alias("sourceQueryType"))
