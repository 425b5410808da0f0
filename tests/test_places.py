import pytest
from pyspark.sql import functions as F

from ambitus.operators import places, tiles
from ambitus.functions import text as X


def test_tiles(spark):
    b = (34.0, 33.7, -84.6, -84.1, 0.15, 0.25)
    f = spark.createDataFrame([(1, 34.0, -84.6, "gym", 1.0), (2, 33.85, -84.35, "gym", 1.0), (3, 33.7, -84.1, "gym", 1.0)], "id int, latitude double, longitude double, category string, radius_miles double")
    grid = tiles.tiles(spark, *b)
    got = {(r["row"], r["col"]): r["point_count"] for r in tiles.completeness(grid, tiles.assign(f, grid, b[0], b[2], b[4], b[5], "id"), ["gym"]).collect()}
    assert got[0, 0] == 2 and got[1, 1] == 2 and got[0, 1] == 1
    with pytest.raises(ValueError):
        tiles.tile_rows(1.0, 2.0, 0.0, 1.0, 0.1, 0.1)


def test_names(spark):
    rows = [(1, "q", "gym", "idAAAA", "Planet", "10 Peach St NE, A", "base"), (2, "q", "gym", "idBBBB", "planet", "20 Pied Ave NE, A", "base"), (3, "q", "gym", "idCCCC", "Solo", None, "base"), (4, "q", "gym", None, "Twin", None, "x"), (5, "r", "gym", "zz12345", "Twin", "", "x")]
    df = spark.createDataFrame(rows, "id int, query string, category string, placeId string, name string, formattedAddress string, sourceQueryType string")
    got = {r["id"]: r["normalized_name"] for r in places.normalize_names(df, [F.col("id")]).collect()}
    assert got == {1: "Planet | Peach St NE", 2: "planet | Pied Ave NE", 3: "Solo", 4: "Twin | id", 5: "Twin | 2345"}


def test_reasons(spark):
    rows = [("LA Fitness Buckhead", ["gym"]), ("BACH Fitness", ["gym"]), ("LA Fitness", ["school"]), ("LA Fitness Juice Bar", ["gym"])]
    df = spark.createDataFrame(rows, "name string, types array<string>")
    got = [r[0] for r in df.select(places.reject_reason(F.col("name"), F.lit(None).cast("string"), F.col("types"), F.array(F.lit("LA Fitness")), ["juice"], ["gym"])).collect()]
    assert got == [None, "missing_required_brand_tokens", "type_mismatch", "reject_keyword:juice"]


def test_expansion(spark):
    df = spark.createDataFrame([("Piedmont Park", ["entrance", "{query} north $1"]), ("X", None)], "q string, t array<string>")
    assert [r["search"] for r in places.expand_searches(df, "q", "t").orderBy("q", "ord").collect()] == ["Piedmont Park", "Piedmont Park entrance", "Piedmont Park north $1", "X"]


def test_marks(spark):
    assert spark.createDataFrame([("Élan  Ōne",), (None,)], "s string").select(X.without_marks("s")).collect()[0][0] == "elan one"
