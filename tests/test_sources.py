import io
import json
import zipfile

from ambitus.sources import kml, places
from ambitus.streaming.places import arrivals, first_seen, place_stream

DOC = b"""<?xml version="1.0"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document><Folder><name>Outer</name><Folder><name>In</name>
<Placemark><name>A</name><ExtendedData><Data name="K"><value>1</value></Data><SchemaData><SimpleData name="K">2</SimpleData></SchemaData></ExtendedData>
<MultiGeometry><Point><coordinates> -84.1,33.1,5</coordinates></Point><LineString><coordinates>-84,33 -84.5,33.5</coordinates></LineString><LineString><coordinates/></LineString></MultiGeometry></Placemark></Folder></Folder>
<Placemark><name>B</name><Polygon><innerBoundaryIs><LinearRing><coordinates>1,1 2,1 2,2 1,1</coordinates></LinearRing></innerBoundaryIs><outerBoundaryIs><LinearRing><coordinates>0,0 4,0 4,4 0,0</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark></Document></kml>"""


def test_placemarks(spark, tmp_path):
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("doc.kml", DOC)
    (tmp_path / "a.kml").write_bytes(DOC)
    (tmp_path / "b.kml").write_bytes(DOC)  # the same bytes again
    (tmp_path / "c.kmz").write_bytes(z.getvalue())
    (tmp_path / "d.kml").write_bytes(b"<html/>")
    rows = sorted(kml.placemarks(kml.read_files(spark, str(tmp_path)), strict=False).collect(), key=lambda r: (r["source_file"], r["placemark_index"]))
    assert [(r["source_file"], r["name"], r["folder"]) for r in rows] == [("a.kml", "A", "Outer/In"), ("a.kml", "B", ""), ("c.kmz", "A", "Outer/In"), ("c.kmz", "B", "")]
    a, b = rows[:2]
    assert a["metadata"] == {"K": "2"} and a["points"][0]["latitude"] == 33.1 and len(a["lines"]) == 1 and len(b["polygons"][0]) == 2 and len(b["polygons"][0][0]) == 4


def test_place_lines(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('﻿{"query":"q","name":"N","placeId":"1","searchNames":["", "x"]}\n\n{"query":"q","name":"M","placeId":"2"}\n')
    assert sorted((r["name"], tuple(r["searchNames"])) for r in places.read_places(spark, str(tmp_path)).collect()) == [("M", ("M",)), ("N", ("x",))]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [{"category": "Gym", "placeId": p, "name": n, "gathered_at": "2032-01-01T00:00:00"} for p, n in (("1", "a"), ("1", "b"), ("2", "c"), ("", "d"))]
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps(x) for x in lines))
    for name, df, mode in (("seen", first_seen(place_stream(spark, str(tmp_path / "in"))), "append"), ("counted", arrivals(place_stream(spark, str(tmp_path / "in"))), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    assert sorted(r["placeId"] for r in spark.table("seen").collect()) == ["1", "2"]
    assert [(r["category"], r["n"]) for r in spark.table("counted").collect()] == [("gym", 4)]


def test_harvest_at_any_depth(spark):
    def entry(i):
        return f'["T{i}","id{i}",[null,null,{i}.5,-84.0]]'

    def nested(text, n, way):
        for k in range(n):
            text = "[" + text + "]" if way == "array" or way == "both" and k % 2 else '{"k":' + text + "}"
        return "[" + text + "]"

    docs = {f"{way}{n}": nested(entry(n), n, way) for way in ("array", "object", "both") for n in (0, 3, 5, 12, 400)}
    docs["deep"] = nested(entry(7), 60_000, "both")  # deeper than the parser's recursion
    docs["inside an entry"] = ")]}'\n" + '["T1","id1",[null,null,1.5,-84.0],{"more":[' + entry(2) + "]}]"
    docs["repeated key"] = '[{"a":' + entry(1) + ',"a":' + entry(2) + "}]"
    others = {"blank": '[[" ","x",[0,0,1.5,2.5]],["x",null,[0,0,1.5,2.5]],["x","y",[0,0,null,2.5]],["x","y",[0,0,1.5]],[[1],[2],[0,0,1.5,2.5]]]', "cut": "[[" + entry(1), "none": None, "empty": ""}
    want = {(k, f"T{n}", f"id{n}", n + 0.5, -84.0) for k in docs for n in ([1, 2] if " " in k else [7] if k == "deep" else [int("".join(c for c in k if c.isdigit()))])}
    got = places.harvest(spark.createDataFrame([*docs.items(), *others.items()], "doc string, t string"), "t").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
