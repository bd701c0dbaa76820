"""Geometries of every kind and the SQL functions on them: fixtures, brute force, and plans without Python."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from casegrid.functions import haversine
from casegrid.functions.geometry import register_geometry
from casegrid.sources import geojson_geometries

SF_DIR = "/root/testdata/sf0.001"
SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]
FAR = [[10, 10], [12, 10], [11, 12], [10, 10]]
GEOMETRIES = {
    "Point": [1, 3],
    "MultiPoint": [[1, 3], [3, 1]],
    "LineString": [[0, 1], [2, 3], [4, 3]],
    "MultiLineString": [[[0, 1], [2, 3]], [[3, 0], [3, 4]]],
    "Polygon": [SQUARE, HOLE],
    "MultiPolygon": [[SQUARE, HOLE], [FAR]],
}
BAD = [
    None, "", "nonsense", "{}", "[]", '{"type": "Point"}', '{"type": "Point", "coordinates": []}', '{"type": "Point", "coordinates": [1]}',
    '{"type": "Point", "coordinates": ["x", 1]}', '{"type": "Polygon", "coordinates": [1, 2]}', '{"type": "Circle", "coordinates": [1, 2]}',
    '{"type": "Polygon", "coordinates": []}', '{"type": "GeometryCollection", "geometries": [{"type": "GeometryCollection", "geometries": []}]}',
    '{"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}, {"type": "Point", "coordinates": []}, {"type": "Circle"}]}',
]


@pytest.fixture(scope="module")
def sql(spark):
    register_geometry(spark)
    register_geometry(spark)  # changes nothing
    return spark.sql


def text(kind, coordinates):
    return json.dumps({"type": kind, "coordinates": coordinates})


def every_kind():
    members = [{"type": k, "coordinates": c} for k, c in GEOMETRIES.items() if k in ("Point", "LineString", "Polygon")]
    return {**{k: text(k, c) for k, c in GEOMETRIES.items()}, "GeometryCollection": json.dumps({"type": "GeometryCollection", "geometries": members})}


def test_every_kind_is_read(spark, sql):
    lines = [f'{{"type": "Feature", "properties": {{"n": "{k}"}}, "geometry": {g}}},' for k, g in every_kind().items()]
    found = geojson_geometries(spark.createDataFrame([(line,) for line in lines], "value string"), "n STRING", '"type": "Feature"')
    found.createOrReplaceTempView("kinds_read")
    rows = sql("SELECT n, geometry.kind AS kind, size(geo_vertices(geometry)) AS v, size(geo_edges(geometry)) AS e, geo_box(geometry) AS box FROM kinds_read")
    out = {r["n"]: (r["v"], r["e"], tuple(r["box"])) for r in rows.collect() if r["n"] == r["kind"]}
    assert out == {
        "Point": (1, 0, (1, 3, 1, 3)), "MultiPoint": (2, 0, (1, 1, 3, 3)), "LineString": (3, 2, (0, 1, 4, 3)),
        "MultiLineString": (4, 2, (0, 0, 3, 4)), "Polygon": (10, 8, (0, 0, 4, 4)), "MultiPolygon": (14, 11, (0, 0, 12, 12)),
        "GeometryCollection": (14, 10, (0, 0, 4, 4)),
    }


def test_what_is_no_geometry_is_null(spark, sql):
    spark.createDataFrame([(k, t) for k, t in enumerate(BAD)], "k int, t string").createOrReplaceTempView("bad_texts")
    assert sql("SELECT k FROM bad_texts WHERE geo_geometry(t) IS NOT NULL").collect() == []


def on_segment(p, a, b):
    side = (p[0] - a[0]) * (b[1] - a[1]) - (b[0] - a[0]) * (p[1] - a[1])
    return side == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def in_polygon(p, rings):
    edges = [e for ring in rings for e in zip(ring, ring[1:])]
    if any(on_segment(p, a, b) for a, b in edges):
        return False
    odd = False
    for a, b in edges:
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]):
            odd = not odd
    return odd


def holds(kind, coordinates, p):
    if kind == "Point":
        return list(p) == coordinates
    if kind == "MultiPoint":
        return list(p) in coordinates
    if kind == "LineString":
        return any(on_segment(p, a, b) for a, b in zip(coordinates, coordinates[1:]))
    if kind == "MultiLineString":
        return any(holds("LineString", line, p) for line in coordinates)
    if kind == "Polygon":
        return in_polygon(p, coordinates)
    if kind == "MultiPolygon":
        return any(in_polygon(p, polygon) for polygon in coordinates)
    return any(holds(k, GEOMETRIES[k], p) for k in ("Point", "LineString", "Polygon"))


def test_every_kind_holds_the_points_it_should(spark, sql):
    points = [(x / 2, y / 2) for x in range(-2, 26) for y in range(-2, 26)]
    spark.createDataFrame(list(every_kind().items()), "kind string, t string").createOrReplaceTempView("kind_texts")
    spark.createDataFrame(points, "x double, y double").createOrReplaceTempView("lattice")
    found = sql(
        """SELECT a.kind, p.x, p.y
           FROM (SELECT kind, g, c.cell FROM (SELECT kind, geo_geometry(t) AS g FROM kind_texts), LATERAL geo_cells(g, 1) AS c) AS a
           JOIN lattice AS p ON geo_cell(geo_point(p.x, p.y), 1) = a.cell WHERE geo_contains(a.g, geo_point(p.x, p.y))"""
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Cartesian", "NestedLoop"))
    expected = sorted((k, *p) for k in every_kind() for p in points if holds(k, GEOMETRIES.get(k), p))
    assert sorted(map(tuple, found.collect())) == expected


def test_polygons_cover_points_and_lines(spark, sql):
    inner = {
        "a point": (text("Point", [3, 3]), True), "a point in the hole": (text("Point", [1.5, 1.5]), False), "a corner": (text("Point", [0, 0]), False),
        "a line": (text("LineString", [[0.5, 0.5], [3, 0.5], [3, 3]]), True), "a line through the hole": (text("LineString", [[0.5, 1.5], [3, 1.5]]), False),
        "a line out": (text("LineString", [[3, 3], [5, 3]]), False), "a line along the edge": (text("LineString", [[1, 4], [3, 4]]), False),
        "a line to the edge": (text("LineString", [[3, 3], [3, 4]]), False), "points in two parts": (text("MultiPoint", [[3, 3], [11, 11]]), False),
        "lines": (text("MultiLineString", [[[3, 3], [3.5, 3]], [[0.5, 0.5], [0.5, 3]]]), True), "a polygon": (text("Polygon", [FAR]), None),
    }
    spark.createDataFrame([(k, t) for k, (t, _) in inner.items()], "k string, t string").createOrReplaceTempView("inner_texts")
    whole = text("MultiPolygon", GEOMETRIES["MultiPolygon"]).replace("'", "")
    found = sql(f"SELECT k, geo_covers(geo_geometry('{whole}'), geo_geometry(t)) AS c FROM inner_texts").collect()
    assert {r["k"]: r["c"] for r in found} == {k: c for k, (_, c) in inner.items()}


def test_distances_and_places_equal_the_column_functions(spark, sql):
    rng = random.Random(2)
    rows = [tuple(rng.uniform(-180, 180) if k % 2 == 0 else rng.uniform(-90, 90) for k in range(4)) for _ in range(200)]
    rows += [(0.0, 90.0, 0.0, -90.0), (180.0, 0.0, -180.0, 0.0), (None, 1.0, 1.0, 1.0), (math.nan, 1.0, 1.0, 1.0), (1.0, 91.0, 1.0, 1.0), (math.inf, 0.0, 1.0, 1.0)]
    table = spark.createDataFrame(rows, "a double, b double, c double, d double")
    ours = table.select(haversine(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("column"), F.expr("geo_distance(geo_point(a, b), geo_point(c, d))").alias("sql"))
    out = ours.collect()
    assert all(abs(r["column"] - r["sql"]) < 1e-6 for r in out[:202])
    assert [r["sql"] for r in out[202:]] == [None] * 4
    assert out[202]["column"] is None and math.isnan(out[203]["column"]) and math.isnan(out[205]["column"])


@pytest.mark.parametrize("name", ["sql_distance", "sql_contains", "geometry_kinds"])
def test_statements_run_without_python_or_all_pairs(spark, name):
    plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Cartesian", "NestedLoop"))
