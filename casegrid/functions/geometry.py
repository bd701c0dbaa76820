"""Geometries of any kind, as one tagged struct, and the functions on them in SQL.

``geometry`` is STRUCT<kind, points, lines, polygons>: the kind that GeoJSON names, and every point, line and polygon (a
list of rings) that it consists of. One rule therefore walks all kinds: vertices, edges, boxes and containment look at these
three lists. Each function is SQL text over its arguments; `register_geometry` makes them functions of a session, so that
statements can call them, and the DataFrame readers use the same text. No function needs a Python worker.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from casegrid.functions.geo import EARTH_RADIUS_M

_POINT, _LINE = "ARRAY<DOUBLE>", "ARRAY<ARRAY<DOUBLE>>"
_RINGS = f"ARRAY<{_LINE}>"
POINT = "STRUCT<lon: DOUBLE, lat: DOUBLE>"
GEOMETRY = f"STRUCT<kind: STRING, points: {_LINE}, lines: {_RINGS}, polygons: ARRAY<{_RINGS}>>"
EDGE = "STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>"
BOX = "STRUCT<west: DOUBLE, south: DOUBLE, east: DOUBLE, north: DOUBLE>"
CELL = "STRUCT<x: BIGINT, y: BIGINT>"


def point_sql(lon: str, lat: str) -> str:
    """A place on earth; NULL where a coordinate is missing, not finite or out of range."""
    return f"CASE WHEN abs({lat}) <= 90D AND abs({lon}) <= 360D THEN named_struct('lon', {lon}, 'lat', {lat}) END"


def distance_sql(a: str, b: str) -> str:
    """Great-circle distance of two places in metres; NULL where one is."""
    flat, around = (f"pow(sin(radians({b}.{c} - {a}.{c}) / 2), 2)" for c in ("lat", "lon"))
    h = f"{flat} + cos(radians({a}.lat)) * cos(radians({b}.lat)) * {around}"
    return f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {2 * EARTH_RADIUS_M}D * asin(sqrt(least(1D, {h}))) END"


def _simple_sql(kind: str, text: str) -> str:
    """The geometry that a JSON text of any kind but a collection stands for."""
    at = f"get_json_object({text}, '$.coordinates')"

    def parsed(schema: str) -> str:
        return f"from_json({at}, '{schema}')"

    points = f"CASE {kind} WHEN 'Point' THEN array({parsed(_POINT)}) WHEN 'MultiPoint' THEN {parsed(_LINE)} ELSE cast(array() AS {_LINE}) END"
    lines = f"CASE {kind} WHEN 'LineString' THEN array({parsed(_LINE)}) WHEN 'MultiLineString' THEN {parsed(_RINGS)} ELSE cast(array() AS {_RINGS}) END"
    polygons = (
        f"CASE {kind} WHEN 'Polygon' THEN array({parsed(_RINGS)}) WHEN 'MultiPolygon' THEN {parsed(f'ARRAY<{_RINGS}>')}"
        f" ELSE cast(array() AS ARRAY<{_RINGS}>) END"
    )
    return f"named_struct('kind', {kind}, 'points', {points}, 'lines', {lines}, 'polygons', {polygons})"


def _whole_sql(g: str) -> str:
    """``g``, or NULL where a list is missing, a geometry has no vertex, or a vertex lacks a finite coordinate."""
    vertices = vertices_sql(g)
    finite = "size(p) >= 2 AND abs(p[0]) < double('infinity') AND abs(p[1]) < double('infinity')"
    return f"CASE WHEN size({vertices}) > 0 AND forall({vertices}, p -> coalesce({finite}, false)) THEN {g} END"


def _members_sql(text: str) -> str:
    """The members of a collection, one by one."""
    return f"transform(from_json(get_json_object({text}, '$.geometries'), 'ARRAY<STRING>'), t -> {_simple_sql(_kind_sql('t'), 't')})"


def _collected_sql(members: str) -> str:
    """A collection's members put together; NULL if one is no geometry, or a collection itself."""
    joined = ", ".join(f"'{part}', flatten(transform({members}, m -> m.{part}))" for part in ("points", "lines", "polygons"))
    whole = "m.points IS NOT NULL AND m.lines IS NOT NULL AND m.polygons IS NOT NULL"
    return f"CASE WHEN forall({members}, m -> {whole} AND m.kind IN ({_KINDS})) THEN named_struct('kind', 'GeometryCollection', {joined}) END"


def _kind_sql(text: str) -> str:
    return f"get_json_object({text}, '$.type')"


# The kinds that GeoJSON names, but collections.
_KINDS = "'Point', 'MultiPoint', 'LineString', 'MultiLineString', 'Polygon', 'MultiPolygon'"


def vertices_sql(g: str) -> str:
    """All vertices, [lon, lat] each, as often as they are written."""
    return f"concat({g}.points, flatten({g}.lines), flatten(flatten({g}.polygons)))"


def _line_edges_sql(line: str) -> str:
    """The edges of a line or ring, lower end first, so that two polygons that share one compute the same numbers."""
    a, b = f"{line}[k]", f"{line}[k + 1]"
    ends = lambda p, q: f"named_struct('x1', {p}[0], 'y1', {p}[1], 'x2', {q}[0], 'y2', {q}[1])"
    one = f"CASE WHEN {a}[1] > {b}[1] THEN {ends(b, a)} ELSE {ends(a, b)} END"
    return f"CASE WHEN size({line}) > 1 THEN transform(sequence(0, size({line}) - 2), k -> {one}) ELSE cast(array() AS ARRAY<{EDGE}>) END"


def _edges_of_sql(lines: str) -> str:
    return f"flatten(transform({lines}, line -> {_line_edges_sql('line')}))"


def edges_sql(g: str) -> str:
    """All edges of lines and rings."""
    return f"concat({_edges_of_sql(f'{g}.lines')}, {_edges_of_sql(f'flatten({g}.polygons)')})"


def box_sql(g: str) -> str:
    def end(which: str, axis: int) -> str:
        return f"array_{which}(transform({vertices_sql(g)}, p -> p[{axis}]))"

    return f"named_struct('west', {end('min', 0)}, 'south', {end('min', 1)}, 'east', {end('max', 0)}, 'north', {end('max', 1)})"


def _side_sql(e: str, x: str, y: str) -> str:
    """Negative where the edge lies to the east of the point, zero where they are in line."""
    return f"(({x} - {e}.x1) * ({e}.y2 - {e}.y1) - ({e}.x2 - {e}.x1) * ({y} - {e}.y1))"


def _touches_sql(e: str, x: str, y: str) -> str:
    return (
        f"({y} BETWEEN {e}.y1 AND {e}.y2 AND {x} BETWEEN least({e}.x1, {e}.x2) AND greatest({e}.x1, {e}.x2)"
        f" AND {_side_sql(e, x, y)} = 0)"
    )


def _inside_sql(polygon: str, x: str, y: str) -> str:
    """Whether a point lies within a polygon and on none of its edges: even-odd over all of its rings."""
    edges = _edges_of_sql(polygon)
    crosses = f"e.y1 <= {y} AND e.y2 > {y} AND {_side_sql('e', x, y)} < 0"
    return f"(size(filter({edges}, e -> {crosses})) % 2 = 1 AND NOT exists({edges}, e -> {_touches_sql('e', x, y)}))"


def contains_sql(g: str, x: str, y: str) -> str:
    """Whether a geometry holds a point: it is one of its points, lies on one of its lines, or within one of its polygons."""
    on_line = f"exists({_edges_of_sql(f'{g}.lines')}, f -> {_touches_sql('f', x, y)})"
    is_point = f"exists({g}.points, q -> q[0] = {x} AND q[1] = {y})"
    return f"({is_point} OR {on_line} OR exists({g}.polygons, polygon -> {_inside_sql('polygon', x, y)}))"


def _meet_sql(a: str, b: str) -> str:
    """Whether two edges have a point in common."""
    sides = [_side_sql(a, f"{b}.x1", f"{b}.y1"), _side_sql(a, f"{b}.x2", f"{b}.y2"), _side_sql(b, f"{a}.x1", f"{a}.y1"), _side_sql(b, f"{a}.x2", f"{a}.y2")]
    apart = f"(sign({sides[0]}) * sign({sides[1]}) < 0 AND sign({sides[2]}) * sign({sides[3]}) < 0)"
    ends = [_touches_sql(p, f"{q}.{x}", f"{q}.{y}") for p, q in ((a, b), (b, a)) for x, y in (("x1", "y1"), ("x2", "y2"))]
    return f"({apart} OR {' OR '.join(ends)})"


def covers_sql(g: str, h: str) -> str:
    """Whether one polygon of ``g`` holds all of ``h``, points and lines, without touching its own edge; NULL if ``h`` has polygons."""
    every = f"forall({vertices_sql(h)}, p -> {_inside_sql('polygon', 'p[0]', 'p[1]')})"
    own, theirs = _edges_of_sql("polygon"), _edges_of_sql(f"{h}.lines")
    crossed = f"exists({theirs}, a -> exists({own}, b -> {_meet_sql('a', 'b')}))"
    return f"CASE WHEN size({h}.polygons) = 0 THEN exists({g}.polygons, polygon -> {every} AND NOT {crossed}) END"


def cell_sql(x: str, y: str, per_degree: str) -> str:
    return f"named_struct('x', floor({x} * {per_degree}), 'y', floor({y} * {per_degree}))"


def cells_sql(g: str, per_degree: str) -> str:
    """All cells of a grid that a geometry's box touches: what holds a point lists the point's cell."""
    box = box_sql(g)
    span = lambda low, high: f"sequence(floor(({box}).{low} * {per_degree}), floor(({box}).{high} * {per_degree}))"
    return f"flatten(transform({span('west', 'east')}, x -> transform({span('south', 'north')}, y -> named_struct('x', x, 'y', y))))"


_JSON = "json STRING"
_RAW = f"CASE WHEN {_kind_sql('json')} = 'GeometryCollection' THEN geo_collected(geo_members(json)) WHEN {_kind_sql('json')} IN ({_KINDS}) THEN geo_simple(json) END"
#: name: (arguments, result, body) of scalar functions; those that others call come first.
SCALAR_FUNCTIONS = {
    "geo_point": ("lon DOUBLE, lat DOUBLE", POINT, point_sql("lon", "lat")),
    "geo_distance": (f"a {POINT}, b {POINT}", "DOUBLE", distance_sql("a", "b")),
    "geo_simple": (_JSON, GEOMETRY, _simple_sql(_kind_sql("json"), "json")),
    "geo_members": (_JSON, f"ARRAY<{GEOMETRY}>", _members_sql("json")),
    "geo_collected": (f"members ARRAY<{GEOMETRY}>", GEOMETRY, _collected_sql("members")),
    "geo_whole": (f"g {GEOMETRY}", GEOMETRY, _whole_sql("g")),
    "geo_raw": (_JSON, GEOMETRY, _RAW),
    "geo_geometry": (_JSON, GEOMETRY, "geo_whole(geo_raw(json))"),
    "geo_vertices": (f"g {GEOMETRY}", _LINE, vertices_sql("g")),
    "geo_edges": (f"g {GEOMETRY}", f"ARRAY<{EDGE}>", edges_sql("g")),
    "geo_box": (f"g {GEOMETRY}", BOX, box_sql("g")),
    "geo_contains": (f"g {GEOMETRY}, p {POINT}", "BOOLEAN", contains_sql("g", "p.lon", "p.lat")),
    "geo_covers": (f"g {GEOMETRY}, h {GEOMETRY}", "BOOLEAN", covers_sql("g", "h")),
    "geo_cell": (f"p {POINT}, per_degree INT", CELL, cell_sql("p.lon", "p.lat", "per_degree")),
}
#: name: (arguments, columns, query) of table functions, for LATERAL joins.
TABLE_FUNCTIONS = {
    "geo_cells": (f"g {GEOMETRY}, per_degree INT", f"cell {CELL}", f"SELECT explode({cells_sql('g', 'per_degree')})"),
    "geo_edge_rows": (f"g {GEOMETRY}", "x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE", f"SELECT inline({edges_sql('g')})"),
}


def register_geometry(spark: SparkSession) -> None:
    """Makes the functions above temporary functions of the session; a second call changes nothing.

    `geo_geometry` reads a GeoJSON geometry text, NULL if it is none. A join by `geo_contains` alone pairs all rows. Join on
    cells first: ``geo_cell(p, 20) = cell`` with ``LATERAL geo_cells(g, 20)`` on the side of the geometries is an equi-join that
    loses nothing.
    """
    if spark.catalog.functionExists("geo_edge_rows"):
        return
    for name, (arguments, result, body) in SCALAR_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    for name, (arguments, columns, query) in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE({columns}) RETURN {query}")
