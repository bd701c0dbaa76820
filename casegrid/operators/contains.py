"""Points in polygons, joined on grid cells.

Every polygon picks a grid whose cells are 1/16 to 1/4 of its own size, so that it lists at most 17 x 17 cells.
Each of its edges names the cells it can matter to: those of its rows that it passes through or lies east
of. Grouped by cell, the edges show whether the cell is wholly inside (listed without edges), wholly
outside (dropped) or cut; a cut cell keeps the edges that pass through it or end beside it, and those that
lie east of all of it as one parity bit. Cells that keep many edges are divided into 4 x 4 finer ones by the
same rule, so the edges that a point is tested against stay few however many vertices a polygon has. The
work grows with the edges, which are spread over all tasks. A point has one cell per grid in use; the join is
an equi-join on (grid, cell) with the even-odd test as its condition.

Edges travel one to a row and are listed in chunks of at most ``CHUNK`` neighbours on the ring, so no row grows
with a polygon. Where a cell stays crowded however often it is divided (many edges that meet in a place), its
chunks are tested apart, and a grouped exclusive-or over (point, polygon) puts the parities together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.functions import crossings, inside, on_earth, polygon_edges
from casegrid.operators.rows import quoted
from casegrid.operators.storage import stored

CELL = ["_level", "_cx", "_cy"]
INNER = [*CELL, "_leads", "_parts", "_crossed", "_edges"]
#: A cell with more edges is divided, at most so many times.
MANY_EDGES, MAX_DIVISIONS = 48, 6
#: Edges of a polygon that may be listed in one row.
CHUNK = 4096

_EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


def _corner(x: str, y: str, sign: str) -> str:
    """Whether edge ``e``, prolonged to a line, lies east (<) or west (>) of the point (x, y)."""
    return f"({x} - e.x1) * (e.y2 - e.y1) - (e.x2 - e.x1) * ({y} - e.y1) {sign} 0"


def _beside(border: str, sign: str) -> str:
    """`_corner` at both corners on a border of the cell."""
    return f"{_corner(border, '_south', sign)} AND {_corner(border, '_north', sign)}"


def _edge_rows(polygons: DataFrame, coordinates: str) -> DataFrame:
    """Stored (_polygon, _level, _first, _chunk, e), a row for each edge; a polygon's first one has its columns in _row."""
    keep = [F.col(quoted(c)) for c in polygons.columns if c != coordinates]
    numbered = (
        polygons.select(F.struct(F.lit(True).alias("_is"), *keep).alias("_row"), polygon_edges(F.col(quoted(coordinates))).alias("_edges"))
        .selectExpr(
            "*",
            "monotonically_increasing_id() AS _polygon",
            "array_min(transform(_edges, e -> least(e.x1, e.x2))) AS _x0",
            "array_max(transform(_edges, e -> greatest(e.x1, e.x2))) AS _x1",
            "array_min(_edges.y1) AS _y0",
            "array_max(_edges.y2) AS _y1",
        )
        .filter("_x1 > _x0 AND _y1 > _y0")
        .selectExpr("*", "cast(floor(log2(greatest(_x1 - _x0, _y1 - _y0)) / 2) - 1 AS int) AS _level")
        .selectExpr("*", "cast(floor(_x0 / pow(4D, _level)) AS bigint) AS _first", "posexplode(_edges) AS (_at, e)")
    )
    return stored(
        numbered.selectExpr(
            "_polygon", "_level", "_first", f"_at div {CHUNK} AS _chunk", "CASE WHEN _at = 0 THEN _row END AS _row", "e"
        )
    )


def _judged(rows: DataFrame) -> DataFrame:
    """(_polygon, *CELL, _chunk, _cut, _odd, _beyond, _right, _edges) from (_polygon, *CELL, _chunk, _odd, e) rows.

    The rows are one per cell and edge. ``_odd`` is the parity of edges east of the cell that are left out; ``e`` may be
    NULL. Rounding is monotone, so what the corners of a cell show about an edge holds for every point in it.
    """
    east_of, west_of = _beside("_east", "<"), _beside("_west", ">")
    across = "e.y2 >= _south AND e.y1 <= _north AND greatest(e.x1, e.x2) >= _west AND least(e.x1, e.x2) <= _east"
    apart = f"({_beside('_west', '<')} AND {east_of}) OR ({_beside('_east', '>')} AND {west_of})"
    spanning = "e.y1 <= _south AND e.y2 >= _north"
    side = "pow(4D, _level)"
    return (
        rows.selectExpr(
            "*", f"_cx * {side} AS _west", f"(_cx + 1) * {side} AS _east",
            f"_cy * {side} AS _south", f"(_cy + 1) * {side} AS _north",
        )
        .selectExpr(
            "_polygon", *CELL, "_chunk", "_odd", "e",
            f"coalesce({across} AND NOT ({apart}), false) AS _touches",
            f"coalesce({spanning} AND {east_of}, false) AS _beyond",
            f"coalesce(e.y1 <= _south AND e.y2 > _south AND {_corner('_west', '_south', '<')}, false) AS _right",
            "coalesce(e.y2 >= _south AND e.y1 < _north AND greatest(e.x1, e.x2) >= _west"
            f" AND NOT ({spanning} AND ({east_of} OR {west_of})), false) AS _matters",
        )
        .groupBy("_polygon", *CELL, "_chunk")
        .agg(
            F.expr("bool_or(_touches) AS _cut"),
            F.expr("max(_odd) AS _odd"),
            F.expr("count_if(_beyond) % 2 = 1 AS _beyond"),
            F.expr("count_if(_right) % 2 = 1 AS _right"),
            F.expr("collect_list(CASE WHEN _matters THEN e END) AS _edges"),
        )
    )


def _listed(judged: DataFrame, chunked: bool) -> DataFrame:
    """Stored (_polygon, *CELL, _chunk, _leads, _parts, _crossed, _many, _edges) of judged rows.

    A cell has a row for each chunk with edges in it, one at least; ``_parts`` counts them, one ``_leads``, all know
    the number of edges and ``_crossed``, the parity of those that are left out.
    """
    cell = ["_polygon", *CELL]
    if chunked:
        judged = stored(judged)
        whole = judged.groupBy(*cell).agg(
            F.expr("bool_or(_cut) AS _cut"),
            F.expr("max(_odd) AS _odd"),
            F.expr("bit_xor(cast(_beyond AS int)) = 1 AS _beyond"),
            F.expr("bit_xor(cast(_right AS int)) = 1 AS _right"),
            F.expr("sum(size(_edges)) AS _n"),
            F.expr("count_if(size(_edges) > 0) AS _full"),
            F.expr("min(struct(size(_edges) = 0 AS _empty, _chunk))._chunk AS _least"),
        )
        rows = judged.select(*cell, "_chunk", "_edges").join(whole, cell)
        rows = rows.filter("_chunk = _least OR _cut AND size(_edges) > 0")
    else:
        rows = judged.selectExpr("*", "_chunk AS _least", "size(_edges) AS _n", "1 AS _full")
    return stored(
        rows.selectExpr(
            *cell, "_chunk",
            "_chunk = _least AS _leads",
            "CASE WHEN _cut AND _full > 1 THEN _full ELSE 1 END AS _parts",
            "_odd <> CASE WHEN _cut THEN _beyond ELSE _right END AS _crossed",
            "CASE WHEN _cut THEN _n ELSE 0 END AS _many",
            f"CASE WHEN _cut THEN _edges ELSE cast(array() AS array<{_EDGE}>) END AS _edges",
        )
    )


def _divided(cells: DataFrame) -> DataFrame:
    """The same cells, judged at four times the fineness: edges name the sub-cells that they can matter to."""
    side = "pow(4D, _level - 1)"
    low, high = f"cast(floor(e.y1 / {side}) AS bigint)", f"cast(floor(e.y2 / {side}) AS bigint)"
    by_edge = (
        cells.selectExpr("_polygon", "_level", "_cx", "_cy", "_chunk", "_crossed AS _odd", "explode(_edges) AS e")
        .selectExpr(
            "*",
            f"least(_cx * 4 + 3, cast(floor(greatest(e.x1, e.x2) / {side}) AS bigint)) AS _last",
            f"greatest(_cy * 4, {low}) AS _from",
            f"least(_cy * 4 + 3, {high}) AS _to",
        )
        .filter("_last >= _cx * 4 AND _to >= _from")
        .selectExpr("*", "explode(sequence(_from, _to)) AS _row")
        .selectExpr(
            "_polygon", "_level - 1 AS _level", "explode(sequence(_cx * 4, _last)) AS _cx", "_row AS _cy", "_chunk", "_odd", "e"
        )
    )
    all_parts = (
        cells.filter("_leads")
        .selectExpr("*", "explode(sequence(_cy * 4, _cy * 4 + 3)) AS _row")
        .selectExpr(
            "_polygon", "_level - 1 AS _level", "explode(sequence(_cx * 4, _cx * 4 + 3)) AS _cx", "_row AS _cy", "_chunk",
            "_crossed AS _odd", f"cast(NULL AS {_EDGE}) AS e",
        )
    )
    return _judged(by_edge.union(all_parts))


def _cells_of(polygons: DataFrame, coordinates: str) -> DataFrame:
    """Stored (polygon's columns, *INNER) of all cells that are not wholly outside, those with many edges in parts."""
    keep = [quoted(c) for c in polygons.columns if c != coordinates]
    edges = _edge_rows(polygons, coordinates)
    chunked = edges.filter("_chunk > 0").limit(1).count() > 0
    side = "pow(4D, _level)"
    rows = edges.selectExpr(
        "*",
        f"cast(floor(greatest(e.x1, e.x2) / {side}) AS bigint) AS _last",
        f"explode(sequence(cast(floor(e.y1 / {side}) AS bigint), cast(floor(e.y2 / {side}) AS bigint))) AS _cy",
    ).selectExpr("_polygon", "_level", "explode(sequence(_first, _last)) AS _cx", "_cy", "_chunk", "false AS _odd", "e")
    cells, done = _listed(_judged(rows), chunked), []
    for _ in range(MAX_DIVISIONS):
        crowded = cells.filter(F.col("_many") > MANY_EDGES)
        if crowded.limit(1).count() == 0:
            break
        done.append(cells.filter(F.col("_many") <= MANY_EDGES))
        cells = _listed(_divided(crowded), chunked)
    for part in done:
        cells = cells.union(part)
    cells = cells.filter("_crossed OR _many > 0")
    if chunked:
        few = cells.filter((F.col("_parts") > 1) & (F.col("_many") <= MANY_EDGES))
        one = few.groupBy("_polygon", *CELL).agg(
            F.first("_crossed").alias("_crossed"), F.flatten(F.collect_list("_edges")).alias("_edges")
        )  # at most MANY_EDGES
        cells = (
            cells.filter((F.col("_parts") == 1) | (F.col("_many") > MANY_EDGES))
            .select("_polygon", *INNER)
            .union(one.selectExpr("_polygon", *CELL, "true", "1L", "_crossed", "_edges"))
        )
    named = edges.filter("_row IS NOT NULL").select("_polygon", "_row")
    listed = cells.join(named, "_polygon").select("_polygon", "_row.*", *INNER)
    return stored(listed.select("_polygon", *keep, *INNER))


def _tested_in_parts(spots: DataFrame, cells: DataFrame, x: Column, y: Column, boundary: str) -> DataFrame:
    """The points in cells of several parts with the polygons that contain them; a part's row is small, its number is not."""
    kept = [F.col(quoted(c)) for c in spots.columns if c not in CELL]
    met = spots.join(cells.select(*CELL).distinct(), CELL, "left_semi")
    met = stored(
        met.select(F.monotonically_increasing_id().alias("_spot"), F.struct(*kept).alias("_point"), x.alias("_x"), y.alias("_y"), *CELL)
    )
    odd, on_edge = crossings(F.col("_edges"), F.col("_x"), F.col("_y"), boundary)
    odd = odd != (F.col("_crossed") & F.col("_leads"))
    tested = met.drop("_point").join(cells.select("_polygon", *INNER), CELL)
    held = (
        tested.select("_spot", "_polygon", odd.cast("int").alias("odd"), on_edge.alias("on_edge"))
        .groupBy("_spot", "_polygon")
        .agg(F.bit_xor("odd").alias("odd"), F.bool_or("on_edge").alias("on_edge"))
        .filter("odd = 1 AND NOT on_edge")
    )
    names = [c for c in cells.columns if c not in INNER]
    named = cells.filter("_leads").select(*map(quoted, names)).dropDuplicates(["_polygon"])
    wanted = [quoted(c) for c in names if c != "_polygon"]
    return held.join(met.select("_spot", "_point"), "_spot").join(named, "_polygon").select("_point.*", *wanted)


def join_contains(
    points: DataFrame,
    polygons: DataFrame,
    *,
    lon: str,
    lat: str,
    coordinates: str = "coordinates",
    boundary: str = "exclude",
) -> DataFrame:
    """Every point with every polygon that contains it: the columns of both, without the coordinates.

    Points without finite coordinates in range and points in no polygon are left out. Polygons must not cross the
    antimeridian.
    """
    cells = _cells_of(polygons, coordinates)
    grids = cells.select("_level", F.expr("_parts > 1 AS in_parts")).distinct().collect()  # at most two rows per grid in use
    x, y = F.col(quoted(lon)), F.col(quoted(lat))
    spots = points.filter(on_earth(x, y))
    kept = [quoted(c) for c in points.columns]
    if not grids:
        return spots.join(cells.drop("_polygon", *INNER), F.lit(False))
    addresses = F.array(
        *[
            F.struct(
                F.lit(level).cast("int").alias("_level"),
                F.floor(x / F.lit(4.0**level)).alias("_cx"),
                F.floor(y / F.lit(4.0**level)).alias("_cy"),
            )
            for level in sorted({row["_level"] for row in grids})
        ]
    )
    placed = spots.select(*kept, F.inline(addresses))
    found = (
        placed.join(cells.filter("_parts = 1"), CELL)
        .filter(inside(F.col("_edges"), x, y, boundary, F.col("_crossed")))
        .drop("_polygon", *INNER)
    )
    if not any(row["in_parts"] for row in grids):
        return found
    return found.union(_tested_in_parts(placed, cells.filter("_parts > 1"), x, y, boundary))


def contains_count(
    points: DataFrame,
    polygons: DataFrame,
    *,
    lon: str,
    lat: str,
    key: str,
    coordinates: str = "coordinates",
    boundary: str = "exclude",
) -> DataFrame:
    """(key, count): points inside the polygons of each key. Equal points are tested once."""
    places = points.groupBy(F.col(quoted(lon)).alias("_lon"), F.col(quoted(lat)).alias("_lat")).agg(
        F.count("*").alias("_n")
    )
    joined = join_contains(
        places,
        polygons.select(quoted(key), quoted(coordinates)),
        lon="_lon",
        lat="_lat",
        coordinates=coordinates,
        boundary=boundary,
    )
    return joined.groupBy(quoted(key)).agg(F.sum("_n").alias("count"))
