"""Nearest site of every point, ties kept, without pairing every point with every site.

Points and sites are placed in a cube grid around the unit sphere, where straight-line distance orders
like great-circle distance and has no seam at the poles or the antimeridian. Refinement starts at cells so
coarse that a few hold all points and sites. Cells that hold points, paired with cells that hold sites, are
refined step by step: a site cell is dropped once its least possible distance exceeds the greatest
possible distance of another site cell. A point cell is settled, at whatever size, once few sites are left to
it, or once it holds so few points that measuring them costs less than refining it. Each point then finds
its cell by one equi-join and measures only the sites that can be nearest from anywhere in the cell.

Where sites are few and the points' cells are not too many, both counted, there is no refinement: one pass over the
cells lists each cell's sites by comparing its centre with all of them, block by block. Only cells that keep too many are divided.

Points are written once, and everything else is derived from what has been written: a source that gives other
points when it is read again can therefore lose none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrid.functions import EARTH_RADIUS_M, haversine, on_earth, unit_vector
from casegrid.operators.rows import quoted
from casegrid.operators.storage import stored

AXES = ("x", "y", "z")
POINT_CELL = ("px", "py", "pz")
SITE_CELL = ("sx", "sy", "sz")
SITE = ("lon", "lat", "site", *AXES)
MAX_BITS = 24  # cells of about 0.8 m; cell arithmetic is exact in doubles and longs up to here
MAX_CANDIDATES = 128
STEP_BITS = 3  # how much finer each step of the refinement is
FEW_SITES, FEW_POINTS = 8, 64  # a cell is settled with so few sites in reach, or with so few points in it
MEASURED_IN_CODE = 8
SMALL_CELLS = 50_000  # tables of at most so many cells (some 50 bytes each) are broadcast
FEW_LOCATIONS, FEW_CELLS = 4096, 1 << 20  # site locations (some 100 bytes each) and point cells that are compared at once
BLOCK = 1 << 20  # distances in memory at a time


@dataclass(frozen=True)
class Grid:
    """Where refinement starts and may end, and the span of site cells per axis at its start."""

    n_sites: int
    shared: bool  # some location has several sites
    first_bits: int
    leaf_bits: int
    spans: list[tuple[int, int]]


def _with_axes(df: DataFrame) -> DataFrame:
    return df.withColumns(dict(zip(AXES, unit_vector(F.col("lon"), F.col("lat")))))


def _cell_values(bits: int) -> list[str]:
    """Index 0 .. 2**bits - 1 of every coordinate in [-1, 1]."""
    scale, top = 2.0 ** (bits - 1), 2**bits - 1
    return [f"cast(greatest(least(floor(({axis} + 1) * {scale!r}D), {top}L), 0L) AS int)" for axis in AXES]


def _cell_exprs(names: tuple[str, ...], bits: int) -> list[str]:
    return [f"{value} AS {name}" for name, value in zip(names, _cell_values(bits))]


def _coarser(names: tuple[str, ...], by: int, prefix: str = "") -> list[str]:
    return [f"shiftright({n}, {by}) AS {prefix}{n}" for n in names]


_BOUNDS = [f"{f}({a}) AS {f}_{a}" for f in ("min", "max") for a in AXES]


def _extent(*bounds) -> float:
    return max(max(b[f"max_{a}"] for b in bounds) - min(b[f"min_{a}"] for b in bounds) for a in AXES)


def _grid(sites: DataFrame, points) -> Grid | None:
    """Start where all points and sites span two cells per axis or fewer, aim at some eight cells per site.

    ``points`` are the bounds of the points.
    """
    bounds = sites.selectExpr("count(*) AS n", "max(here) AS most", *_BOUNDS).first()
    n = bounds["n"]
    if not n:
        return None
    spread, extent = _extent(bounds, points), _extent(bounds)
    first = MAX_BITS if spread <= 0 else max(0, min(MAX_BITS, math.floor(math.log2(2 / spread))))
    leaf = first
    if n > 1 and extent > 0:
        leaf = min(MAX_BITS, max(first, math.floor(math.log2(2 / extent)) + 2 + math.ceil(math.log2(n) / 2)))

    def index(value: float) -> int:
        return max(0, min(2**first - 1, math.floor((value + 1) * 2.0 ** (first - 1))))

    return Grid(n, bounds["most"] > 1, first, leaf, [(index(bounds[f"min_{a}"]), index(bounds[f"max_{a}"])) for a in AXES])


class _Cells:
    """Occupied point cells with their points (stored once) and site cells, at any coarser grid; small ones broadcast."""

    def __init__(self, points: DataFrame, bits: int, sites: DataFrame, grid: Grid):
        counted = Observation()
        occupied = points.selectExpr(*_cell_exprs(POINT_CELL, bits)).groupBy(*POINT_CELL).agg(F.count("*").alias("here"))
        self.occupied = stored(occupied.observe(counted, F.count("*").alias("n")))
        self.bits = bits
        self.sites = sites
        self.n = counted.get["n"] or 0
        self.few_points = self.n <= SMALL_CELLS
        self.few_sites = grid.n_sites <= SMALL_CELLS

    def point_cells(self, bits: int, parent: int = 0) -> DataFrame:
        cells = self.occupied.selectExpr("here", *_coarser(POINT_CELL, self.bits - bits))
        cells = cells.groupBy(*POINT_CELL).agg(F.sum("here").alias("here"))
        cells = cells.selectExpr(*POINT_CELL, "here", *_coarser(POINT_CELL, parent, "up_"))
        return F.broadcast(cells) if self.few_points else cells

    def site_cells(self, bits: int, parent: int = 0) -> DataFrame:
        cells = self.sites.selectExpr(*_cell_exprs(SITE_CELL, bits))
        cells = cells.groupBy(*SITE_CELL).agg(F.count("*").alias("n"))
        cells = cells.selectExpr(*SITE_CELL, "n", *_coarser(SITE_CELL, parent, "up_"))
        return F.broadcast(cells) if self.few_sites else cells


def _prune(pairs: DataFrame) -> DataFrame:
    """Per point cell, drop the site cells that cannot hold a nearest site. Whole numbers only.

    ``within`` is a bound known beforehand (square of a distance, in cells); it thins out the pairs
    before they are shuffled. ``bound`` is the one found here.
    """
    gaps = [f"cast(abs({p} - {s}) AS bigint)" for p, s in zip(POINT_CELL, SITE_CELL)]
    near = " + ".join(f"greatest({g} - 1, 0L) * greatest({g} - 1, 0L)" for g in gaps)
    far = " + ".join(f"({g} + 1) * ({g} + 1)" for g in gaps)
    cell = ", ".join(POINT_CELL)
    return (
        pairs.selectExpr(*POINT_CELL, "here", *SITE_CELL, "n", "within", f"{near} AS near", f"{far} AS far")
        .filter("near <= within")
        .selectExpr("*", f"min(far) OVER (PARTITION BY {cell}) AS bound")
        .filter("near <= bound")
        .selectExpr(*POINT_CELL, "here", *SITE_CELL, "bound", f"sum(n) OVER (PARTITION BY {cell}) AS reach")
    )


def _start(cells: _Cells, grid: Grid) -> DataFrame:
    pairs = cells.point_cells(grid.first_bits).selectExpr(*POINT_CELL, "here", f"{2**62}L AS within")
    for axis, (low, high) in zip(SITE_CELL, grid.spans):
        pairs = pairs.selectExpr("*", f"explode(sequence({low}, {high})) AS {axis}")
    return _prune(pairs.join(cells.site_cells(grid.first_bits), list(SITE_CELL)))


def _descend(pairs: DataFrame, cells: _Cells, low: int, high: int) -> DataFrame:
    """Replace every (point cell, site cell) by the pairs of their occupied sub-cells, then prune."""
    parents = pairs.selectExpr(
        *[f"{n} AS up_{n}" for n in (*POINT_CELL, *SITE_CELL)], f"bound * {4 ** (high - low)}L AS within"
    )
    return _prune(
        parents.join(cells.point_cells(high, high - low), ["up_" + n for n in POINT_CELL]).join(
            cells.site_cells(high, high - low), ["up_" + n for n in SITE_CELL]
        )
    )


def _candidates(pairs: DataFrame, sites: DataFrame, bits: int) -> DataFrame:
    """Per point cell, the array of site locations that can be nearest from somewhere in the cell.

    With h half the cell's diagonal: a site farther from the centre than the least such distance plus
    2h is nearest from nowhere in the cell.
    """
    side = 2.0 ** (1 - bits)
    slack = side * math.sqrt(3) * (1 + 1e-9) + 1e-15
    offsets = [f"({a} - (({c} + 0.5D) * {side!r}D - 1))" for a, c in zip(AXES, POINT_CELL)]
    to_centre = " + ".join(f"{o} * {o}" for o in offsets)
    cell = ", ".join(POINT_CELL)
    return (
        pairs.select(*POINT_CELL, *SITE_CELL)
        .join(sites.selectExpr("*", *_cell_exprs(SITE_CELL, bits)), list(SITE_CELL))
        .selectExpr(*POINT_CELL, "lon", "lat", "site", *AXES, f"sqrt({to_centre}) AS to_centre")
        .selectExpr("*", f"min(to_centre) OVER (PARTITION BY {cell}) AS least")
        .filter(f"to_centre <= least + {slack!r}D")
        .groupBy(*POINT_CELL)
        .agg(F.collect_list(F.struct(*SITE)).alias("sites"))
    )


def _listed(cells: DataFrame, sites: DataFrame, located: pa.Table, bits: int) -> DataFrame:
    """(bits, point cell, here, sites) like `_candidates`, by comparing every cell's centre with all ``located`` sites."""
    side = 2.0 ** (1 - bits)
    slack = side * math.sqrt(3) * (1 + 1e-9) + 1e-15
    kind = T.ArrayType(T.StructType([sites.schema[name] for name in SITE]))
    cell = [T.StructField(name, T.IntegerType()) for name in POINT_CELL]
    schema = T.StructType([T.StructField("bits", T.IntegerType()), *cell, T.StructField("here", T.LongType()), T.StructField("sites", kind)])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes = [located.column(a).to_numpy() for a in AXES]
        members = pa.StructArray.from_arrays([located.column(name).combine_chunks() for name in SITE], names=list(SITE))
        step = max(1, BLOCK // max(1, len(members)))
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                square = np.zeros((part.num_rows, len(members)))
                for k, axis in enumerate(axes):
                    centre = (part.column(k).to_numpy() + 0.5) * side - 1
                    square += (centre[:, None] - axis[None, :]) ** 2
                to_centre = np.sqrt(square)
                row, near = np.nonzero(to_centre <= to_centre.min(axis=1, keepdims=True) + slack)
                offsets = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), members.take(pa.array(near)))
                size = pa.array(np.full(part.num_rows, bits, np.int32))
                yield pa.RecordBatch.from_arrays([size, *part.columns, lists], names=schema.names)

    return cells.select(*POINT_CELL, "here").mapInArrow(listed, schema)


def _leaves_at_once(points: DataFrame, cells: _Cells, sites: DataFrame, max_candidates: int) -> tuple[DataFrame, list[int]]:
    """`_leaves` for few sites and cells: cells that keep more than ``max_candidates`` sites and FEW_POINTS points are divided."""
    located = sites.select(*SITE).toArrow()  # at most FEW_LOCATIONS rows
    crowded = (F.size("sites") > max_candidates) & (F.col("here") > FEW_POINTS) & (F.col("bits") < MAX_BITS)
    settled, sizes, bits, occupied = [], [], cells.bits, cells.occupied
    while True:
        counts = Observation()
        judged = _listed(occupied, sites, located, bits).withColumn("crowded", crowded)
        judged = stored(judged.observe(counts, F.count_if("crowded").alias("open")))
        settled.append(judged.filter("not crowded").drop("crowded", "here"))
        sizes.append(bits)
        if not counts.get["open"]:
            return reduce(DataFrame.unionByName, settled), sizes
        rest = judged.filter("crowded").select(*POINT_CELL)
        remaining = points.selectExpr(*AXES, *_cell_exprs(POINT_CELL, bits)).join(rest, list(POINT_CELL), "left_semi")
        bits = min(bits + STEP_BITS, MAX_BITS)
        occupied = remaining.selectExpr(*_cell_exprs(POINT_CELL, bits)).groupBy(*POINT_CELL).agg(F.count("*").alias("here"))


def _leaves(points: DataFrame, sites: DataFrame, grid: Grid, max_candidates: int) -> tuple[DataFrame, list[int]]:
    """Stored (bits, point cell, sites), and the grid sizes in use; every point's cell is there at exactly one size.

    At the finest size cells keep all sites in reach.
    """
    cells = _Cells(points, grid.leaf_bits, sites, grid)
    if grid.n_sites <= FEW_LOCATIONS and cells.n <= FEW_CELLS:
        return _leaves_at_once(points, cells, sites, max_candidates)
    return _leaves_by_steps(points, cells, sites, grid, max_candidates)


def _leaves_by_steps(
    points: DataFrame, cells: _Cells, sites: DataFrame, grid: Grid, max_candidates: int
) -> tuple[DataFrame, list[int]]:
    bits = grid.first_bits
    pairs, settled = _start(cells, grid), []
    while True:
        enough = F.col("reach") <= FEW_SITES
        enough |= (F.col("reach") <= max_candidates) & ((F.col("here") <= FEW_POINTS) | F.lit(bits >= grid.leaf_bits))
        enough |= F.lit(bits == MAX_BITS)
        counts = Observation()
        judged = pairs.select("*", enough.alias("enough"))
        judged = stored(judged.observe(counts, F.count_if("enough").alias("done"), F.count_if(~F.col("enough")).alias("open")))
        if counts.get["done"]:
            settled.append((bits, judged.filter("enough")))
        if not counts.get["open"]:
            break
        crowded = judged.filter("not enough")
        finer = min(bits + STEP_BITS, grid.leaf_bits if bits < grid.leaf_bits else MAX_BITS)
        if finer > cells.bits:
            remaining = points.selectExpr(*AXES, *_cell_exprs(POINT_CELL, bits)).join(
                crowded.select(*POINT_CELL).distinct(), list(POINT_CELL), "left_semi"
            )
            cells = _Cells(remaining, MAX_BITS, sites, grid)
        pairs = _descend(crowded, cells, bits, finer)
        bits = finer
    lists = [_candidates(done, sites, size).select(F.lit(size).alias("bits"), *POINT_CELL, "sites") for size, done in settled]
    return stored(reduce(DataFrame.unionByName, lists)), [size for size, _ in settled]


def _located(df: DataFrame, lon: str, lat: str, **others: str) -> DataFrame:
    out = df.select(
        *[F.col(quoted(c)).alias(name) for name, c in others.items()],
        F.col(quoted(lon)).cast("double").alias("lon"),
        F.col(quoted(lat)).cast("double").alias("lat"),
    )
    return out.filter(on_earth(F.col("lon"), F.col("lat")))


def _with_candidates(
    points: DataFrame, sites: DataFrame, max_candidates: int
) -> tuple[DataFrame, bool]:
    """Points with the array ``sites`` of the locations that can be nearest to them.

    The ``site`` of a location is one of its sites; the flag tells whether some location has more.
    """
    seen = Observation()
    bounds = [F.expr(bound) for bound in _BOUNDS]
    located = stored(_with_axes(points).observe(seen, F.count("*").alias("n"), *bounds))
    locations = _with_axes(sites.groupBy("lon", "lat").agg(F.count("*").alias("here"), F.min("site").alias("site")))
    grid = _grid(locations, seen.get) if seen.get["n"] else None
    if grid is None:
        nowhere = F.array(F.struct("lon", "lat", F.lit(None).cast(sites.schema["site"].dataType).alias("site"), *AXES))
        return located.select("*", nowhere.alias("sites")).filter(F.lit(False)), False
    leaves, sizes = _leaves(located.select(*AXES), locations, grid, max_candidates)
    addresses = ", ".join(
        f"named_struct('bits', {bits}, {', '.join(f'{e!r}, {x}' for e, x in zip(POINT_CELL, _cell_values(bits)))})"
        for bits in sizes
    )
    addressed = located.selectExpr("*", f"inline(array({addresses}))")
    return addressed.join(leaves, ["bits", *POINT_CELL]).select(*located.columns, "sites"), grid.shared


def _closest(candidates: DataFrame, radius_m: float) -> DataFrame:
    """One row per point and closest location; several only where distances are equal.

    Straight-line distances, which are cheap, leave the candidates that differ from the least by no
    more than rounding; where that is more than one, great-circle distances decide. Lists of up to
    ``MEASURED_IN_CODE`` candidates are measured in generated code, longer ones by array functions.
    """
    rest = [c for c in candidates.columns if c not in ("sites", *AXES)]
    members = [f"get(sites, {i})" for i in range(MEASURED_IN_CODE)]
    squares = [f"square{i}" for i in range(MEASURED_IN_CODE)]
    longer = f"size(sites) > {MEASURED_IN_CODE}"
    close = [f"coalesce({q} <= bound, false)" for q in squares]
    only = " ".join(f"WHEN {c} THEN {m}" for c, m in zip(close, members))
    return (
        candidates.selectExpr(
            *rest,
            *AXES,
            "sites",
            *[f"{_square(m)} AS {q}" for m, q in zip(members, squares)],
            f"CASE WHEN {longer} THEN transform(sites, s -> {_square('s')}) END AS squares",
        )
        .selectExpr(
            "*",
            f"pow(sqrt(CASE WHEN {longer} THEN array_min(squares) ELSE least({', '.join(squares)}) END)"
            " + 2e-15D, 2) AS bound",
        )
        .selectExpr(
            *rest,
            f"CASE WHEN {longer} THEN filter(sites, (s, i) -> element_at(squares, i + 1) <= bound)"
            f" WHEN {' + '.join(f'int({c})' for c in close)} = 1 THEN array(CASE {only} END)"
            f" ELSE filter(sites, s -> {_square('s')} <= bound) END AS sites",
        )
        .select(
            *rest,
            F.inline(
                F.when(F.size("sites") == 1, F.col("sites")).otherwise(_least(radius_m))
            ).alias("site_lon", "site_lat", "site", *AXES),
        )
        .select(*rest, "site_lon", "site_lat", "site")
        .withColumn(
            "distance_m",
            haversine(F.col("lon"), F.col("lat"), F.col("site_lon"), F.col("site_lat"), radius_m),
        )
    )


def _square(site: str) -> str:
    """Square of the straight-line distance between the point and a site."""
    return " + ".join(f"({site}.{a} - {a}) * ({site}.{a} - {a})" for a in AXES)


def _least(radius_m: float):
    """The members of ``sites`` at the least great-circle distance."""

    def distance(s):
        return haversine(F.col("lon"), F.col("lat"), s["lon"], s["lat"], radius_m)

    least = F.array_min(F.transform("sites", distance))
    return F.filter("sites", lambda s: distance(s) == least)


def _closest_by_rank(candidates: DataFrame, radius_m: float) -> DataFrame:
    """`_closest` by a window over one row per candidate; it shuffles by point id."""
    distance = haversine(F.col("lon"), F.col("lat"), F.col("site_lon"), F.col("site_lat"), radius_m)
    by_point = Window.partitionBy("id").orderBy("distance_m")
    return (
        candidates.selectExpr("id", "lon", "lat", "explode(sites) AS s")
        .selectExpr("id", "lon", "lat", "s.lon AS site_lon", "s.lat AS site_lat", "s.site AS site")
        .withColumn("distance_m", distance)
        .withColumn("place", F.rank().over(by_point))
        .filter("place = 1")
    )


def nearest(
    points: DataFrame,
    sites: DataFrame,
    *,
    point_id: str,
    lon: str,
    lat: str,
    site_id: str,
    site_lon: str,
    site_lat: str,
    radius_m: float = EARTH_RADIUS_M,
    method: str = "array",
    max_candidates: int = MAX_CANDIDATES,
) -> DataFrame:
    """(id, site, distance_m): the nearest site of every point, one row per site where several tie.

    Points and sites without finite coordinates in range are left out. ``method='window'`` ranks the candidates with a
    window over ``point_id`` (which must be unique) and gives the same rows.
    """
    if method not in ("array", "window"):
        raise ValueError(f"method must be 'array' or 'window', not {method!r}")
    spots = _located(sites, site_lon, site_lat, site=site_id)
    candidates, shared = _with_candidates(_located(points, lon, lat, id=point_id), spots, max_candidates)
    closest = (_closest if method == "array" else _closest_by_rank)(candidates, radius_m)
    if shared:
        spots = spots.withColumnsRenamed({"lon": "site_lon", "lat": "site_lat"})
        closest = closest.drop("site").join(spots, ["site_lon", "site_lat"])
    return closest.select("id", "site", "distance_m")


def nearest_summary(
    points: DataFrame,
    sites: DataFrame,
    *,
    lon: str,
    lat: str,
    site_id: str,
    site_lon: str,
    site_lat: str,
    radius_m: float = EARTH_RADIUS_M,
    max_candidates: int = MAX_CANDIDATES,
) -> DataFrame:
    """(site, count, mean_m): points nearest to each site and their mean distance, ties counted at each.

    Equal points are counted first, in the only pass over ``points``, and measured once; sites at one
    location are measured once too, and join only the finished figures of their location.
    """
    spots = _located(sites, site_lon, site_lat, site=site_id)
    places = stored(_located(points, lon, lat).groupBy("lon", "lat").agg(F.count("*").alias("n")))
    candidates, _ = _with_candidates(places, spots, max_candidates)
    closest = _closest(candidates, radius_m)
    per_location = closest.groupBy("site_lon", "site_lat").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("distance_m")).alias("metres")
    )
    spots = spots.withColumnsRenamed({"lon": "site_lon", "lat": "site_lat"})
    return (
        per_location.join(spots, ["site_lon", "site_lat"])
        .groupBy("site")
        .agg(F.sum("n").alias("count"), (F.sum("metres") / F.sum("n")).alias("mean_m"))
    )
