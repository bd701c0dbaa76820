"""Grid joins against brute force over every pair, on small data chosen to be awkward."""

import math
import random

import pytest
from pyspark.sql import functions as F

from casegrid.functions import haversine, inside, polygon_edges
from casegrid.operators import contains
from casegrid.operators.contains import _cells_of, join_contains
from casegrid.operators.nearest import nearest, nearest_summary

POINTS = "id int, lon double, lat double"
SITES = "site int, x double, y double"
NAMES = {"lon": "lon", "lat": "lat", "site_id": "site", "site_lon": "x", "site_lat": "y"}


def brute_nearest(points, sites):
    """Spark's own numbers for every pair, so that ties compare equal."""
    pairs = points.join(sites, F.lit(True)).filter("lon IS NOT NULL AND lat IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL")
    d = haversine(F.col("lon"), F.col("lat"), F.col("x"), F.col("y"))
    best = {}
    for r in pairs.select("id", "site", d.alias("d")).collect():
        best.setdefault(r["id"], []).append((r["d"], r["site"]))
    return sorted((i, s) for i, found in best.items() for dist, s in found if dist == min(found)[0])


def uniform(rng, n, lon=(-180, 180), lat=(-90, 90)):
    return [(i, rng.uniform(*lon), rng.uniform(*lat)) for i in range(n)]


def case(name):
    rng = random.Random(name)
    city = {"lon": (-118.7, -118.1), "lat": (33.7, 34.3)}
    if name == "city":
        return uniform(rng, 300, **city), uniform(rng, 40, **city)
    if name == "globe":
        edge = [(1000 + i, float(lon), float(lat)) for i, (lon, lat) in enumerate([(180, 0), (-180, 0), (179.99, 5), (0, 90), (7, -90)])]
        return uniform(rng, 200) + edge, uniform(rng, 60) + [(100, -179.99, 5.0), (101, 33.0, 90.0), (102, 0.0, -90.0)]
    if name == "far sites":
        return uniform(rng, 150), uniform(rng, 50, **city)
    if name == "hot spot":
        # a third of the points and of the sites inside one small square, and many equal points
        dense = {"lon": (-118.4001, -118.4), "lat": (34.0, 34.0001)}
        points = uniform(rng, 100, **city) + [(i + 1000, a, b) for i, a, b in uniform(rng, 50, **dense)]
        points += [(i + 2000, -118.40005, 34.00005) for i in range(50)]
        return points, uniform(rng, 60, **city) + [(i + 1000, a, b) for i, a, b in uniform(rng, 40, **dense)]
    if name == "copies":
        return uniform(rng, 40, **city), [(i, -118.3 - 0.1 * (i % 2), 34.0) for i in range(20)] + [(99, None, 34.0)]
    if name == "lattice":
        spots = [(i, float(i % 9 - 4), float(i // 9 - 4)) for i in range(81)]
        return [(i, lon / 2, lat / 2) for i, lon, lat in spots] + [(100, None, 1.0)], spots[::2]
    if name == "one site":
        return uniform(rng, 20), [(7, 10.0, 10.0)]
    if name == "no site":
        return uniform(rng, 20), [(7, None, 10.0)]
    raise ValueError(name)


CASES = ["city", "globe", "far sites", "hot spot", "copies", "lattice", "one site", "no site"]


@pytest.mark.parametrize("name", CASES)
def test_nearest_equals_brute_force(spark, name):
    points, sites = case(name)
    points, sites = spark.createDataFrame(points, POINTS), spark.createDataFrame(sites, SITES)
    expected = brute_nearest(points, sites)
    found = nearest(points, sites, point_id="id", **NAMES).collect()
    assert sorted((r["id"], r["site"]) for r in found) == expected


@pytest.mark.parametrize("name", ["hot spot", "copies", "no site"])
def test_nearest_summary_counts_every_tie(spark, name):
    points, sites = case(name)
    points, sites = spark.createDataFrame(points, POINTS), spark.createDataFrame(sites, SITES)
    expected = brute_nearest(points, sites)
    counts = {r["site"]: r["count"] for r in nearest_summary(points, sites, **NAMES).collect()}
    assert counts == {s: sum(site == s for _, site in expected) for s in {site for _, site in expected}}


@pytest.mark.parametrize("name", ["hot spot", "far sites"])
def test_crowded_cells_go_through_finer_tiers(spark, name):
    points, sites = case(name)
    points, sites = spark.createDataFrame(points, POINTS), spark.createDataFrame(sites, SITES)
    found = nearest(points, sites, point_id="id", max_candidates=6, **NAMES)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("bits") >= 2
    assert sorted((r["id"], r["site"]) for r in found.collect()) == brute_nearest(points, sites)


def test_a_source_that_changes_loses_no_point(spark):
    """The points are read once, so each keeps its place whatever a second reading would give."""
    points = spark.range(0, 200, numPartitions=4).selectExpr("cast(id AS int) AS id", "rand() * 360 - 180 AS lon", "rand() * 180 - 90 AS lat")
    sites = spark.createDataFrame(uniform(random.Random(1), 40), SITES)
    found = nearest(points, sites, point_id="id", **NAMES)
    assert found.select("id").distinct().count() == 200


def test_no_point_and_one_hot_cell(spark):
    sites = spark.createDataFrame(uniform(random.Random(2), 40), SITES)
    assert nearest(spark.createDataFrame([], POINTS), sites, point_id="id", **NAMES).count() == 0
    crowd = [(i, 10.0, 10.0) for i in range(3000)] + [(i + 5000, x, y) for i, x, y in uniform(random.Random(3), 100)]
    points = spark.createDataFrame(crowd, POINTS)
    found = sorted((r["id"], r["site"]) for r in nearest(points, sites, point_id="id", **NAMES).collect())
    assert found == brute_nearest(points, sites)


def test_compact_sites_and_spread_points_need_few_pairs(spark, monkeypatch):
    """Far points are measured against all sites at once instead of being refined."""
    from casegrid.operators import nearest as module

    pairs = []
    judged = module._prune
    monkeypatch.setattr(module, "_prune", lambda table: pairs.append(judged(table)) or pairs[-1])
    rng = random.Random(4)
    points = spark.createDataFrame(uniform(rng, 4000), POINTS)
    sites = spark.createDataFrame(uniform(rng, 50, lon=(-118.41, -118.4), lat=(34.0, 34.01)), SITES)
    found = nearest(points, sites, point_id="id", **NAMES)
    assert sum(table.count() for table in pairs) < 4000
    assert found.select("id").distinct().count() == 4000


def test_many_vertices_are_listed_in_small_cells(spark):
    ring = [[math.cos(2 * math.pi * (i % 5000) / 5000), math.sin(2 * math.pi * (i % 5000) / 5000)] for i in range(5001)]
    disc = spark.createDataFrame([("disc", [[ring]])], "key string, coordinates array<array<array<array<double>>>>")
    rng = random.Random(5)
    spots = [(i, rng.uniform(-1.2, 1.2), rng.uniform(-1.2, 1.2)) for i in range(500)]
    found = join_contains(spark.createDataFrame(spots, POINTS), disc, lon="lon", lat="lat")
    # between the two circles only the polygon itself could tell
    clear = [(i, x * x + y * y < 1) for i, x, y in spots if abs(x * x + y * y - 1) > 1e-5]
    inner = {r["id"] for r in found.collect()}
    assert inner & {i for i, _ in clear} == {i for i, within in clear if within}
    assert _cells_of(disc, "coordinates").selectExpr("max(size(_edges))").first()[0] <= 64


@pytest.mark.parametrize("boundary", ["exclude", "half_open"])
def test_chunks_of_edges_give_the_same_rows(spark, monkeypatch, boundary):
    """Cells that stay crowded are tested chunk by chunk; holes, parts, corners and repeated points included."""
    monkeypatch.setattr(contains, "CHUNK", 4)
    monkeypatch.setattr(contains, "MANY_EDGES", 6)
    monkeypatch.setattr(contains, "MAX_DIVISIONS", 1)
    rng = random.Random(boundary)
    made = areas(rng)
    corners = [c for _, parts in made for rings in parts for ring in rings for c in ring[:3]]
    spots = [(rng.uniform(-25, 25), rng.uniform(-25, 25)) for _ in range(300)]
    spots += [(p[0][0][0][0] + rng.gauss(0, 0.01), p[0][0][0][1] + rng.gauss(0, 0.01)) for _, p in made for _ in range(9)]
    spots += [(float(x), float(y)) for x, y in corners]
    spots += spots[-20:]
    points = spark.createDataFrame([(i // 2, x, y) for i, (x, y) in enumerate(spots)], POINTS)
    polygons = spark.createDataFrame(made, "key string, coordinates array<array<array<array<double>>>>")
    every_pair = points.join(polygons, F.lit(True)).filter(
        inside(polygon_edges(F.col("coordinates")), F.col("lon"), F.col("lat"), boundary)
    )
    expected = sorted((r["id"], r["lon"], r["key"]) for r in every_pair.collect())
    cells = _cells_of(polygons, "coordinates")
    assert cells.filter("_parts > 1").count() > 50 and cells.selectExpr("max(size(_edges))").first()[0] <= 6
    found = join_contains(points, polygons, lon="lon", lat="lat", boundary=boundary)
    assert found.columns == ["id", "lon", "lat", "key"]
    assert sorted((r["id"], r["lon"], r["key"]) for r in found.collect()) == expected
    assert len(expected) > 100


def test_many_edges_in_one_place(spark):
    """A square with a saw of 12,000 teeth in one corner: that cell stays crowded at any fineness, no row holds more than a chunk."""
    saw = [[1e-6 * (i + 1) / 24002, 1e-6 * (1 - i % 2)] for i in range(24001)]
    ring = [[1.0, -1.0], [1.0, 1.0], [0.0, 1.0], *saw]
    disc = spark.createDataFrame([("saw", [[[*ring, ring[0]]]])], "key string, coordinates array<array<array<array<double>>>>")
    rng = random.Random(3)
    spots = [(i, rng.uniform(-0.1, 1.1) * 10.0 ** -(i % 9), rng.uniform(-0.1, 1.1) * 10.0 ** -(i % 9)) for i in range(300)]
    spots += [(1000 + i, rng.uniform(0, 1e-6), rng.uniform(0, 1e-6)) for i in range(100)]
    points = spark.createDataFrame(spots, POINTS)
    cells = _cells_of(disc, "coordinates")
    assert cells.filter("_parts > 1").count() and cells.selectExpr("max(size(_edges))").first()[0] <= contains.CHUNK
    edges = [(*min(p, q, key=lambda c: c[1]), *max(p, q, key=lambda c: c[1])) for p, q in zip(ring, [*ring[1:], ring[0]])]

    def held(x, y):
        return sum(b <= y < d and (x - a) * (d - b) - (c - a) * (y - b) < 0 for a, b, c, d in edges) % 2 == 1

    expected = sorted(i for i, x, y in spots if abs(y) <= 90 and held(x, y))
    found = join_contains(points, disc, lon="lon", lat="lat")
    assert sorted(r["id"] for r in found.collect()) == expected and len(expected) > 100


def test_window_method_gives_the_same_rows(spark):
    points, sites = case("lattice")
    points, sites = spark.createDataFrame(points, POINTS), spark.createDataFrame(sites, SITES)
    both = [
        sorted(map(tuple, nearest(points, sites, point_id="id", method=m, **NAMES).collect()))
        for m in ("array", "window")
    ]
    assert both[0] == both[1]
    with pytest.raises(ValueError):
        nearest(points, sites, point_id="id", method="other", **NAMES)


@pytest.mark.parametrize("name", ["city", "copies"])
def test_nearest_without_any_broadcast(spark, monkeypatch, name):
    monkeypatch.setattr("casegrid.operators.nearest.SMALL_CELLS", 0)
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in settings:
        spark.conf.set(key, "-1")
    try:
        points, sites = case(name)
        points, sites = spark.createDataFrame(points, POINTS), spark.createDataFrame(sites, SITES)
        found = nearest(points, sites, point_id="id", **NAMES)
        assert sorted((r["id"], r["site"]) for r in found.collect()) == brute_nearest(points, sites)
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_tie_gives_a_row_per_site(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], POINTS)
    sites = spark.createDataFrame([(1, -1.0, 0.0), (2, 1.0, 0.0), (3, 0.0, 1.5)], SITES)
    found = nearest(points, sites, point_id="id", **NAMES).collect()
    assert sorted(r["site"] for r in found) == [1, 2]
    assert {round(r["distance_m"], 3) for r in found} == {111195.066}


def test_nearest_pairs_cells_and_not_rows(spark):
    points, sites = case("city")
    points, sites = spark.createDataFrame(points, POINTS), spark.createDataFrame(sites, SITES)
    plan = nearest(points, sites, point_id="id", **NAMES)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "hashpartitioning(id" not in plan


def star(rng, x, y, radius, corners):
    """A ring around (x, y) that is far from convex, on binary fractions so that tests are exact."""
    ring = []
    for i in range(corners):
        r = radius * (0.3 + 0.7 * rng.random())
        a = 2 * math.pi * i / corners
        ring.append([round((x + r * math.cos(a)) * 4096) / 4096, round((y + r * math.sin(a)) * 4096) / 4096])
    return [*ring, ring[0]]


def areas(rng):
    """Polygons over five orders of size, some with a hole, some in several parts, overlapping."""
    made = []
    for i in range(24):
        radius = 10 ** rng.uniform(-2, 1.5)
        x, y = rng.uniform(-20, 20), rng.uniform(-20, 20)
        rings = [star(rng, x, y, radius, rng.choice([3, 7, 40]))]
        if i % 3 == 0:
            rings.append(star(rng, x, y, radius / 5, 5))
        parts = [rings] if i % 4 else [rings, [star(rng, x + 3 * radius, y, radius, 6)]]
        made.append((f"p{i}", parts))
    return made


@pytest.mark.parametrize("boundary", ["exclude", "half_open"])
def test_contains_equals_brute_force(spark, boundary):
    rng = random.Random(boundary)
    made = areas(rng)
    corners = [c for _, parts in made for rings in parts for ring in rings for c in ring[:3]]
    spots = [(rng.uniform(-25, 25), rng.uniform(-25, 25)) for _ in range(400)]
    spots += [(p[0][0][0][0] + rng.gauss(0, 0.01), p[0][0][0][1] + rng.gauss(0, 0.01)) for _, p in made for _ in range(5)]
    spots += [(float(x), float(y)) for x, y in corners]
    spots += [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in zip(corners, corners[1:])]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], POINTS)
    polygons = spark.createDataFrame(made, "key string, coordinates array<array<array<array<double>>>>")
    every_pair = points.join(polygons, F.lit(True)).filter(
        inside(polygon_edges(F.col("coordinates")), F.col("lon"), F.col("lat"), boundary)
    )
    expected = sorted((r["id"], r["key"]) for r in every_pair.select("id", "key").collect())
    found = join_contains(points, polygons, lon="lon", lat="lat", boundary=boundary)
    assert sorted((r["id"], r["key"]) for r in found.collect()) == expected
    assert len(expected) > 100


def test_tiled_plane_holds_every_point_once(spark):
    """Half-open cells of a lattice share all edges and corners and leave no gap."""
    squares = [
        (f"{x},{y}", [[[[x, y], [x + 1.0, y], [x + 1.0, y + 1.0], [x, y + 1.0], [x, y]]]])
        for x in map(float, range(6))
        for y in map(float, range(6))
    ]
    polygons = spark.createDataFrame(squares, "key string, coordinates array<array<array<array<double>>>>")
    points = spark.range(0, 21 * 21).selectExpr("id", "id % 21 / 4D AS lon", "id div 21 / 4D AS lat")
    found = join_contains(points, polygons, lon="lon", lat="lat", boundary="half_open")
    assert found.count() == found.select("id").distinct().count() == 21 * 21


def test_a_hot_cell_is_split(spark):
    """A third of all points in one cell: the shuffled join splits that cell's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        spots = spark.range(0, 30000, numPartitions=8).selectExpr(
            "id",
            "CASE WHEN id % 3 = 0 THEN 0.5 + id / 1e9 ELSE id % 1000 / 10D END AS lon",
            "CASE WHEN id % 3 = 0 THEN 0.5 + id / 1e9 ELSE id % 997 / 10D END AS lat",
        )
        ring = [[0.0, 0.0], [100.0, 0.0], [100.0, 100.0], [0.0, 100.0], [0.0, 0.0]]
        polygons = spark.createDataFrame([("all", [[ring]])], "key string, coordinates array<array<array<array<double>>>>")
        found = join_contains(spots, polygons, lon="lon", lat="lat", boundary="half_open")
        assert found.count() == 30000 - spots.filter("lon >= 100 OR lat > 90").count()  # no place is further north
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("few", [0, 4096])
def test_nearest_by_steps_and_at_once(spark, monkeypatch, few):
    """Both ways of listing candidates, with cells that must be divided."""
    monkeypatch.setattr("casegrid.operators.nearest.FEW_LOCATIONS", few)
    monkeypatch.setattr("casegrid.operators.nearest.FEW_POINTS", 2)
    rng = random.Random(8)
    spots = [(k, rng.gauss(-118, 0.001), rng.gauss(34, 0.001)) for k in range(120)] + [(500, 20.0, 50.0), (501, 20.0, 50.0)]
    places = [(k, rng.gauss(-118, 0.002), rng.gauss(34, 0.002)) for k in range(300)] + [(k, rng.uniform(-180, 180), rng.uniform(-90, 90)) for k in range(300, 400)]
    points, sites = spark.createDataFrame(places, POINTS), spark.createDataFrame(spots, SITES)
    found = nearest(points, sites, point_id="id", max_candidates=5, **NAMES)
    assert sorted((r["id"], r["site"]) for r in found.collect()) == brute_nearest(points, sites)


def test_nearest_runs_few_jobs_while_it_is_built(spark):
    rng = random.Random(9)
    points = spark.createDataFrame([(k, rng.uniform(-119, -118), rng.uniform(33, 34)) for k in range(3000)], POINTS)
    sites = spark.createDataFrame([(k, rng.uniform(-119, -118), rng.uniform(33, 34)) for k in range(200)], SITES)
    spark.sparkContext.setJobGroup("nearest-jobs", "")
    try:
        found = nearest(points, sites, point_id="id", **NAMES)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("nearest-jobs")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(jobs) <= 10
    assert sorted((r["id"], r["site"]) for r in found.collect()) == brute_nearest(points, sites)
