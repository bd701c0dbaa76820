"""Column expressions on points (longitude, latitude in degrees) and polygons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean radius of the sphere that distances are taken on.
EARTH_RADIUS_M = 6_371_008.0

_TESTED_IN_CODE = 2  # edges per polygon and point that `inside` tests without an array function


def haversine(
    lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius_m: float = EARTH_RADIUS_M
) -> Column:
    """Great-circle distance in metres; NULL where a coordinate is NULL, NaN where one is not finite."""
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    # `least` alone would take NULL and NaN for 1
    return F.lit(2 * radius_m) * F.asin(F.sqrt(F.when((h > 1) & ~F.isnan(h), 1.0).otherwise(h)))


def on_earth(lon: Column, lat: Column) -> Column:
    """Whether both coordinates are there, finite and in range. NaN compares as larger than any number."""
    return F.coalesce((F.abs(lat) <= 90.0) & (F.abs(lon) <= 360.0), F.lit(False))


def unit_vector(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    """The point on the unit sphere; straight-line distance there orders like great-circle distance."""
    flat = F.cos(F.radians(lat))
    return flat * F.cos(F.radians(lon)), flat * F.sin(F.radians(lon)), F.sin(F.radians(lat))


def _edge(a: Column, b: Column) -> Column:
    """Edge with its lower end first, so that both polygons sharing it compute the same numbers."""
    swap = a[1] > b[1]
    return F.struct(
        F.when(swap, b[0]).otherwise(a[0]).alias("x1"),
        F.when(swap, b[1]).otherwise(a[1]).alias("y1"),
        F.when(swap, a[0]).otherwise(b[0]).alias("x2"),
        F.when(swap, a[1]).otherwise(b[1]).alias("y2"),
    )


def polygon_edges(coordinates: Column) -> Column:
    """All ring edges of a MultiPolygon (polygons -> rings -> points -> [lon, lat]) as one array."""
    rings = F.filter(F.flatten(coordinates), lambda ring: F.size(ring) > 1)
    return F.flatten(
        F.transform(
            rings,
            lambda ring: F.zip_with(
                F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), _edge
            ),
        )
    )


def _side(e: Column, lon: Column, lat: Column) -> Column:
    """Negative where the edge lies to the east of the point, zero where they are in line."""
    return (lon - e["x1"]) * (e["y2"] - e["y1"]) - (e["x2"] - e["x1"]) * (lat - e["y1"])


def inside(
    edges: Column, lon: Column, lat: Column, boundary: str = "exclude", crossed: Column | None = None
) -> Column:
    """Even-odd test of a point against the edges of `polygon_edges`; holes and many parts included.

    ``exclude``: points on an edge are outside. ``half_open``: a point on an edge shared by two
    polygons is inside exactly one of them. ``crossed`` tells whether the ray has crossed an odd number
    of edges that are not in ``edges``.
    """
    odd, on_edge = crossings(edges, lon, lat, boundary)
    if crossed is not None:
        odd = odd != crossed
    return odd if boundary == "half_open" else odd & ~on_edge


def crossings(edges: Column, lon: Column, lat: Column, boundary: str = "exclude") -> tuple[Column, Column]:
    """Whether an odd number of edges lies east of the point, and whether it is on one that ``boundary`` excludes.

    Lists of one polygon's edges can be judged apart: it holds the point if an odd number of them is odd.
    The first edges are tested in generated code; only lists that are longer go through array
    functions, which Spark interprets.
    """
    if boundary not in ("exclude", "half_open"):
        raise ValueError(f"boundary must be 'exclude' or 'half_open', not {boundary!r}")

    def crosses(e: Column) -> Column:
        return (e["y1"] <= lat) & (e["y2"] > lat) & (_side(e, lon, lat) < 0)

    def touches(e: Column) -> Column:
        return (
            lat.between(e["y1"], e["y2"])
            & lon.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & (_side(e, lon, lat) == 0)
        )

    first = [F.get(edges, F.lit(i)) for i in range(_TESTED_IN_CODE)]
    longer = F.size(edges) > _TESTED_IN_CODE
    further = F.filter(edges, lambda e, i: (i >= _TESTED_IN_CODE) & crosses(e))
    odd = longer & (F.size(further) % 2 == 1)
    for e in first:
        odd = odd != F.coalesce(crosses(e), F.lit(False))
    if boundary == "half_open":
        return odd, F.lit(False)
    on_edge = longer & F.exists(edges, touches)
    for e in first:
        on_edge = on_edge | F.coalesce(touches(e), F.lit(False))
    return odd, on_edge
