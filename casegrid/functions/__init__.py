from casegrid.functions.geo import (
    EARTH_RADIUS_M,
    crossings,
    haversine,
    inside,
    on_earth,
    polygon_edges,
    unit_vector,
)
from casegrid.functions.scalars import (
    AGE_BANDS,
    DATE_PATTERN,
    WHITESPACE,
    band,
    band_udf,
    matches_text,
    parse_money,
    year_of,
)

__all__ = [
    "AGE_BANDS",
    "DATE_PATTERN",
    "EARTH_RADIUS_M",
    "WHITESPACE",
    "band",
    "band_udf",
    "crossings",
    "haversine",
    "inside",
    "matches_text",
    "on_earth",
    "parse_money",
    "polygon_edges",
    "unit_vector",
    "year_of",
]
