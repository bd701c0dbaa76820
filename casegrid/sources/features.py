"""GeoJSON, one Feature per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.functions.geometry import register_geometry

# The marker of a feature line and the fields read from it.
FEATURE_MARKER = '"type": "Feature"'
PROPERTIES = "COMM STRING, ZCTA20 STRING, POP20 BIGINT"

_RING = "ARRAY<ARRAY<DOUBLE>>"


def geojson_features(lines: DataFrame, properties: str = PROPERTIES, marker: str = FEATURE_MARKER) -> DataFrame:
    """The ``properties`` fields as columns, and ``coordinates`` in MultiPolygon form.

    The raw-line filter runs before any JSON is parsed. Lines may end in a comma. A feature whose geometry is no
    polygon keeps its properties, with NULL as coordinates.
    """
    line = F.col(lines.columns[0])
    schema = f"properties STRUCT<{properties}>, geometry STRUCT<type: STRING, coordinates: STRING>"
    parsed = lines.filter(F.contains(line, F.lit(marker))).select(F.from_json(line, schema).alias("f"))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    coordinates = F.when(
        kind == "Polygon", F.array(F.from_json(text, f"ARRAY<{_RING}>"))
    ).when(kind == "MultiPolygon", F.from_json(text, f"ARRAY<ARRAY<{_RING}>>"))
    whole = F.when(~F.exists(coordinates, lambda polygon: polygon.isNull()), coordinates)
    return parsed.filter(F.col("f").isNotNull()).select("f.properties.*", whole.alias("coordinates"))


def geojson_geometries(lines: DataFrame, properties: str = PROPERTIES, marker: str = FEATURE_MARKER) -> DataFrame:
    """The ``properties`` fields as columns, and ``geometry`` of any kind as the tagged struct of `functions.geometry`.

    A feature whose geometry is missing or no geometry keeps its properties, with NULL as geometry.
    """
    register_geometry(lines.sparkSession)
    line = F.col(lines.columns[0])
    features = lines.filter(F.contains(line, F.lit(marker)))
    fields = F.from_json(F.get_json_object(line, "$.properties"), properties)
    parsed = features.select(fields.alias("p"), F.get_json_object(line, "$.geometry").alias("g"))
    return parsed.filter(F.col("p").isNotNull()).selectExpr("p.*", "geo_geometry(g) AS geometry")


def read_geojson_features(spark: SparkSession, path: str, properties: str = PROPERTIES) -> DataFrame:
    return geojson_features(spark.read.text(path), properties)
