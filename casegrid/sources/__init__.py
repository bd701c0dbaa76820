from casegrid.sources.catalogue import Catalogue, Dataset, WrongSchema
from casegrid.sources.feature_files import read_feature_collections, read_feature_texts
from casegrid.sources.features import geojson_features, geojson_geometries, read_geojson_features
from casegrid.sources.inference import infer_types, profile_columns, read_inferred, split_typed
from casegrid.sources.tables import (
    INCIDENT_TYPES,
    parse_code_dictionary,
    parse_income,
    read_code_dictionary,
    read_incidents,
    read_income,
    read_lookup,
)

__all__ = [
    "INCIDENT_TYPES",
    "Catalogue",
    "Dataset",
    "WrongSchema",
    "geojson_features",
    "geojson_geometries",
    "infer_types",
    "parse_code_dictionary",
    "parse_income",
    "profile_columns",
    "read_code_dictionary",
    "read_feature_collections",
    "read_feature_texts",
    "read_geojson_features",
    "read_incidents",
    "read_income",
    "read_inferred",
    "read_lookup",
    "split_typed",
]
