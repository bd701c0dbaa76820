"""Named data sets: a name is bound to URIs, a format and a schema, as a view in Spark's own catalogue.

Binding checks the schema against the source, so that a file of another shape is refused before anything is computed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrid.operators.rows import quoted, union_incidents
from casegrid.sources.feature_files import read_feature_collections
from casegrid.sources.features import PROPERTIES, geojson_features
from casegrid.sources.tables import parse_code_dictionary


class WrongSchema(ValueError):
    """A source that lacks a column of its data set, or has it with another type; ``column`` is its name."""

    def __init__(self, dataset: str, column: str, why: str):
        super().__init__(f"data set {dataset}: column {column} {why}")
        self.dataset, self.column = dataset, column


@dataclass(frozen=True)
class Dataset:
    """``format`` is csv, parquet, json, orc, codes (lines of code and description), geojson (a feature a line)
    or collection (whole feature collections).

    ``types`` names the columns that are read; with ``strict`` a value of a csv that is no such value ends the query
    with an error, otherwise it becomes NULL. Properties of features are given by ``properties``.
    """

    name: str
    uris: str | Sequence[str]
    format: str = "csv"
    types: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, str] = field(default_factory=dict)
    strict: bool = False
    properties: str = PROPERTIES

    def paths(self) -> list[str]:
        return [self.uris] if isinstance(self.uris, str) else list(self.uris)

    def read(self, spark: SparkSession) -> DataFrame:
        return union_incidents(*[self._read(spark, path) for path in self.paths()])

    def _read(self, spark: SparkSession, path: str) -> DataFrame:
        if self.format == "codes":
            return parse_code_dictionary(spark.read.text(path))
        if self.format == "geojson":
            return geojson_features(spark.read.text(path), self.properties)
        if self.format == "collection":
            return read_feature_collections(spark, path, self.properties)
        options = {"header": "true", **self.options} if self.format == "csv" else dict(self.options)
        rows = spark.read.options(**options).format(self.format).load(path)
        if self.format == "csv":
            rows = rows.toDF(*[name.strip() for name in rows.columns])
        for name in self.types:
            if rows.columns.count(name) != 1:
                raise WrongSchema(self.name, name, "is missing" if name not in rows.columns else "is there more than once")
        if self.format == "csv":
            return rows.select(*[self._cast(name, kind).alias(name) for name, kind in self.types.items()] or ["*"])
        wanted = T.StructType.fromDDL(", ".join(f"{quoted(n)} {t}" for n, t in self.types.items())) if self.types else []
        for one in wanted:
            if rows.schema[one.name].dataType != one.dataType:
                raise WrongSchema(self.name, one.name, f"is {rows.schema[one.name].dataType.simpleString()}, not {one.dataType.simpleString()}")
        return rows.select(*map(quoted, self.types)) if self.types else rows

    def _cast(self, name: str, kind: str):
        value = F.col(quoted(name))
        cast = value.try_cast(kind)
        if not self.strict or kind == "string":
            return cast
        error = F.raise_error(F.concat(F.lit(f"data set {self.name}: column {name} is no {kind}: "), value)).cast(kind)
        return F.when(cast.isNull() & (F.trim(value) != ""), error).otherwise(cast)


class Catalogue:
    """Data sets by name. `bind` checks each and makes it a temporary view, so that SQL statements know it by its name."""

    def __init__(self, spark: SparkSession, datasets: Sequence[Dataset] = ()):
        self.spark, self.datasets = spark, {}
        for dataset in datasets:
            self.bind(dataset)

    def bind(self, dataset: Dataset) -> DataFrame:
        if dataset.name in self.datasets:
            raise ValueError(f"data set {dataset.name} is bound already")
        rows = dataset.read(self.spark)
        rows.createOrReplaceTempView(quoted(dataset.name))
        self.datasets[dataset.name] = dataset
        return rows

    def read(self, name: str) -> DataFrame:
        if name not in self.datasets:
            raise KeyError(f"no data set {name}; there are {', '.join(sorted(self.datasets)) or 'none'}")
        return self.spark.table(quoted(name))

    def unbind(self, name: str) -> None:
        del self.datasets[name]
        self.spark.catalog.dropTempView(name)
