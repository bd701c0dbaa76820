"""Size checks before a broadcast, and cutting of lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 64 << 20

#: Tables written by `stored` that have not been dropped yet, with the session that wrote them.
_written: list[tuple[SparkSession, str]] = []
_local_folder: list[str] = []


def _bytes_of(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, T.StructType):
        return sum((_bytes_of(column.getField(f.name), f.dataType) for f in kind.fields), F.lit(16))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType, T.MapType)):
        each = F.aggregate(column, F.lit(0).cast("long"), lambda n, x: n + _bytes_of(x, kind.elementType))
        return F.coalesce(each, F.lit(0)) + 24
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.size(column), F.lit(0)) * 8 + 24
    if isinstance(kind, T.MapType):
        parts = (F.map_keys(column), T.ArrayType(kind.keyType)), (F.map_values(column), T.ArrayType(kind.valueType))
        return sum((_bytes_of(*part) for part in parts), F.lit(16))
    return F.lit(16)


def fits_broadcast(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether a table measures at most ``limit_bytes``, its arrays with all elements: one distributed sum over the table."""
    row_bytes = sum((_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16))
    measured = df.agg(F.sum(row_bytes.cast("long")).alias("bytes")).first()["bytes"]
    return (measured or 0) <= limit_bytes


def shared_folder(df: DataFrame) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a local one only where it names none.

    The session's settings are read, never changed.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is not None:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="casegrid-"))
    return _local_folder[0]


def scratch_path(df: DataFrame, folder: str | None = None) -> str:
    """A new place in ``folder`` (`shared_folder` if None) that `drop_stored` will clear."""
    path = f"{folder or shared_folder(df)}/casegrid-{uuid.uuid4()}"
    _written.append((df.sparkSession, path))
    return path


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: recomputed by nobody, lost with no executor.

    The table stays until `drop_stored` is called or Python ends, since any result may still be read from it.
    """
    path = scratch_path(df, folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """`stored` of what ``make`` returns. The tables that were written meanwhile, other than the result, are deleted then."""
    before = len(_written)
    result = stored(make())
    _delete([_written.pop(before) for _ in range(len(_written) - before - 1)])
    return result


def drop_stored() -> int:
    """Deletes all tables that `stored` has written so far; call it when the results have been used."""
    tables = list(_written)
    _written.clear()
    return _delete(tables)


def _delete(tables: list[tuple[SparkSession, str]]) -> int:
    dropped = 0
    for spark, path in tables:
        try:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            files = place.getFileSystem(spark._jsc.hadoopConfiguration())
            dropped += bool(files.delete(place, True))
        except Exception:  # the session has been stopped: its tables stay behind
            continue
    return dropped


atexit.register(drop_stored)
