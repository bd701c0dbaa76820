"""Counts per numeric band and per code of a delimited list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.functions import AGE_BANDS, WHITESPACE, band, band_udf, matches_text
from casegrid.functions.scalars import Band
from casegrid.operators.rows import quoted
from casegrid.operators.storage import BROADCAST_LIMIT_BYTES, fits_broadcast

JOIN_HINTS = ("BROADCAST", "MERGE", "SHUFFLE_HASH", "SHUFFLE_REPLICATE_NL")


def banded_count(
    df: DataFrame,
    text: str,
    needle: str,
    value: str,
    bands: Sequence[Band] = AGE_BANDS,
    label: str = "band",
    python_udf: bool = False,
) -> DataFrame:
    """Rows whose text holds ``needle`` and whose value is positive, counted per band, most first."""
    value_col = F.col(quoted(value))
    kept = df.filter(matches_text(F.col(quoted(text)), needle) & (value_col > 0))
    labelled = band_udf(bands)(value_col) if python_udf else band(value_col, bands)
    return (
        kept.groupBy(labelled.alias(label))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.col(quoted(label)))
    )


def token_frequency(
    df: DataFrame,
    tokens: str,
    dictionary: DataFrame,
    join_hint: str | None = None,
    trim_tokens: bool = False,
    blank_as_unknown: bool = False,
    unknown: str = "Unknown",
    broadcast_limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """How often each space-separated token occurs, with its description, most frequent first.

    ``dictionary`` has the columns Code and Description. Tokens are counted before the join, so the
    join sees one row per distinct token and no token is hot in it. A BROADCAST hint is passed on only
    if the dictionary measures at most ``broadcast_limit_bytes``; beyond that Spark chooses.
    SHUFFLE_REPLICATE_NL has no form for an outer join, and Spark sorts and merges instead.
    """
    if join_hint is not None:
        join_hint = join_hint.upper()
        if join_hint not in JOIN_HINTS:
            raise ValueError(f"join_hint must be one of {JOIN_HINTS}, not {join_hint!r}")
    code = F.col("Code")
    codes = df.select(F.explode(F.split(F.col(quoted(tokens)), " ")).alias("Code"))
    counts = codes.filter(code != "").groupBy("Code").agg(F.count("*").alias("Frequency"))
    if trim_tokens:
        # Once per distinct token: as a filter on a key, "not blank" would be moved below the count
        # and trim every occurrence, so it is one on an aggregate.
        trimmed = F.btrim(code, F.lit(WHITESPACE)).alias("Code")
        counts = (
            counts.select(trimmed, "Frequency")
            .groupBy("Code")
            .agg(F.sum("Frequency").alias("Frequency"), F.max(F.length("Code")).alias("length"))
            .filter("length > 0")
            .drop("length")
        )

    entries = dictionary.select("Code", "Description")
    if join_hint and not (join_hint == "BROADCAST" and not fits_broadcast(entries, broadcast_limit_bytes)):
        entries = entries.hint(join_hint)
    description = F.col("Description")
    if blank_as_unknown:
        description = F.nullif(description, F.lit(""))
    return (
        counts.join(entries, "Code", "left")
        .select("Code", F.coalesce(description, F.lit(unknown)).alias("Description"), "Frequency")
        .orderBy(F.desc("Frequency"), "Code", "Description")
    )
