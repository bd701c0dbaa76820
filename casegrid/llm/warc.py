"""A content-addressed archive of WARC records: payload bytes once by digest, exact record headers beside them.

An archive is a folder with two tables. ``payloads`` has each distinct payload once, by its SHA-256; ``headers`` has for
each record the digest of its payload and the exact bytes of its header: the WARC fields, a blank line and the HTTP fields, up to
the payload. A record's original bytes are its header, for a response the payload, and two line ends: a join by digest.

Of the records with equal payloads one is a response and the others are revisits that refer to it. Digests are verified:
when an archive is written, records with one digest must agree in length and in a second hash; when it is read, the
digest of every stored payload is computed again, and header fields must agree with it.

Everything is Spark's own functions. Payloads take part in one shuffle, after each task has kept one row of every digest;
all else is done on digests, and a digest that very many records share is dealt to many tasks.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm.groups import beside_groups
from casegrid.operators.rows import quoted
from casegrid.operators.storage import stored

_HEX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Fixed value: the profile of revisit records with an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hexadecimal digits are four characters."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), _HEX, _BASE32)


def _payload_rows(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.col(quoted(payload_col)).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(url_col)).alias("url"), payload.alias("payload"))
    return rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))


def _field(name: str, value: Column | str) -> Column:
    """One header line; empty for NULL. A line end within the value would begin another field, so it is percent-encoded."""
    value = F.lit(value) if isinstance(value, str) else value.cast("string")
    value = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _header(date: str) -> Column:
    """The exact header of a record from its columns; ``first`` is the response's (id, record)."""
    response = F.col("record_type") == "response"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"), _field("Content-Length", F.col("length")), F.lit(END)
    )
    size = F.octet_length(http) + F.when(response, F.col("length")).otherwise(0)
    refers = F.when(~response, F.concat(F.lit("<urn:uuid:"), F.col("first.record"), F.lit(">")))
    warc = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.col("record"), F.lit(">"))),
        _field("WARC-Date", date),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Profile", F.when(~response, F.lit(PROFILE))),
        _field("WARC-Refers-To", refers),
        _field("Page-Id", F.col("id")),
        _field("Refers-To-Page-Id", F.when(~response, F.col("first.id"))),
        _field("Content-Type", "application/http; msgtype=response"),
        _field("Content-Length", size),
        F.lit(END),
    )
    return F.concat(warc, http).cast("binary")


def _checked(value: Column, good: Column, message: str) -> Column:
    return F.when(good, value).otherwise(F.raise_error(F.lit(message)).cast("string"))


def write_archive(
    pages: DataFrame,
    path: str,
    least: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str | None = None,
) -> None:
    """Writes a record for each row of ``pages`` to a new archive at ``path``.

    Of records with equal payloads of at least ``least`` bytes, that with the largest id is a response and the others
    revisit it; a NULL id is smaller than all others, of rows with one id any one may be the response. Smaller payloads are
    all responses (their bytes are stored once all the same). A NULL payload is an empty one, a NULL url or id has no
    field, line ends in a url are percent-encoded. An empty table makes an empty archive. ``date`` is all records' date, by default now.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = _payload_rows(pages, id_col, url_col, payload_col)
    size = F.octet_length("payload").cast("long")
    described = stored(
        rows.select(
            F.expr("uuid()").alias("record"), "id", "url", "digest", sha1_base32(F.col("payload")).alias("sha1"),
            size.alias("length"), F.xxhash64("payload").alias("other"),
        )
    )
    alike = (F.min("length") == F.max("length")) & (F.min("other") == F.max("other"))
    groups = described.groupBy("digest").agg(
        F.count("*").alias("n"), F.max(F.struct("id", "record")).alias("first"), alike.alias("alike")
    )
    groups = stored(groups)
    shared = (F.col("length") >= least) & (F.col("record") != F.col("first.record"))
    kind = _checked(F.when(shared, "revisit").otherwise("response"), F.col("alike"), "different payloads with one digest")
    records = beside_groups(described, groups, "digest", "n").withColumn("record_type", kind)
    records.select("digest", _header(date).alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")
    payloads = rows.select("digest", "payload").dropDuplicates(["digest"])
    payloads.write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of an archive: record_id, record_type, page_id, url, date, payload_bytes, payload_digest, refers_to,
    header, and with ``with_payload`` also payload (the full one, of revisits too).

    ``payload_bytes`` and ``payload_digest`` are those of the stored payload; a payload that is missing or damaged, or a header that does
    not agree with it, is an error.
    """
    headers = spark.read.schema("digest binary, header binary").parquet(f"{path}/headers")
    payloads = spark.read.schema("digest binary, payload binary").parquet(f"{path}/payloads")
    whole = F.col("digest") == F.unhex(F.sha2("payload", 256))
    facts = payloads.select(
        "digest",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        _checked(sha1_base32(F.col("payload")), whole, "a stored payload is damaged").alias("payload_digest"),
        *(["payload"] if with_payload else []),
    )
    counted = headers.groupBy("digest").agg(F.count("*").alias("n"))
    groups = counted.join(facts, "digest", "left")
    groups = stored(groups.withColumn("payload_digest", _checked(F.col("payload_digest"), F.col("payload_digest").isNotNull(), "a payload is missing")))
    blocks = F.split(F.col("header").cast("string"), END + END)
    fields = F.str_to_map(blocks[0], F.lit(END), F.lit(": "))
    http = F.str_to_map(blocks[1], F.lit(END), F.lit(": "))
    bare = lambda c: F.regexp_extract(c, "^<urn:uuid:(.*)>$", 1)
    agrees = (F.col("f")["WARC-Payload-Digest"] == F.concat(F.lit("sha1:"), F.col("payload_digest"))) & (
        F.col("h")["Content-Length"].cast("long") == F.col("payload_bytes")
    )
    found = beside_groups(headers, groups, "digest", "n").withColumn("f", fields).withColumn("h", http)
    return found.select(
        bare(F.col("f")["WARC-Record-ID"]).alias("record_id"),
        _checked(F.col("f")["WARC-Type"], agrees, "a header does not agree with its payload").alias("record_type"),
        F.col("f")["Page-Id"].cast("long").alias("page_id"),
        F.col("f")["WARC-Target-URI"].alias("url"),
        F.col("f")["WARC-Date"].alias("date"),
        "payload_bytes",
        "payload_digest",
        F.col("f")["Refers-To-Page-Id"].cast("long").alias("refers_to"),
        "header",
        *(["payload"] if with_payload else []),
    )


def record_bytes() -> Column:
    """The original bytes of a record that `read_archive` gives with its payload."""
    payload = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return F.concat(F.col("header"), payload, F.lit((END + END).encode()))
