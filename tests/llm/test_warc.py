"""The archive: exact records, digests that are verified, and equal payloads stored once."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from casegrid.llm import groups
from casegrid.llm.warc import read_archive, record_bytes, sha1_base32, write_archive

PAGES = "page_id long, url string, html string, digest string, record string, n long, payload string, first int"
ROWS = [
    (1, "http://a/1", "same"), (2, "http://a/2", "same"), (9, None, "same"), (4, "http://a/4\r\nWARC-Type: x", "été \r\n\r\n WARC/1.1"),
    (5, "http://a/5", None), (6, "http://a/6: b", ""), (7, "http://a/7", "x" * 300_000), (8, "u", "tiny"), (3, "u", "tiny"),
    (10, "u", "twice"), (10, "u", "twice"), (None, "u", "twice"), (None, "v", "nobody"), (None, "v", "nobody"),
]


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", "r", 7, "p", 7) for i, u, h in rows], PAGES)


def digest_of(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def expected(rows, least):
    out = []
    for text in {h or "" for _, _, h in rows}:
        ids = sorted((i for i, _, h in rows if (h or "") == text), key=lambda i: (i is not None, i or 0))
        for k, i in enumerate(ids):
            first = len(text.encode()) < least or k == len(ids) - 1
            out.append((i, len(text.encode()), digest_of(text), "response" if first else "revisit", None if first else ids[-1]))
    return sorted(map(repr, out))


def digests(found):
    return sorted(repr(tuple(r)) for r in found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


@pytest.mark.parametrize("fits", [True, False])
@pytest.mark.parametrize("least", [0, 5])
def test_records_of_awkward_pages(spark, tmp_path, monkeypatch, least, fits):
    monkeypatch.setattr(groups, "fits_broadcast", lambda df: fits)
    monkeypatch.setattr(groups, "SPLIT", 4)
    monkeypatch.setattr(groups, "FEW", 1)
    path = str(tmp_path / "archive")
    write_archive(pages_of(spark, ROWS).repartition(3), path, least=least)
    assert digests(read_archive(spark, path)) == expected(ROWS, least)
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in ROWS})


def parsed(data):
    """A WARC file by its own rules only: fields to a blank line, then as many bytes as Content-Length says."""
    records = []
    while data:
        head, data = data.split(b"\r\n\r\n", 1)
        version, *lines = head.split(b"\r\n")
        assert version == b"WARC/1.1"
        fields = dict(line.decode().split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        block, end, data = data[:size], data[size : size + 4], data[size + 4 :]
        assert end == b"\r\n\r\n"
        http, _, body = block.partition(b"\r\n\r\n")
        records.append((fields, http, body))
    return records


def test_reconstructed_records_are_a_warc_file(spark, tmp_path):
    path = str(tmp_path / "archive")
    write_archive(pages_of(spark, ROWS), path, least=0, date="2024-01-02T03:04:05Z")
    rows = read_archive(spark, path, with_payload=True).select("page_id", "url", "payload", record_bytes().alias("bytes")).collect()
    records = parsed(b"".join(bytes(r["bytes"]) for r in rows))
    assert len(records) == len(rows) == len(ROWS)
    ids = {f["WARC-Record-ID"] for f, _, _ in records}
    assert len(ids) == len(records)
    texts = {}
    for f, http, body in records:
        assert f["WARC-Date"] == "2024-01-02T03:04:05Z" and http.startswith(b"HTTP/1.1 200 OK")
        if f["WARC-Type"] == "response":
            assert f["WARC-Payload-Digest"] == "sha1:" + digest_of(body.decode())
            texts[f["WARC-Record-ID"]] = body.decode()
        else:
            assert not body and f["WARC-Refers-To"] in ids and "identical-payload-digest" in f["WARC-Profile"]
    found = [(int(f["Page-Id"]) if "Page-Id" in f else None, texts[f.get("WARC-Refers-To", f["WARC-Record-ID"])]) for f, _, _ in records]
    assert sorted(map(repr, found)) == sorted(repr((i, h or "")) for i, _, h in ROWS)
    assert sorted(repr((r["page_id"], bytes(r["payload"]).decode())) for r in rows) == sorted(map(repr, found))
    urls = {(u or "").replace("\r", "%0D").replace("\n", "%0A") or None for _, u, _ in ROWS}
    assert {r["url"] for r in rows} == urls


def test_empty_archive(spark, tmp_path):
    path = str(tmp_path / "archive")
    write_archive(pages_of(spark, []), path)
    assert read_archive(spark, path, with_payload=True).count() == 0


def test_damaged_and_missing_payloads_are_errors(spark, tmp_path):
    path = str(tmp_path / "archive")
    write_archive(pages_of(spark, ROWS), path)
    payloads = spark.read.parquet(f"{path}/payloads")
    damaged = F.when(F.octet_length("payload") == 4, F.lit(b"else")).otherwise(F.col("payload")).alias("payload")
    payloads.select("digest", damaged).write.parquet(str(tmp_path / "damaged/payloads"))
    payloads.limit(2).write.parquet(str(tmp_path / "missing/payloads"))
    for kind, message in (("damaged", "a stored payload is damaged"), ("missing", "a payload is missing")):
        spark.read.parquet(f"{path}/headers").write.parquet(str(tmp_path / kind / "headers"))
        with pytest.raises(Exception, match=message):
            read_archive(spark, str(tmp_path / kind)).collect()


def test_base32_of_any_bytes(spark):
    texts = ["", "a", "été", "x" * 10_000, *map(str, range(200))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", sha1_base32(F.col("t").cast("binary")).alias("d"))
    assert all(r["d"] == digest_of(r["t"]) for r in rows.collect())
