"""Packages of WARC records: contract, the ZIP formats, packages by others, and difficult tables."""

import gzip
import hashlib
import io
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridledger.llm import warc
from gridledger.llm.common import new_path
from gridledger.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"
LONG = "é<p>" * 400


def expected(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        alike = [p for p, _, h in rows if h == html and p is not None]
        best = max(alike, default=None) if len(data) >= 1000 else page
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if best == page else "revisit", None if best == page else best))
    return sorted(out, key=str)


HARD = [(1, "http://a/1", LONG), (9, "http://a/\r\n 9", LONG), (5, None, LONG), (None, "http://n", LONG), (2, "", None), (3, "u", ""), (4, "u", "short"), (6, "u", "short"),
        (7, "u", "x" * 999), (8, "u", "x" * 999), (10, "u", "x" * 1000), (11, "u", "x" * 1000), (11, "u", "x" * 1000), (-4, "é", "\r\n\r\n" * 300 + "\0"), (2 ** 62, "u", "z" * 3_000_000)]


def found(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_the_query_on_difficult_rows(spark, tmp_path):
    df = spark.createDataFrame(HARD, SCHEMA).repartition(3)
    for name in ("key", "record", "payload", "best", "n", "met", "size", "member", "path"):
        df = df.withColumn(name, F.lit(f"extra {name}"))
    df.write.parquet(f"{tmp_path}/pages.parquet")
    assert found(QUERIES["op13_warc"](spark, str(tmp_path))) == expected(HARD)


@pytest.mark.parametrize("hot", [1, 10 ** 9])
def test_frequent_payloads_stay_in_place(spark, monkeypatch, hot):
    monkeypatch.setattr(warc, "HOT_ONE_IN", hot)
    rows = [(i, f"u{i}", LONG if i % 3 else f"{i}{LONG}") for i in range(300)]
    packages = warc.write_packages(spark.createDataFrame(rows, SCHEMA), new_path(spark, "warc"), most_bytes=2000)
    assert packages.count() > 4 and packages.agg(F.sum("records")).first()[0] == 300
    read = warc.read_packages(packages, block_bytes=500)
    assert found(read.withColumns({"page_id": F.col("record_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})) == expected(rows)


def test_payloads_come_back(spark):
    packages = warc.write_packages(spark.createDataFrame(HARD, SCHEMA), new_path(spark, "warc"))
    read = {(r.record_id, r.record_type): bytes(r.payload) for r in warc.read_packages(packages, with_payload=True).collect()}
    for page, _, html in HARD:
        key = None if page is None else str(page)
        if (key, "response") in read:
            assert read[key, "response"] == (html or "").encode()
        else:
            assert read[key, "revisit"] == b""


def test_other_tools_read_the_packages(spark):
    packages = warc.write_packages(spark.createDataFrame(HARD[:5], SCHEMA).coalesce(1), new_path(spark, "warc"))
    for row in packages.collect():
        system, path = warc._opened(row.path)
        with system.open_input_file(path) as file:
            whole = file.read()
        with zipfile.ZipFile(io.BytesIO(whole)) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
            text = gzip.decompress(z.read(warc.DATA))
            assert text.count(b"WARC/1.1\r\n") == row.records + 1 and len(z.read(warc.INDEX).splitlines()) == row.records


def package(file, entries, comment=b"", wide=False):
    """A ZIP file by the library, with ZIP64 fields throughout if ``wide``."""
    with zipfile.ZipFile(file, "w", zipfile.ZIP_STORED) as z:
        z.comment = comment
        for name, data in entries.items():
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=wide) as member:
                member.write(data)


class Buffer:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def record(kind, body, **more):
    head = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in more.items())
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\n{head}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 and more", b"c" * 60_000])
def test_the_directory(comment):
    out = io.BytesIO()
    package(out, {"a/é.txt": b"one", "archive/x.warc": b"two" * 1000, "empty": b""}, comment, wide=True)
    file = Buffer(out.getvalue())
    found = warc.members(file, len(file.data))
    assert [(m.name, m.size) for m in found] == [("a/é.txt", 3), ("archive/x.warc", 3000), ("empty", 0)]
    assert file.read_at(3000, warc.data_start(file, found[1])) == b"two" * 1000


def test_a_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    package(out, {f"archive/{i}.warc": record("resource", b"x" * i) for i in range(40)}, wide=True)
    file = Buffer(out.getvalue())
    assert b"PK\x06\x06" in file.data and b"PK\x06\x07" in file.data
    found = warc.members(file, len(file.data))
    assert [m.name for m in found] == [f"archive/{i}.warc" for i in range(40)]
    assert all(warc.parsed(file.read_at(n, at))["payload"] == b"x" * i for i, (at, n, _) in enumerate(warc.located(file, len(file.data))))


@pytest.mark.parametrize("zipped", [True, False])
def test_a_package_without_an_index(spark, tmp_path, zipped):
    parts = [record("warcinfo", b"software: other"), record("resource", b"\r\n\r\n" + b"y" * 200_000, WARC_Record_ID="<urn:uuid:1>"), record("resource", b"")]
    data = b"".join(gzip.compress(p) for p in parts) if zipped else b"".join(parts)
    package(open(tmp_path / "other.zip", "wb"), {"archive/o.warc" + ".gz" * zipped: data, "pages/pages.jsonl": b"{}"})
    read = warc.read_packages(spark.createDataFrame([(f"{tmp_path}/other.zip",)], "path string"), with_payload=True).collect()
    assert sorted((r.record_type, r.record_id, len(r.payload)) for r in read if r.record_id) == [("resource", "urn:uuid:1", 200_004)]
    assert sorted(r.record_type for r in read) == ["resource", "resource", "warcinfo"]


def test_damage_is_an_error(spark, tmp_path):
    out = io.BytesIO()
    package(out, {"archive/a.warc": record("resource", b"abc")})
    with pytest.raises(ValueError):
        warc.members(Buffer(out.getvalue()[:-30]), len(out.getvalue()) - 30)
    with zipfile.ZipFile(deflated := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a.warc", b"abc" * 100)
    file = Buffer(deflated.getvalue())
    with pytest.raises(ValueError, match="stored"):
        list(warc.located(file, len(file.data)))
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(record("response", b"HTTP/1.1 200 OK\r\n\r\nabc", WARC_Payload_Digest="sha1:00", Content_Type="application/http"))


def test_text_ids_and_no_address(spark):
    df = spark.createDataFrame([("a/b é", "p" * 2000), ("z", "p" * 2000), (None, None)], "id string, body string")
    packages = warc.write_packages(df, new_path(spark, "warc"), "id", None, "body")
    read = sorted(((r.record_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_packages(packages).collect()), key=str)
    assert read == [("a/b é", "revisit", "z", 2000), ("z", "response", None, 2000), (None, "response", None, 0)]


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    assert QUERIES["op13_warc"](spark, str(tmp_path)).count() == 0
