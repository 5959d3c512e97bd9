"""WARC records in ZIP packages: written by the tasks that hold the pages, and read back by range, without unpacking.

A package is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz``, a gzip member per record, and
``indexes/index.cdxj``, a line per record with its offset and length. The reader parses the end records, the central directory and
their ZIP64 forms, finds where the bytes of a member begin, reads the index, and deals ranges of neighbouring records to
tasks that read just those bytes.

Payloads that occur again become ``revisit`` records. The record that a group of equal payloads refers to is found on digests alone;
of the payloads, only compressed ones move, and those of frequent groups stay where they are.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridledger.llm.common import HOT_ONE_IN, kept, new_path

LEAST_REVISIT = 1000
PACKAGE_BYTES, BLOCK_BYTES = 256 << 20, 4 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

# Signatures and sizes of the ZIP format, and the profile of revisit records.
_ENTRY, _LOCAL, _END, _END64, _LOCATOR = b"PK\x01\x02", b"PK\x03\x04", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_LONGEST_COMMENT, _ZIP64_EXTRA, _STORED, _FULL16, _FULL32 = 65_535, 1, 0, 0xFFFF, 0xFFFFFFFF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path of the shared folder, as Spark names it, and the path there."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pyarrow.fs.FileSystem.from_uri(uri)


# Records

def _urn(record) -> str:
    return f"<urn:x-record:{'' if record is None else quote(str(record), safe='')}>"


def _from_urn(text: str | None) -> str | None:
    """The id that ``_urn`` wrote; of records by others their URI."""
    bare = (text or "").strip("<>")
    return (unquote(bare.removeprefix("urn:x-record:")) if bare.startswith("urn:x-record:") else bare) or None


def _record(fields: dict[str, str], block: bytes, level: int) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + f"Content-Length: {len(block)}\r\n\r\n"
    tool = zlib.compressobj(level, zlib.DEFLATED, 31)
    return tool.compress(head.encode() + block + b"\r\n\r\n") + tool.flush()


def _page(kind: str, record, url: str | None, sha1: str, size: int, date: str, more: dict[str, str], payload: bytes, level: int) -> bytes:
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else _urn(record)[1:-1]
    fields = {"WARC-Type": kind, "WARC-Record-ID": _urn(record), "WARC-Date": date, "WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{sha1}",
              **more, "Content-Type": "application/http; msgtype=response"}
    return _record(fields, f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + payload, level)


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode(errors="replace").split("\r\n")[1:])}


def parsed(data: bytes) -> dict:
    """A record's type, ids, target, payload and its digest and length; of a revisit those of the full payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record begins here")
    fields = _fields(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    kind = fields.get("warc-type")
    size = int(_fields(http).get("content-length", 0)) if kind == "revisit" else len(payload)
    if kind == "response" and digest and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields.get('warc-record-id')} has another digest")
    return {"record_type": kind, "record_id": _from_urn(fields.get("warc-record-id")), "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
            "payload_digest": digest, "payload_bytes": size, "refers_to": _from_urn(fields.get("warc-refers-to")), "payload": payload}


# Writing

def _compressed(date: str, level: int):
    """Rows with the compressed response record of each payload; without a payload, none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            rows = zip(column["record"], column["url"], column["payload"], column["sha1"], column["size"])
            members = [None if not p.is_valid else _page("response", r.as_py(), u.as_py(), s.as_py(), n.as_py(), date, {}, p.as_py(), level) for r, u, p, s, n in rows]
            names = ["record", "url", "size", "sha1", "key", "best", "revisit"]
            yield pa.RecordBatch.from_arrays([*[column[n] for n in names], pa.array(members, pa.binary())], [*names, "member"])

    return run


class _Package:
    """One package while it is written."""

    def __init__(self, folder: str, date: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.zip"
        system, path = _opened(self.path)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.stream = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.at, self.index, self.records, self.date = 0, [], 0, date
        self._write(_record({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date,
                             "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n", 1))

    def _write(self, member: bytes) -> None:
        self.data.write(member)
        self.at += len(member)

    def add(self, record, url, sha1: str, kind: str, member: bytes) -> None:
        place = json.dumps({"url": url or _urn(record)[1:-1], "digest": f"sha1:{sha1}", "mime": "warc/revisit" if kind == "revisit" else "text/html",
                            "offset": self.at, "length": len(member), "filename": DATA.rpartition("/")[2]}, ensure_ascii=True)
        self.index.append(f"{quote(url or '', safe='')} {self.date.translate(str.maketrans('', '', '-:TZ'))} {place}\n")
        self._write(member)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(INDEX, "".join(self.index))
        self.zip.close()
        self.stream.close()
        return self.path, self.records, self.at


def _packages(folder: str, date: str, level: int, most_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for record, url, size, sha1, best, revisit, member in zip(*(batch.column(i) for i in range(7))):
                package = package or _Package(folder, date)
                r, u, s, data = record.as_py(), url.as_py(), sha1.as_py(), member.as_py()
                if revisit.as_py():
                    data = _page("revisit", r, u, s, size.as_py(), date, {"WARC-Refers-To": _urn(best.as_py()), "WARC-Profile": PROFILE}, b"", level)
                package.add(r, u, s, "revisit" if revisit.as_py() else "response", data)
                if package.at >= most_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*done)) or [()] * 3, (pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"])

    return run


def write_packages(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str | None = "url", payload_col: str = "html",
                   least_revisit: int = LEAST_REVISIT, level: int = 3, most_bytes: int = PACKAGE_BYTES, date: str | None = None) -> DataFrame:
    """Writes a record per row into packages below ``folder`` and returns their table ``path, records, bytes``.

    Of rows with equal payloads of at least ``least_revisit`` bytes the one with the largest id is a response, the others are revisits of
    it; a null id is smaller than any other, and rows that repeat id and payload are alike. A null payload is empty; a null or
    empty address is replaced by the record's own id. Other columns are not written, and an empty table gives no package. Payloads of equal length and
    SHA-256 are taken as equal. A task that is run again writes other packages; those that count are in the returned table.
    """
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    data = F.coalesce(df[payload_col].cast("binary"), F.lit(b""))
    url = df[url_col].cast("string") if url_col else F.lit(None).cast("string")
    rows = df.select(df[id_col].alias("record"), url.alias("url"), data.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("sha1"), F.unhex(F.sha2("payload", 256)).alias("key"))
    repeated = F.col("size") >= least_revisit
    counts = rows.where(repeated).groupBy("key", "size").agg(F.max("record").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = kept(counts, "payloads")
    total = groups.agg(F.sum("n")).first()[0] or 0
    often = F.broadcast(groups.where(F.col("n") * HOT_ONE_IN > total).select("key", "size", "best", F.lit(True).alias("met")))
    rare = groups.where(F.col("n") * HOT_ONE_IN <= total).select("key", "size", "best")

    marked = rows.join(often, ["key", "size"], "left")
    later = F.col("met").isNotNull() & ~F.col("record").eqNullSafe(F.col("best"))
    stays = marked.where(~repeated | F.col("met").isNotNull()).select(
        "record", "url", F.when(~(repeated & later), F.col("payload")).alias("payload"), "size", "sha1", "key", F.when(repeated, F.col("best")).alias("best"), (repeated & later).alias("revisit"))
    moves = marked.where(repeated & F.col("met").isNull()).select(*[c if c != "revisit" else F.lit(False).alias(c) for c in stays.columns])
    fields = [*(stays.schema[c] for c in ("record", "url", "size", "sha1", "key", "best", "revisit")), T.StructField("member", T.BinaryType())]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    build = _compressed(date, level)
    met = moves.mapInArrow(build, schema).drop("best", "revisit").join(rare, ["key", "size"], "left")
    met = met.select(*schema.names[:5], "best", (F.col("best").isNotNull() & ~F.col("record").eqNullSafe(F.col("best"))).alias("revisit"), "member")
    all_rows = stays.mapInArrow(build, schema).unionByName(met).drop("key")
    return kept(all_rows.mapInArrow(_packages(folder, date, level, most_bytes), "path string, records long, bytes long"), "packages")


# Reading

class Member(NamedTuple):
    name: str
    method: int
    size: int
    header: int


def members(file, size: int) -> list[Member]:
    """The central directory of a ZIP file of ``size`` bytes, by its end records, those of ZIP64 included."""
    tail_at = max(0, size - _LONGEST_COMMENT - 22)
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(_END)
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(_END, 0, end)
    if end < 0:
        raise ValueError("no end of a central directory")
    count, length, at = struct.unpack_from("<HII", tail, end + 10)
    if count == _FULL16 or length == _FULL32 or at == _FULL32:
        locator = file.read_at(20, tail_at + end - 20)
        if locator[:4] != _LOCATOR:
            raise ValueError("no ZIP64 locator before the end record")
        end64 = file.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
        if end64[:4] != _END64:
            raise ValueError("no ZIP64 end record where the locator points")
        count, length, at = struct.unpack_from("<QQQ", end64, 32)
    directory, out, here = file.read_at(length, at), [], 0
    for _ in range(count):
        if directory[here:here + 4] != _ENTRY:
            raise ValueError("central directory is cut off")
        flags, method = struct.unpack_from("<HH", directory, here + 8)
        packed, plain, n, extra, comment = struct.unpack_from("<IIHHH", directory, here + 20)
        header, = struct.unpack_from("<I", directory, here + 42)
        name = directory[here + 46:here + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        field, stop = here + 46 + n, here + 46 + n + extra
        while field + 4 <= stop:
            tag, long = struct.unpack_from("<HH", directory, field)
            if tag == _ZIP64_EXTRA:
                wide = iter(struct.unpack_from(f"<{long // 8}Q", directory, field + 4))
                plain, packed, header = (next(wide) if x == _FULL32 else x for x in (plain, packed, header))
            field += 4 + long
        out.append(Member(name, method, packed, header))
        here = stop + comment
    return out


def data_start(file, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != _STORED:
        raise ValueError(f"{member.name} is compressed by the package; only stored members can be read by range")
    head = file.read_at(30, member.header)
    if head[:4] != _LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def _scanned(file, start: int, size: int, zipped: bool) -> Iterator[tuple[int, int]]:
    """Offset and length of each record of a member without an index."""
    at = 0
    while at < size:
        if zipped:
            tool, here = zlib.decompressobj(31), at
            while not tool.eof:
                piece = file.read_at(min(1 << 20, size - here), start + here)
                if not piece:
                    raise ValueError("a record is cut off")
                while piece and not tool.eof:
                    tool.decompress(piece, 1 << 20)
                    here, piece = here + len(piece) - len(tool.unconsumed_tail) - len(tool.unused_data), tool.unconsumed_tail
        else:
            head, here = b"", at
            while b"\r\n\r\n" not in head:
                piece = file.read_at(min(1 << 16, size - here), start + here)
                if not piece:
                    raise ValueError("a record is cut off")
                head, here = head + piece, here + len(piece)
            head = head.partition(b"\r\n\r\n")[0]
            here = at + len(head) + 8 + int(_fields(head)["content-length"])
        yield at, here - at
        at = here


def located(file, size: int) -> Iterator[tuple[int, int, bool]]:
    """Place in the package, length and whether it is gzipped, of every record, by the package's indexes or else by scanning."""
    found = members(file, size)
    indexed: dict[str, list[tuple[int, int]]] = {}
    for m in found:
        name = m.name.removesuffix(".gz")
        if m.name.startswith("indexes/") and name.endswith((".cdx", ".cdxj")):
            text = file.read_at(m.size, data_start(file, m))
            for line in (zlib.decompress(text, 31) if m.name != name else text).splitlines():
                if b"{" in line:
                    x = json.loads(line[line.index(b"{"):])
                    indexed.setdefault(x["filename"].rpartition("/")[2], []).append((int(x["offset"]), int(x["length"])))
    for m in found:
        if m.name.endswith((".warc", ".warc.gz")):
            start, zipped = data_start(file, m), m.name.endswith(".gz")
            for at, length in sorted(indexed.get(m.name.rpartition("/")[2]) or _scanned(file, start, m.size, zipped)):
                yield start + at, length, zipped


def _ranges(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = _opened(uri)
                out = []
                with system.open_input_file(path) as file:
                    for at, length, zipped in located(file, file.size()):
                        if not out or out[-1][2] != zipped or at + length - out[-1][1][0] > block_bytes:
                            out.append((uri, [], zipped, []))
                        out[-1][1].append(at)
                        out[-1][3].append(length)
                columns = list(zip(*out)) or [()] * 4
                kinds = [pa.string(), pa.list_(pa.int64()), pa.bool_(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "places", "zipped", "lengths"])

    return run


_COLUMNS = ["record_type", "record_id", "target_uri", "date", "payload_digest", "payload_bytes", "refers_to"]


def _records(with_payload: bool):
    names = [*_COLUMNS, "payload"] if with_payload else _COLUMNS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, places, zipped, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                system, path = _opened(uri)
                with system.open_input_file(path) as file:
                    data, first = file.read_at(places[-1] + lengths[-1] - places[0], places[0]), places[0]
                pieces = (data[at - first:at - first + n] for at, n in zip(places, lengths))
                rows = [parsed(zlib.decompress(p, 31) if zipped else p) for p in pieces]
                kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names)

    return run


def read_packages(packages: DataFrame, with_payload: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The records of the packages named by ``path``: type, id, target, date, digest and length of the payload, what a revisit refers to.

    A task opens a package and finds its records; ranges of about ``block_bytes`` of neighbouring records are then dealt anew and
    read. Records of other kinds than response and revisit are returned as they are; a damaged package, or a response
    whose payload has another digest than it states, raises an error.
    """
    spark = packages.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ranges = packages.select("path").repartition(tasks).mapInArrow(_ranges(block_bytes), "path string, places array<long>, zipped boolean, lengths array<long>")
    kinds = ", ".join(f"{c} {'long' if c == 'payload_bytes' else 'string'}" for c in _COLUMNS) + (", payload binary" if with_payload else "")
    return ranges.repartition(tasks).mapInArrow(_records(with_payload), kinds)


def page_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Writes a record per page of the given table and reads all of them back: one row per page."""
    packages = write_packages(spark.read.parquet(f"{folder}/pages.parquet"), new_path(spark, "warc"))
    return read_packages(packages).select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                          F.col("refers_to").cast("long").alias("refers_to"))


SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, coalesce(html, '') AS html FROM pages),
 q AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS best FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest, CASE WHEN best IS NOT NULL AND page_id IS DISTINCT FROM best THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN page_id IS DISTINCT FROM best THEN best END AS refers_to FROM q"""
