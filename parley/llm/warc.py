"""WARC records in ZIP packages: writing, locating and range-reading without extraction.

A package is a ZIP file whose members are stored, not deflated: ``archive/data.warc.gz`` (each WARC
record a gzip member of its own) and ``indexes/index.cdxj`` (one line a record: id, then JSON with
offset and length in the archive member).  A reader needs three small range reads (the end of the
file, the central directory, the index) to know where every record lies, then reads just those bytes.
Both plain and ZIP64 directories are parsed; our writer always writes the ZIP64 structures, so that
packages may pass 4 GiB.

Packages lie below the folder the caller names, on any store that ``pyarrow.fs`` opens by URI (plain
paths and ``file:`` too).  A writing task sorts its records and renames each finished package to a
name that depends on its partition and number alone, so a task that runs again after a lost executor
leaves the same files.

Edge cases: null or empty payloads are records with an empty block; pages with a null page_id are
records of their own kind of id and never become another's original while a page with an id exists;
repeated pages (same id and payload) are written each; an empty table writes no package and reads
back no record; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.common import written

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Fixed values of the ZIP format: signatures and sentinels.
LOCAL, CENTRAL, END, END64, LOCATOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF
TAIL = 22 + MAX16 + 20


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


# ---- ZIP ---------------------------------------------------------------------------------------

def zip_bytes(members: list[tuple[str, bytes]]) -> bytes:
    """A ZIP file of stored members with ZIP64 directory structures."""
    out, central = io.BytesIO(), []
    for name, data in members:
        at, raw, crc = out.tell(), name.encode(), zlib.crc32(data)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        out.write(LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x800, 0, 0, 0x21, crc, MAX32, MAX32, len(raw), len(extra)) + raw + extra + data)
        more = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        central.append(CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x800, 0, 0, 0x21, crc, MAX32, MAX32, len(raw), len(more), 0, 0, 0, 0, MAX32) + raw + more)
    at, directory = out.tell(), b"".join(central)
    out.write(directory)
    end = out.tell()
    out.write(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, len(members), len(members), len(directory), at))
    out.write(LOCATOR + struct.pack("<IQI", 0, end, 1))
    out.write(END + struct.pack("<HHHHIIH", 0, 0, MAX16, MAX16, MAX32, MAX32, 0))
    return out.getvalue()


def directory(read, size: int) -> dict[str, tuple[int, int]]:
    """{member: (local header offset, stored size)} from the central directory.

    ``read(offset, length)`` returns bytes of the file.  Raises ValueError for what isn't a ZIP file
    and for compressed members that are asked for as stored ones (see :func:`member_at`).
    """
    start = max(0, size - TAIL)
    tail = read(start, size - start)
    k = tail.rfind(END)
    while k >= 0 and (k + 22 > len(tail) or k + 22 + struct.unpack_from("<H", tail, k + 20)[0] != len(tail)):
        k = tail.rfind(END, 0, k)
    if k < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    n, length, at = struct.unpack_from("<HII", tail, k + 10)
    if n == MAX16 or length == MAX32 or at == MAX32:
        if k < 20 or tail[k - 20: k - 16] != LOCATOR:
            raise ValueError("ZIP64 locator is missing")
        (where,) = struct.unpack_from("<Q", tail, k - 12)
        end = read(where, 56)
        if end[:4] != END64:
            raise ValueError("ZIP64 end of central directory is missing")
        n, length, at = struct.unpack_from("<QQQ", end, 32)
    raw, p, out = read(at, length), 0, {}
    for _ in range(n):
        if raw[p: p + 4] != CENTRAL:
            raise ValueError("central directory is damaged")
        method, = struct.unpack_from("<H", raw, p + 10)
        packed, plain, names, extras, comment = struct.unpack_from("<IIHHH", raw, p + 20)
        (offset,) = struct.unpack_from("<I", raw, p + 42)
        name = raw[p + 46: p + 46 + names].decode("utf-8", "replace")
        e, end = p + 46 + names, p + 46 + names + extras
        while e + 4 <= end:
            kind, long = struct.unpack_from("<HH", raw, e)
            if kind == 1:
                wide = [i for i, v in enumerate((plain, packed, offset)) if v == MAX32]
                values = dict(zip(wide, struct.unpack_from(f"<{len(wide)}Q", raw, e + 4)))
                plain, packed, offset = (values.get(i, v) for i, v in enumerate((plain, packed, offset)))
            e += 4 + long
        if method == 0:
            out[name] = (offset, plain)
        p = end + comment
    return out


def member_at(read, entry: tuple[int, int]) -> int:
    """Where the bytes of a stored member begin."""
    head = read(entry[0], 30)
    if head[:4] != LOCAL:
        raise ValueError("local header is damaged")
    names, extras = struct.unpack_from("<HH", head, 26)
    return entry[0] + 30 + names + extras


# ---- records -----------------------------------------------------------------------------------

def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record as a gzip member; a revisit keeps the HTTP head but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    head += ["WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{bare_digest(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse_record(raw: bytes) -> dict:
    """What :func:`record` wrote: ids, url, type, digest, payload (None for a revisit) and its size."""
    data = gzip.decompress(raw)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    page = lambda k: None if fields.get(k, "null").endswith("null>") or k not in fields else int(fields[k][10:-1])
    revisit, named = fields["WARC-Type"] == "revisit", fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != size or bare_digest(payload) != named):
        raise ValueError("payload differs from its digest")
    url = fields.get("WARC-Target-URI")
    return {"page_id": page("WARC-Record-ID"), "url": url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"), "record_type": fields["WARC-Type"],
            "refers_to": page("WARC-Refers-To"), "payload_digest": named, "payload_bytes": size, "payload": None if revisit else payload}


# ---- Spark -------------------------------------------------------------------------------------

def with_originals(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): the smallest page_id of an equal payload is the original."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("_digest", F.unhex(F.sha1("payload"))).withColumn("_size", F.length("payload").cast("long"))
    narrow = rows.select("page_id", "_digest", "_size").where(F.col("_size") >= least_bytes)
    firsts = (narrow.groupBy("_digest", "_size").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
              .where("_n > 1 and _first is not null").select("_digest", "_size", "_first"))
    later = (narrow.join(firsts, ["_digest", "_size"]).where("page_id is null or page_id > _first")
             .select(F.col("page_id").alias("_page"), F.col("_digest").alias("_same"), F.col("_first").alias("refers_to")).distinct())
    return (rows.join(later, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("_digest") == F.col("_same")), "left")
            .select("page_id", "url", "payload", "refers_to"))


def write_packages(records: DataFrame, folder: str, package_bytes: int = 16 << 20) -> DataFrame:
    """Writes (page_id, url, payload, refers_to) rows into packages; returns (path, bytes, records)."""
    def run(batches):
        from pyspark import TaskContext

        store, root = _fs(folder)
        store.create_dir(root, recursive=True)
        part, attempt, number = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0
        held, lines, size = [], [], 0

        def flush():
            nonlocal held, lines, size, number
            data = zip_bytes([(ARCHIVE, b"".join(held)), (INDEX, "".join(lines).encode())])
            name, temporary = f"part-{part:05d}-{number:05d}.wacz", f"_{part}-{number}-{attempt}"
            with store.open_output_stream(f"{root}/{temporary}") as f:
                f.write(data)
            if store.get_file_info(f"{root}/{name}").type.name == "NotFound":
                store.move(f"{root}/{temporary}", f"{root}/{name}")
            else:  # an earlier attempt of this task has left the same bytes
                store.delete_file(f"{root}/{temporary}")
            out = pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(data)], pa.int64()), pa.array([len(held)], pa.int64())], ["path", "bytes", "records"])
            held, lines, size, number = [], [], 0, number + 1
            return out

        for b in batches:
            for page_id, url, payload, refers_to in zip(*(b.column(c) for c in ("page_id", "url", "payload", "refers_to"))):
                page_id = page_id.as_py()
                raw = record(page_id, url.as_py(), payload.as_py(), refers_to.as_py())
                lines.append(f"{page_id} {json.dumps({'offset': size, 'length': len(raw)})}\n")
                held.append(raw)
                size += len(raw)
                if size >= package_bytes:
                    yield flush()
        if held:
            yield flush()

    ordered = records.sortWithinPartitions("page_id", "url", F.length("payload"))  # the same bytes at every attempt
    return ordered.mapInArrow(run, "path string, bytes long, records long")


def locate(packages: DataFrame) -> DataFrame:
    """(path, offset, length) of every record, from each package's directories and index alone."""
    def run(batches):
        for b in batches:
            for path, size in zip(b.column("path").to_pylist(), b.column("bytes").to_pylist()):
                store, name = _fs(path)
                with store.open_input_file(name) as f:
                    read = lambda at, n, f=f: f.read_at(n, at)
                    found = directory(read, size)
                    base = member_at(read, found[ARCHIVE])
                    index = read(member_at(read, found[INDEX]), found[INDEX][1])
                rows = [json.loads(x.partition(b" ")[2]) for x in index.splitlines()]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), pa.array([base + r["offset"] for r in rows], pa.int64()), pa.array([r["length"] for r in rows], pa.int64())], ["path", "offset", "length"])

    return packages.select("path", "bytes").mapInArrow(run, "path string, offset long, length long")


RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def read_records(located: DataFrame, batch_bytes: int = 8 << 20) -> DataFrame:
    """Range-reads the located records; the payload of a revisit is null (see ``refers_to``)."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def run(batches):
        opened, f = None, None
        for b in batches:
            held, size = [], 0
            for path, at, n in zip(*(b.column(c).to_pylist() for c in ("path", "offset", "length"))):
                if path != opened:
                    if f is not None:
                        f.close()
                    store, name = _fs(path)
                    opened, f = path, store.open_input_file(name)
                held.append(parse_record(f.read_at(n, at)))
                size += held[-1]["payload_bytes"]
                if size >= batch_bytes:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    return located.mapInArrow(run, RECORD)


def write_and_read(spark: SparkSession, pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Archives pages below ``folder`` and reads every record back."""
    packages = written(write_packages(with_originals(pages, least_bytes), folder), "warc-packages")
    n = packages.count()
    return read_records(locate(packages.repartition(max(1, n)) if n else packages))
