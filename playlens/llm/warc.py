"""WARC records in ZIP packages, written from pages and read back by byte ranges.

A package is a ZIP with two stored (uncompressed) members: `archive/data.warc.gz`, one gzip member
per record, and `indexes/index.cdxj`, one line per record with its offset and length in the archive
member. The reader parses the end record, its ZIP64 form and the central directory, finds where the
stored members lie, and fetches every record with one ranged read; nothing is extracted.

Every task writes packages of at most PACKAGE_BYTES into the folder all executors share, under names
of its own; the rows a task returns name its packages, so those of failed attempts are never read.

Edge cases
    null html       the empty payload
    null page_id    smaller than every id; written and read with a null id
    null url        the empty address
    repeated rows   the same id and payload twice: one is the response, the other revisits it
    very long page  one record; a task holds one at a time
    empty table     no package, empty result
    other columns   ignored, whatever their names
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import bit_maps, materialized, shared_folder, with_maybe

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 64 << 20
RANGE_RECORDS = 5_000  # records of a package that one task reads
MOST_TASKS = 20_000  # beyond it a task reads several ranges
LEAST_SHARED = 1000  # payload bytes from which equal payloads are stored once
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# ZIP structures: signature and layout (fixed values of the format).
END, END_SIZE = b"PK\x05\x06", 22
END_64, END_64_SIZE = b"PK\x06\x06", 56
LOCATOR_64, LOCATOR_64_SIZE = b"PK\x06\x07", 20
ENTRY, ENTRY_SIZE = b"PK\x01\x02", 46
LOCAL, LOCAL_SIZE = b"PK\x03\x04", 30
FULL_16, FULL_32 = 0xFFFF, 0xFFFFFFFF


@dataclass
class Member:
    name: str
    method: int
    size: int
    offset: int  # of its bytes in the package


def read_at(file: BinaryIO, offset: int, size: int) -> bytes:
    file.seek(offset)
    return file.read(size)


def central_directory(file: BinaryIO, size: int) -> tuple[int, int, int]:
    """Entries, offset and bytes of the central directory; the ZIP64 record where there is one."""
    tail_at = max(0, size - END_SIZE - FULL_16)
    tail = read_at(file, tail_at, size - tail_at)
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("not a ZIP package: no end record")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    locator_at = tail_at + at - LOCATOR_64_SIZE
    if FULL_16 == entries or FULL_32 in (length, offset):
        locator = read_at(file, max(0, locator_at), LOCATOR_64_SIZE)
        if locator[:4] == LOCATOR_64:
            record = read_at(file, struct.unpack_from("<Q", locator, 8)[0], END_64_SIZE)
            if record[:4] != END_64:
                raise ValueError("damaged ZIP64 end record")
            entries, length, offset = struct.unpack_from("<QQQ", record, 32)
    return entries, offset, length


def members(file: BinaryIO, size: int) -> dict[str, Member]:
    """The members of a package by name, from its directory."""
    count, at, length = central_directory(file, size)
    directory, found, place = read_at(file, at, length), {}, 0
    for _ in range(count):
        if directory[place:place + 4] != ENTRY:
            raise ValueError("damaged central directory")
        method, = struct.unpack_from("<H", directory, place + 10)
        packed, full, name_size, extra_size, note_size = struct.unpack_from(
            "<IIHHH", directory, place + 20)
        local, = struct.unpack_from("<I", directory, place + 42)
        name_at = place + ENTRY_SIZE
        name = directory[name_at:name_at + name_size].decode("utf-8")
        extra = directory[name_at + name_size:name_at + name_size + extra_size]
        full, packed, local = _wide(extra, full, packed, local)
        head = read_at(file, local, LOCAL_SIZE)
        if head[:4] != LOCAL:
            raise ValueError(f"damaged header of {name}")
        skip = sum(struct.unpack_from("<HH", head, 26))
        found[name] = Member(name, method, packed, local + LOCAL_SIZE + skip)
        place = name_at + name_size + extra_size + note_size
    return found


def _wide(extra: bytes, *values: int) -> list[int]:
    """Values that fill their 32 bits are replaced by those of the ZIP64 extra field, in order."""
    out, place = list(values), 0
    while place + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, place)
        if kind == 1:
            at = place + 4
            for i, value in enumerate(values):
                if value == FULL_32:
                    out[i], = struct.unpack_from("<Q", extra, at)
                    at += 8
        place += 4 + size
    return out


def stored(found: dict[str, Member], name: str) -> Member:
    member = found[name]
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{name} is compressed; ranges cannot be read from it")
    return member


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str,
                 refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" \
           f"Content-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    fields = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
              f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}",
              "WARC-Target-URI: " + " ".join(url.split()),
              f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    block = head if revisit else head + payload
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _named(name: str | None) -> int | None:
    number = (name or "")[len("<urn:page:"):-1]
    return int(number) if number else None


def parse_record(record: bytes) -> dict:
    """The fields of a record; for a response, length and digest come from the payload itself."""
    top, _, rest = record.partition(b"\r\n\r\n")
    lines = top.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                  for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in head.decode("ascii").split("\r\n")[1:])
    kind, size = fields["WARC-Type"], int(http["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size
                               or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    return {"page_id": _named(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"],
            "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": _named(fields.get("WARC-Refers-To")),
            "payload": payload if kind == "response" else None}


class PackageWriter:
    """Writes one package; records stream into the first member, the index follows."""

    def __init__(self, file: BinaryIO):
        self.zip = zipfile.ZipFile(file, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.lines: list[str] = []
        self.size = 0

    def add(self, record: bytes, url: str) -> None:
        packed = gzip.compress(record, 1, mtime=0)
        self.data.write(packed)
        self.lines.append(f"{' '.join(url.split())} {DATE} " + json.dumps(
            {"offset": self.size, "length": len(packed)}))
        self.size += len(packed)

    def close(self) -> None:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(self.lines).encode("utf-8", "surrogatepass"))
        self.zip.close()


def index_entries(package: BinaryIO, size: int) -> tuple[Member, list[tuple[int, int]]]:
    """Where the archive member lies, and offset and length of each record in it."""
    found = members(package, size)
    index = stored(found, INDEX)
    lines = read_at(package, index.offset, index.size).decode("utf-8", "surrogatepass")
    places = [json.loads(line[line.rindex(" {") + 1:]) for line in lines.split("\n") if line]
    return stored(found, DATA), [(p["offset"], p["length"]) for p in places]


def decide(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
           url_col: str = "url", least: int = LEAST_SHARED) -> DataFrame:
    """Pages with payload, digest and the page a record refers to (null: a response).

    Equal payloads are found by digest on narrow rows; the response is the largest page_id.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("page_id"),
                        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = F.length("payload") >= least
    shared = (rows.filter(large).groupBy("digest").agg(
        F.max("page_id").alias("first_id"), F.count("*").alias("n"), F.count("page_id").alias("m"))
        .filter("n > 1 AND m > 0").select(F.col("digest").alias("__digest"), "first_id"))
    # Only payloads whose digest may be shared are shuffled.
    shared = materialized(shared)
    maybe = with_maybe(rows, bit_maps(shared, "__digest"), "digest")
    met = maybe.filter("__maybe").join(
        shared, (F.col("digest") == F.col("__digest")) & large, "left")
    alone = maybe.filter("NOT __maybe").withColumn(
        "first_id", F.lit(None).cast(dict(shared.dtypes)["first_id"]))
    columns = ["page_id", "url", "payload", "digest", "first_id"]
    return met.select(*columns).unionByName(alone.select(*columns)).select("page_id", "url", "payload", "digest", F.when(
        ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))


def write(decided: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes the packages; one row per package: path, bytes, records."""

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        place, root = fs.FileSystem.from_uri(folder)
        place.create_dir(root, recursive=True)
        done, writer, stream, name = [], None, None, None

        def close() -> None:
            records = len(writer.lines)
            writer.close()
            stream.close()
            done.append({"path": f"{folder}/{name}", "records": records,
                         "bytes": place.get_file_info(f"{root}/{name}").size})

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in
                       ("page_id", "url", "payload", "digest", "refers_to")]
            for page_id, url, payload, digest, refers_to in zip(*columns, strict=True):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.wacz"
                    stream = place.open_output_stream(f"{root}/{name}")
                    writer = PackageWriter(Forward(stream))
                writer.add(record_bytes(page_id, url, payload, digest, refers_to), url)
                if writer.size >= package_bytes:
                    close()
                    writer = None
        if writer is not None:
            close()
        yield pa.RecordBatch.from_pylist(done, pa.schema(
            [("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return decided.mapInArrow(save, "path string, records long, bytes long")


class Forward:
    """A stream that can only be written forward, as object stores have them."""

    def __init__(self, stream):
        self.stream = stream

    def write(self, data: bytes) -> int:
        self.stream.write(data)
        return len(data)

    def flush(self) -> None:
        self.stream.flush()


def read(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the packages (`path`, `records`): their fields and, if asked for, the payload.

    A task reads a range of RANGE_RECORDS records of a package, whose places its index gives.
    """
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
              ("payload_digest", pa.string()), ("record_type", pa.string()),
              ("refers_to", pa.int64())]
    spark_schema = ("page_id long, url string, payload_bytes long, payload_digest string, "
                    "record_type string, refers_to long")
    if payloads:
        names, schema = [*names, "payload"], [*schema, ("payload", pa.binary())]
        spark_schema += ", payload binary"

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(),
                                   batch.column("first").to_pylist(), strict=True):
                place, name = fs.FileSystem.from_uri(path)
                with place.open_input_file(name) as package:
                    data, entries = index_entries(package, package.size())
                    out, held = [], 0
                    for offset, length in entries[first:first + RANGE_RECORDS]:
                        record = parse_record(gzip.decompress(
                            read_at(package, data.offset + offset, length)))
                        out.append({n: record[n] for n in names})
                        held += record["payload_bytes"] if payloads else 100
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(out, pa.schema(schema))
                            out, held = [], 0
                    if out:
                        yield pa.RecordBatch.from_pylist(out, pa.schema(schema))

    ranges = packages.filter("records > 0").select("path", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("records") - 1, F.lit(RANGE_RECORDS).cast("long"))).alias("first"))
    width = max(1, min(ranges.count(), MOST_TASKS))
    return ranges.repartition(width).mapInArrow(fetch, spark_schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
               url_col: str = "url") -> DataFrame:
    """Writes a record per page and reads all packages back."""
    folder = f"{shared_folder(pages.sparkSession)}/packages-{uuid.uuid4().hex}"
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    packages = materialized(write(decide(pages, id_col, html_col, url_col), folder))
    return read(packages, payloads=False)
