"""Web archives in ZIP packages: records are written once and read back by ranges.

A package holds stored members: ``archive/*.warc.gz``, WARC records that are
compressed one by one, and ``indexes/index.cdxj``, one JSON line per record with
its member, offset and length. A task writes its rows into packages of bounded
size under names of its own; only packages in the manifest, which Spark commits
as a table, count, so a repeated task leaves nothing that is read twice.

Reading goes the other way: directories of the packages (central directory and
ZIP64 records), the indexes, then every record by its range. Record ranges, not
packages, are dealt to the tasks.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import math
import os
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.stores import shared_folder, written
from cratewise.llm.words import small
from cratewise.llm.zip_reader import DamagedPackage, members

# A payload of fewer bytes is never revisited.
LEAST_SHARED = 100
# Copies of a row that are made at a time.
COPIES = 10_000
# Bytes of a package, of a member, and of the ranges that one task reads together.
PACKAGE_BYTES, MEMBER_BYTES, RANGE_BYTES = 64 << 20, 4 << 20, 8 << 20

# Fixed values of the record format.
VERSION, LINE = b"WARC/1.1", b"\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGEST = "sha256:"
PLAIN = "".join(map(chr, range(0x21, 0x7F)))

INDEX = "indexes/index.cdxj"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named as Spark names it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    elif path.startswith(("s3a://", "s3n://")):
        path = "s3" + path[3:]
    elif "://" not in path:
        path = os.path.abspath(path)
    return fs.FileSystem.from_uri(path)


def _name(page_id: str | None) -> str:
    return "" if page_id is None else "id-" + quote(page_id, safe="")


def _id(name: str) -> str | None:
    return unquote(name.removeprefix("id-")) if name else None


def record(page_id: str | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: str | None, own: str, date: str) -> bytes:
    """One WARC record; without ``payload`` a revisit of the response of page ``refers_to``.

    ``own`` marks a record that nothing refers to; a response that others revisit
    is named by its page and digest alone.
    """
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + (payload or b"")
    fields = [
        ("WARC-Type", "response" if payload is not None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{_name(page_id)}:{digest}{own}>"),
        ("WARC-Date", date),
        ("WARC-Page-ID", _name(page_id)),
        ("WARC-Payload-Digest", DIGEST + digest),
        ("WARC-Block-Digest", DIGEST + hashlib.sha256(block).hexdigest()),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=PLAIN)))
    if payload is None:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<urn:page:{_name(refers_to)}:{digest}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"".join([VERSION, LINE, *[f"{k}: {v}\r\n".encode() for k, v in fields], LINE, block, LINE, LINE])


def _fields(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields of a record (names in lower case), fields of its HTTP head, payload."""
    head, found, rest = data.partition(LINE + LINE)
    lines = head.split(LINE)
    if not found or lines[0] != VERSION:
        raise DamagedPackage("not a record")
    fields = _fields(lines[1:])
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != LINE + LINE:
        raise DamagedPackage(f"record {fields.get('warc-record-id')} is cut")
    if fields["warc-block-digest"] != DIGEST + hashlib.sha256(block).hexdigest():
        raise DamagedPackage(f"record {fields.get('warc-record-id')} is changed")
    http, _, payload = block.partition(LINE + LINE)
    return fields, _fields(http.split(LINE)[1:]), payload


class _Package:
    """A package being written: members are filled one after the other, the index comes last."""

    def __init__(self, folder: str):
        system, base = open_folder(folder)
        name = f"{uuid.uuid4().hex}.zip"
        system.create_dir(base, recursive=True)
        self.path, self.bytes, self.records, self.number = f"{folder}/{name}", 0, 0, 0
        self.out = system.open_output_stream(f"{base}/{name}")
        self.zip, self.member, self.index = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED), io.BytesIO(), []

    def _label(self) -> str:
        return f"archive/{self.number:05}.warc.gz"

    def add(self, data: bytes) -> None:
        data = gzip.compress(data, 6, mtime=0)
        self.index.append(json.dumps({"member": self._label(), "offset": self.member.tell(), "length": len(data)}))
        self.member.write(data)
        self.bytes, self.records = self.bytes + len(data), self.records + 1
        if self.member.tell() >= MEMBER_BYTES:
            self.store()

    def store(self) -> None:
        if self.member.tell():
            self.zip.writestr(self._label(), self.member.getbuffer())
            self.number, self.member = self.number + 1, io.BytesIO()

    def close(self) -> None:
        self.store()
        self.zip.writestr(INDEX, "\n".join(self.index))
        self.zip.close()
        self.out.close()


def _writer(folder: str, date: str, package_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in small(batches, 256):
            for page, url, payload, size, digest, lead, leads in zip(*[c.to_pylist() for c in batch.columns]):
                package = package or _Package(folder)
                own = "" if leads else f":{os.path.basename(package.path)}-{package.records}"
                package.add(record(page, url, payload, size, digest, lead, own, date))
                if package.bytes >= package_bytes:
                    package.close()
                    done, package = [*done, package], None
        if package is not None:
            package.close()
            done.append(package)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p.path for p in done], pa.string()), pa.array([p.records for p in done], pa.int64()), pa.array([p.bytes for p in done], pa.int64())],
            ["path", "records", "bytes"],
        )

    return run


def write_packages(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` (``page_id``, ``url``, ``html``) below ``folder``.

    Returns the manifest: ``path``, ``records`` and packed ``bytes`` of each
    package. Rows with equal payloads of at least 100 bytes become one response,
    that of the smallest page_id (any one of rows that repeat it; a null id only
    if none has an id), and revisits; a null html is an empty payload. Other
    columns are ignored.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = pages.select(
        "page_id", F.col("page_id").cast("string").alias("page"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"), F.sha2(payload, 256).alias("digest"),
    )
    # Short rows only, combined before the shuffle: a payload of many rows costs a row per task.
    # The table's size is then known, so Spark broadcasts it if small and merges sorted rows otherwise.
    shared = written(
        keyed.filter(F.col("size") >= LEAST_SHARED).groupBy("digest", "page_id", "page").agg(F.count("*").alias("n"))
        .groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "page", "n")).alias("lead"), F.sum("n").alias("times"))
        .filter("times > 1").select(F.col("digest").alias("of"), "lead.page_id", "lead.page", "lead.n").toDF("of", "lead_id", "lead", "n"), "shared"
    )
    is_lead = F.col("page_id").eqNullSafe(F.col("lead_id"))
    columns = ["page", "url", "payload", "size", "digest", "lead", "leads"]
    met = keyed.join(shared, F.col("digest") == F.col("of"), "left").withColumn("leads", F.col("of").isNotNull() & is_lead)
    single = met.filter(~F.col("leads") | (F.col("n") == 1))
    again = F.col("of").isNotNull() & ~F.col("leads")
    typed = single.withColumn("payload", F.when(~again, F.col("payload"))).select(columns)
    # A lead that the table repeats: one row answers, the others revisit it.
    repeated = keyed.join(shared.filter("n > 1"), (F.col("digest") == F.col("of")) & is_lead)
    answers = repeated.groupBy("digest", "lead").agg(F.min(F.struct("url", "page", "payload", "size")).alias("row"))
    answered = answers.select("row.page", "row.url", "row.payload", "row.size", "digest", "lead", F.lit(True).alias("leads"))
    taken = answers.select(F.col("digest").alias("taken"), F.col("row.url").alias("taken_url"))
    left = F.col("times") - F.when(F.col("taken").isNotNull(), 1).otherwise(0)
    copies = (
        repeated.groupBy("page", "url", "size", "digest", "lead").agg(F.count("*").alias("times"))
        .join(taken, (F.col("digest") == F.col("taken")) & F.col("url").eqNullSafe(F.col("taken_url")), "left")
        .withColumn("left", left).filter("left > 0")
        # In two steps, as one array could not hold every copy of a very frequent row.
        .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("left") - 1) / COPIES))))
        .withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.least(F.lit(COPIES), F.col("left") - F.col("run") * COPIES).cast("int"))))
        .withColumn("payload", F.lit(None).cast("binary")).withColumn("leads", F.lit(False))
    )
    typed = typed.unionByName(answered).unionByName(copies.select(columns))
    return written(typed.mapInArrow(_writer(folder, date, package_bytes), "path string, records long, bytes long"), "manifest")


@contextmanager
def _opened(path: str):
    folder, name = path.rsplit("/", 1)
    system, base = open_folder(folder)
    with system.open_input_file(f"{base}/{name}") as file:
        yield (lambda start, length: file.read_at(length, start)), file.size()


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with _opened(path) as (read, size):
                found = {m.name: m for m in members(read, size)}
                if INDEX not in found:
                    raise DamagedPackage(f"{path} has no index")
                lines = read(found[INDEX].place(read), found[INDEX].size).decode().splitlines()
                entries = [json.loads(line) for line in lines]
                begin = {name: found[name].place(read) for name in sorted({e["member"] for e in entries})}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(entries)), pa.array([begin[e["member"]] + e["offset"] for e in entries], pa.int64()),
                     pa.array([e["length"] for e in entries], pa.int64())], ["path", "start", "length"],
                )


def record_places(packages: DataFrame) -> DataFrame:
    """``path``, ``start`` and ``length`` of every record of the packages in column ``path``."""
    return packages.select("path").repartition("path").mapInArrow(_index_rows, "path string, start long, length long")


RECORD = "record_id string, page string, url string, payload_bytes long, payload_digest string, record_type string, refers_id string, refers string"


def _record_row(data: bytes) -> tuple:
    fields, http, payload = parsed(gzip.decompress(data))
    size, digest = int(http["content-length"]), fields["warc-payload-digest"].removeprefix(DIGEST)
    refers = fields.get("warc-refers-to")
    if fields["warc-type"] == "response":
        size, own = len(payload), hashlib.sha256(payload).hexdigest()
        if own != digest:
            raise DamagedPackage(f"payload of {fields['warc-record-id']} is changed")
    page = refers.removeprefix("<urn:page:").split(":")[0] if refers else ""
    return fields["warc-record-id"], _id(fields["warc-page-id"]), fields.get("warc-target-uri"), size, digest, fields["warc-type"], refers, _id(page), payload


def _record_rows(payloads: bool):
    names = [c.split()[0] for c in RECORD.split(", ")] + ["payload"] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 256):
            rows, at = list(zip(*[c.to_pylist() for c in batch.columns])), 0
            while at < len(rows):
                path, stop = rows[at][0], at
                while stop < len(rows) and rows[stop][0] == path:
                    stop += 1
                with _opened(path) as (read, _):
                    found = [_record_row(read(start, length)) for _, start, length in rows[at:stop]]
                columns = list(zip(*found))[: len(names)]
                kinds = [pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string() for n in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
                at = stop

    return run


def read_records(packages: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the packages in a manifest (``path``, ``bytes``), each read by its range and checked against its digests."""
    # Ranges are short rows that stand for many bytes: their number of partitions follows the bytes.
    parts = max(packages.sparkSession.sparkContext.defaultParallelism, math.ceil((packages.agg(F.sum("bytes")).first()[0] or 0) / RANGE_BYTES))
    near = record_places(packages).repartition(parts, "path", F.floor(F.col("start") / RANGE_BYTES)).sortWithinPartitions("path", "start")
    return near.mapInArrow(_record_rows(payloads), RECORD + ", payload binary" * payloads)


def with_payloads(records: DataFrame) -> DataFrame:
    """Revisits (``payload`` empty) get the payload of the response that they refer to."""
    responses = records.filter("record_type = 'response'").select(F.col("record_id").alias("response"), F.col("payload").alias("full"))
    return records.join(responses, records["refers_id"] == responses["response"], "left").withColumn("payload", F.coalesce("full", "payload")).drop("response", "full")


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write the ``pages`` (``page_id``, ``url``, ``html``) into packages and read them back.

    One row per page: ``page_id``, ``payload_bytes``, ``payload_digest`` (both of
    the full payload), ``record_type`` (``response`` or ``revisit``) and
    ``refers_to`` (the response's page_id, null for responses). A null html is
    an empty payload, always a response. A null page_id is kept; repeated rows
    are records of their own, one of them the response, the others revisits of
    their own id. An empty table writes no package and gives no rows. Other
    columns are ignored.
    """
    kind = pages.schema["page_id"].dataType
    folder = f"{shared_folder(pages.sparkSession)}/archives-{uuid.uuid4().hex}"
    records = read_records(write_packages(pages, folder))
    return records.select(
        F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers").cast(kind).alias("refers_to")
    )
