"""Web pages as WARC archives: written as one gzip stream, normalised to a member per record, read."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.tables import drop_stored, stored
from ledgerlake.plans.workspace import new_place

# Fixed values of the format.
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Bytes of records after which a task begins a new archive.
ARCHIVE_BYTES = 64 << 20
#: Payloads of fewer bytes are never stored as a reference.
SMALLEST_REVISIT = 100
#: The date of the records: the tables have none.
DATE = "1970-01-01T00:00:00Z"


class Record(NamedTuple):
    fields: dict[str, str]
    block: bytes

    @property
    def id(self) -> str | None:
        return self.fields["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">") or None

    @property
    def refers_to(self) -> str | None:
        target = self.fields.get("WARC-Refers-To")
        return target and target.removeprefix("<urn:page:").removesuffix(">")

    def http(self) -> tuple[dict[str, str], bytes]:
        """Header fields and payload of the HTTP message in the block."""
        head, _, payload = self.block.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")[1:]
        return dict(line.split(": ", 1) for line in lines), payload

    def encoded(self) -> bytes:
        fields = self.fields | {"Content-Length": str(len(self.block))}
        head = "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode()
        return b"".join([VERSION, b"\r\n", head, b"\r\n", self.block, b"\r\n\r\n"])


def response(page: str | None, url: str | None, payload: bytes, digest: str) -> Record:
    fields = {"WARC-Type": "response", "WARC-Record-ID": f"<urn:page:{page or ''}>"}
    if url is not None:
        fields["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda c: quote(c[0]), url)
    fields |= {
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return Record(fields, head.encode() + payload)


def revisit(record: Record, page: str) -> Record:
    """The record without its payload, as a reference to the page that has it."""
    fields = record.fields | {
        "WARC-Type": "revisit",
        "WARC-Profile": SAME_PAYLOAD,
        "WARC-Refers-To": f"<urn:page:{page}>",
    }
    return Record(fields, record.block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n")


def records(stream) -> Iterator[Record]:
    """The records of an inflated stream, one in memory at a time."""
    while line := stream.readline():
        if line.rstrip() != VERSION:
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name] = value
        size = int(fields.pop("Content-Length"))
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut short")
        yield Record(fields, block)


def _folder(place: str) -> tuple[fs.FileSystem, str]:
    store, path = fs.FileSystem.from_uri(place)
    store.create_dir(path, recursive=True)
    return store, path


class _Monolith:
    """An archive being written: all its records in one gzip stream."""

    def __init__(self, store: fs.FileSystem, folder: str):
        self.name = f"{uuid4().hex}.warc.gz"
        self.file = store.open_output_stream(f"{folder}/{self.name}", compression=None)
        self.zip = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.bytes = self.records = 0

    def add(self, record: Record) -> int:
        raw = record.encoded()
        self.file.write(self.zip.compress(raw))
        self.bytes += len(raw)
        self.records += 1
        return self.records - 1

    def close(self) -> None:
        self.file.write(self.zip.flush())
        self.file.close()


_WRITTEN = "page string, archive string, ordinal long, payload_bytes long, digest string"


def write_monoliths(pages: DataFrame, place: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a response record per row of `pages` (page string, url, payload) to archives in `place`.

    Returns a row per record: page, archive, ordinal in it, payload_bytes, digest. Archive names are
    new for each attempt of a task, so a lost or repeated attempt leaves at most an unlisted file.
    """

    def run(batches):
        store, folder = _folder(place)
        archive = None
        for batch in batches:
            rows = []
            for page, url, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (text or "").encode()
                digest = hashlib.sha256(payload).hexdigest()
                if archive is None:
                    archive = _Monolith(store, folder)
                at = archive.add(response(page, url, payload, digest))
                rows.append((page, archive.name, at, len(payload), digest))
                if archive.bytes >= archive_bytes:
                    archive.close()
                    archive = None
            types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.record_batch(columns or [pa.array([], t) for t in types], names=_names(_WRITTEN))
        if archive is not None:
            archive.close()

    return pages.mapInArrow(run, _WRITTEN)


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def normalise_archive(
    store: fs.FileSystem, source: str, target: str, references: dict[int, str]
) -> int:
    """Inflate `source` once and write each record as a gzip member of `target`.

    `references` names the page that a record (by ordinal) becomes a revisit of. Beside the target
    lies its index, `target`.idx: offset, length, type and record id of each member. Returns the
    number of records.
    """
    at = n = 0
    with (
        store.open_input_stream(source, compression=None) as packed,
        store.open_output_stream(target, compression=None) as out,
        store.open_output_stream(f"{target}.idx", compression=None) as index,
        io.BufferedReader(gzip.GzipFile(fileobj=packed)) as stream,
    ):
        for n, record in enumerate(records(stream), 1):
            if (page := references.get(n - 1)) is not None:
                record = revisit(record, page)
            member = gzip.compress(record.encoded(), 6, mtime=0)
            out.write(member)
            kind, name = record.fields["WARC-Type"], record.fields["WARC-Record-ID"]
            index.write(f"{at}\t{len(member)}\t{kind}\t{name}\n".encode())
            at += len(member)
    return n


def read_archive(store: fs.FileSystem, path: str) -> Iterator[Record]:
    """The records of a normalised archive, each by its place in the index."""
    with (
        store.open_input_file(path) as file,
        store.open_input_stream(f"{path}.idx", compression=None) as raw,
    ):
        for line in io.BufferedReader(raw):
            offset, length, _, name = line.decode().rstrip("\n").split("\t")
            file.seek(int(offset))
            (record,) = records(io.BytesIO(gzip.decompress(file.read(int(length)))))
            if record.fields["WARC-Record-ID"] != name:
                raise ValueError(f"{path}: the index names {name} at {offset}")
            yield record


def _spread(archives: DataFrame) -> DataFrame:
    """One archive to a task, as far as there are not too many."""
    return archives.repartition(max(1, min(archives.count(), 20_000)))


_NORMAL = "archive string, records long"
_READ = (
    "page string, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to string"
)


def archive_pages(
    pages: DataFrame,
    *,
    place: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    smallest_revisit: int = SMALLEST_REVISIT,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write all pages to normalised archives in `place`; returns a row per archive: archive (path).

    Each page is a response record of its whole html in UTF-8 (null: empty), first in archives of
    one gzip stream each, then, inflated once and rewritten, in archives with a gzip member per
    record and an index beside them. Of pages with equal payloads of `smallest_revisit` bytes or
    more, those with the smallest id stay responses, the others become revisits of it. Rows that
    repeat that id all stay responses; a page without id refers to one with, and is a response if
    none of its kind has an id. An empty table gives no archive. Only ids and digests are shuffled;
    a payload that very many pages share meets as one row per task.

    `place` is a folder that all machines reach by the same URI and pyarrow can write to; without
    it, a new one in the session's shared folder.
    """
    spark = pages.sparkSession
    place = place or new_place(spark, "warc")
    rows = pages.select(F.col(page_id).cast("string"), F.col(url), F.col(html))
    written = stored(write_monoliths(rows, f"{place}/whole", archive_bytes), "warc-written")
    kind = pages.schema[page_id].dataType
    large = written.where(F.col("payload_bytes") >= smallest_revisit)
    first = (
        large.groupBy("digest")
        .agg(F.min(F.col("page").cast(kind)).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", F.col("first").cast("string").alias("first"))
    )
    again = large.join(first, "digest").where(~F.col("page").eqNullSafe(F.col("first")))
    references = again.groupBy("archive").agg(
        F.collect_list(F.struct("ordinal", "first")).alias("references")
    )
    archives = written.select("archive").distinct().join(references, "archive", "left")

    def run(batches):
        store, folder = _folder(place)
        for batch in batches:
            names = batch.column(0).to_pylist()
            counts = []
            for name, pairs in zip(names, batch.column(1).to_pylist(), strict=True):
                known = {p["ordinal"]: p["first"] for p in pairs or ()}
                target = f"{folder}/{uuid4().hex}.warc.gz"
                n = normalise_archive(store, f"{folder}/whole/{name}", target, known)
                counts.append((target.rsplit("/", 1)[1], n))
            paths = [f"{place}/{name}" for name, _ in counts]
            yield pa.record_batch(
                [pa.array(paths, pa.string()), pa.array([n for _, n in counts], pa.int64())],
                names=_names(_NORMAL),
            )

    normal = stored(_spread(archives).mapInArrow(run, _NORMAL), "warc-archives")
    drop_stored(written)
    store, folder = fs.FileSystem.from_uri(place)
    if store.get_file_info(f"{folder}/whole").type == fs.FileType.Directory:
        store.delete_dir(f"{folder}/whole")
    return normal


def read_archives(archives: DataFrame, archive: str = "archive") -> DataFrame:
    """A row per record of normalised archives: page, url, payload_bytes, payload_digest, record_type,
    refers_to. Sizes and digests of revisits are those of the payload they refer to; those of
    responses are taken from the payload itself, which must agree with the record's digest."""

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, local = fs.FileSystem.from_uri(path)
                rows = []
                for record in read_archive(store, local):
                    head, payload = record.http()
                    kind = record.fields["WARC-Type"]
                    digest = record.fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = int(head["Content-Length"])
                    if kind == "response" and (
                        len(payload) != size or hashlib.sha256(payload).hexdigest() != digest
                    ):
                        raise ValueError(f"{path}: the payload of {record.id} is damaged")
                    target = record.fields.get("WARC-Target-URI")
                    rows.append((record.id, target, size, digest, kind, record.refers_to))
                    if len(rows) == 10_000:
                        yield _read_batch(rows)
                        rows = []
                yield _read_batch(rows)

    return _spread(archives.select(archive)).mapInArrow(run, _READ)


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
    columns = [pa.array([row[k] for row in rows], t) for k, t in enumerate(types)]
    return pa.record_batch(columns, names=_names(_READ))
