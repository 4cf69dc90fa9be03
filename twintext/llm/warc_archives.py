"""Web pages as WARC records in ZIP-packaged archives, and a reader by ranges.

An archive is a ZIP file that only stores: ``archive/data.warc.gz`` holds the
records, compressed one by one, ``indexes/index.cdxj`` one line per record with
its place. The reader takes a table of archive paths, parses the end records and
the central directory (with their ZIP64 forms), finds the stored members and
reads the index; the places are then dealt out, and tasks read single records
from the files by range. No member is ever extracted, and an archive may be read
by many tasks.

Of records with equal payloads of ``least_bytes`` or more the one with the least
id is a response, the others are revisits that name it and repeat its digest and
length. Archives are written under new names and listed in a manifest once they
are complete, so what failed or repeated tasks leave behind is never read.

A null payload is empty. A null id is written as no id, and such a record is a
response. Rows that share an id are written one by one. An empty table gives no
archive and no record. Payloads are written whole. A null address is left out;
line breaks in one are escaped. Other columns are not read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twintext.llm.common import Scratch, ship_package

_RECORDS, _BYTES = 50_000, 1 << 29  # of an archive; then the next one begins
_DATA, _INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_DATE = "1970-01-01T00:00:00Z"  # the pages carry no time
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:page:"
_CHUNK = 1 << 20
_RANGE_BYTES = 1 << 22  # of neighbouring records in one request
_TASK_BYTES = 1 << 26  # of compressed records to a reading task

RECORD = (
    "archive string, offset long, id long, record_type string, target_uri string, refers_to long, "
    "digest string, length long, payload binary"
)


def _file_system(path: str):
    """The file system of a URI or local path, and the path in it."""
    from pyarrow.fs import FileSystem

    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file:///" + path.removeprefix("file:").lstrip("/")
    return FileSystem.from_uri(path)


# --- Writing


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: an HTTP response with its payload, or a revisit with the headers only."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if refers_to is None else http
    name = "none" if page_id is None else page_id
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{_ID}{name}>"),
        ("WARC-Date", _DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{_ID}{refers_to}>"), ("WARC-Profile", _PROFILE)]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


class _Archive:
    """One archive being written as a stream."""

    def __init__(self, folder: str):
        import zipfile

        self.path = f"{folder}/{uuid.uuid4().hex}.zip"
        system, inside = _file_system(self.path)
        system.create_dir(inside.rsplit("/", 1)[0], recursive=True)
        self._stream = system.open_output_stream(inside)
        self._zip = zipfile.ZipFile(self._stream, "w", zipfile.ZIP_STORED)
        self._data = self._zip.open(_DATA, "w", force_zip64=True)
        self.bytes, self._lines = 0, []

    @property
    def records(self) -> int:
        return len(self._lines)

    def add(self, page_id, record: bytes) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        self._data.write(packed)
        place = {"offset": self.bytes, "length": len(packed), "filename": _DATA}
        self._lines.append(f"{page_id} {_DATE} {json.dumps(place)}\n")
        self.bytes += len(packed)

    def close(self) -> None:
        self._data.close()
        self._zip.writestr(_INDEX, "".join(self._lines))
        self._zip.close()
        self._stream.close()


def with_record_types(
    pages: DataFrame, scratch: Scratch, least_bytes: int, page_id: str, url: str, payload: Column
) -> DataFrame:
    """``(id, url, payload, digest, refers_to)``: revisits name the response they repeat."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("id"), F.col(url).alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    # Ids and digests first: payloads meet what was found by id, so equal ones stay spread.
    long_enough = rows.where(F.octet_length("payload") >= least_bytes).where("id IS NOT NULL")
    named = scratch.write(long_enough.select("id", "digest"), "named")
    first = named.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = named.join(first.drop("n"), "digest").where("id <> first")
    again = scratch.write(again.select("id", "digest", F.col("first").alias("refers_to")).distinct(), "repeated")
    return rows.join(again, ["id", "digest"], "left").select("id", "url", "payload", "digest", "refers_to")


def write_archives(
    pages: DataFrame, folder: str, scratch: Scratch, least_bytes: int = 100, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write every row as a record into ZIP archives in ``folder``; the manifest ``(archive, records)``."""
    ship_package(pages.sparkSession)
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = with_record_types(pages, scratch, least_bytes, page_id, url, payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from twintext.llm import warc_archives as here

        archive = None

        def finished() -> pa.RecordBatch:
            archive.close()
            return pa.RecordBatch.from_pydict({"archive": [archive.path], "records": [archive.records]})

        for batch in batches:
            for row in zip(*batch.columns):
                page, address, payload, digest, refers_to = (v.as_py() for v in row)
                archive = archive or here._Archive(folder)
                archive.add(page, here.record_bytes(page, address, payload, digest, refers_to))
                if archive.records >= here._RECORDS or archive.bytes >= here._BYTES:
                    yield finished()
                    archive = None
        if archive:
            yield finished()

    return scratch.write(rows.mapInArrow(run, "archive string, records long"), "manifest")


# --- Reading


class Member(NamedTuple):
    """A member of a ZIP file, from the central directory."""

    name: str
    method: int  # 0: stored
    header: int  # offset of the local header
    packed: int  # bytes in the file


def _at(file, offset: int, size: int) -> bytes:
    data = file.read_at(size, offset)
    if len(data) != size:
        raise ValueError(f"the archive ends before {offset + size}")
    return data


def _directory(file, size: int) -> tuple[int, int]:
    """Offset and size of the central directory, from the end records."""
    tail_size = min(size, 22 + 0xFFFF)
    tail = _at(file, size - tail_size, tail_size)
    at = tail.rfind(b"PK\5\6")
    # The signature may also occur in the comment: its length then does not fit.
    while at >= 0 and (at + 22 > tail_size or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != tail_size):
        at = tail.rfind(b"PK\5\6", 0, at)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file, or cut off")
    length, start = struct.unpack_from("<II", tail, at + 12)
    end = size - tail_size + at
    locator = _at(file, end - 20, 20) if end >= 20 else b""
    if locator[:4] == b"PK\6\7":
        (record_at,) = struct.unpack_from("<Q", locator, 8)
        record = _at(file, record_at, 56)
        if record[:4] != b"PK\6\6":
            raise ValueError("the ZIP64 end record is not where its locator says")
        length, start = struct.unpack_from("<QQ", record, 40)
    return start, length


def members(file, size: int) -> Iterator[Member]:
    """The members that the central directory lists."""
    start, length = _directory(file, size)
    data = _at(file, start, length)
    at = 0
    while at < length:
        if data[at : at + 4] != b"PK\1\2":
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
        (header,) = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, end = at + 46 + n_name, at + 46 + n_name + n_extra
        while extra + 4 <= end:
            kind, n = struct.unpack_from("<HH", data, extra)
            if kind == 1:  # ZIP64: those values, in this order, that did not fit above
                place = extra + 4
                if plain == 0xFFFFFFFF:
                    place += 8
                if packed == 0xFFFFFFFF:
                    (packed,) = struct.unpack_from("<Q", data, place)
                    place += 8
                if header == 0xFFFFFFFF:
                    (header,) = struct.unpack_from("<Q", data, place)
            extra += 4 + n
        if flags & 1:
            raise ValueError(f"{name} is encrypted")
        yield Member(name, method, header, packed)
        at = end + n_comment


def data_offset(file, member: Member) -> int:
    """Where a member's bytes begin: its local header has lengths of its own."""
    header = _at(file, member.header, 30)
    if header[:4] != b"PK\3\4":
        raise ValueError(f"no local header of {member.name}")
    n_name, n_extra = struct.unpack_from("<HH", header, 26)
    return member.header + 30 + n_name + n_extra


def _lines(file, start: int, size: int) -> Iterator[bytes]:
    """Lines of a range, read piece by piece."""
    rest = b""
    for at in range(start, start + size, _CHUNK):
        *whole, rest = (rest + _at(file, at, min(_CHUNK, start + size - at))).split(b"\n")
        yield from whole
    if rest:
        yield rest


def record_places(file, size: int) -> Iterator[tuple[int, int]]:
    """Offset in the archive and length of every record that the indexes list."""
    found = {m.name: m for m in members(file, size)}
    starts: dict[str, int] = {}
    for index in [m for n, m in found.items() if n.startswith("indexes/") and n.endswith((".cdx", ".cdxj"))]:
        if index.method:
            raise ValueError(f"{index.name} is not stored")
        for line in _lines(file, data_offset(file, index), index.packed):
            at = line.find(b"{")
            if at < 0:
                continue
            place = json.loads(line[at:])
            name = place["filename"]
            if name not in starts:
                member = found.get(name) or found[f"archive/{name}"]
                if member.method:
                    raise ValueError(f"{member.name} is not stored")
                starts[name] = data_offset(file, member)
            yield starts[name] + int(place["offset"]), int(place["length"])


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _page_of(name: str | None) -> int | None:
    number = (name or "").strip("<>").removeprefix(_ID)
    return int(number) if number.lstrip("-").isdigit() else None


def parsed_record(data: bytes) -> tuple:
    """``(id, type, uri, refers_to, digest, length, payload)`` of one compressed record."""
    record = zlib.decompress(data, 47) if data[:2] == b"\x1f\x8b" else data
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    length = int(_fields(http).get("content-length", len(payload)))
    return (
        _page_of(fields.get("warc-record-id")),
        kind,
        fields.get("warc-target-uri"),
        _page_of(fields.get("warc-refers-to")),
        fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        length,
        payload if kind == "response" else None,
    )


def locate_records(archives: DataFrame) -> DataFrame:
    """``(archive, offset, length)`` of all records of the archives at ``archive``."""
    ship_package(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from twintext.llm import warc_archives as here

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inside = here._file_system(path)
                with system.open_input_file(inside) as file:
                    places = list(here.record_places(file, file.size()))
                for k in range(0, len(places), 10_000):
                    offsets, lengths = zip(*places[k : k + 10_000])
                    yield pa.RecordBatch.from_pydict(
                        {"archive": [path] * len(offsets), "offset": offsets, "length": lengths},
                        pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]),
                    )

    # One archive at a time: a directory is small, but there are many of them.
    spread = archives.select("archive").repartition("archive")
    return spread.mapInArrow(run, "archive string, offset long, length long")


def _runs(offsets: list[int], lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges of records that lie one behind the other, of up to ``most`` bytes or one record."""
    start = 0
    for k in range(1, len(offsets) + 1):
        if (
            k == len(offsets)
            or offsets[k] != offsets[k - 1] + lengths[k - 1]
            or offsets[k] + lengths[k] - offsets[start] > most
        ):
            yield start, k
            start = k


def read_tasks(places: DataFrame) -> int:
    """Tasks to read with, by the bytes of the records: 64 MB each, fewer where that leaves cores idle."""
    size = places.agg(F.sum("length")).first()[0] or 0
    cores = places.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-size // _TASK_BYTES), min(cores, -(-size // _RANGE_BYTES)))


def read_records(places: DataFrame) -> DataFrame:
    """The records at ``(archive, offset, length)``, each read by its range.

    Records that lie one behind the other are read in one request of up to 4 MB
    and cut. Places are dealt in stretches of that size, to a number of tasks that
    follows the bytes to be read, not the size of the index; for that number
    ``places`` is computed once more, so it should be a stored table.
    """
    ship_package(places.sparkSession)
    schema = pa.schema(
        [("archive", pa.string()), ("offset", pa.int64()), ("id", pa.int64()), ("record_type", pa.string()),
         ("target_uri", pa.string()), ("refers_to", pa.int64()), ("digest", pa.string()),
         ("length", pa.int64()), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from twintext.llm import warc_archives as here

        rows, held = [], 0
        for batch in batches:
            archives, offsets, lengths = (c.to_pylist() for c in batch.columns)
            cuts = [k for k in range(1, len(archives)) if archives[k] != archives[k - 1]]
            for low, high in zip([0, *cuts], [*cuts, len(archives)]):
                if low == high:
                    continue
                system, inside = here._file_system(archives[low])
                with system.open_input_file(inside) as file:
                    for start, end in here._runs(offsets[low:high], lengths[low:high], here._RANGE_BYTES):
                        base = offsets[low + start]
                        data = here._at(file, base, offsets[low + end - 1] + lengths[low + end - 1] - base)
                        for k in range(low + start, low + end):
                            at = offsets[k] - base
                            row = here.parsed_record(data[at : at + lengths[k]])
                            rows.append((archives[k], offsets[k], *row))
                            held += len(row[-1] or b"") + 200
                            if held > 1 << 24:
                                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    stretch = F.call_function("div", F.col("offset"), F.lit(_RANGE_BYTES))
    dealt = places.select("archive", "offset", "length").repartition(read_tasks(places), "archive", stretch)
    return dealt.sortWithinPartitions("archive", "offset").mapInArrow(run, RECORD)


def written_and_read(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Archive all pages and read them back: ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``.

    Length and digest of a response are those of the payload read, of a revisit
    those that it repeats from its response.
    """
    spark: SparkSession = pages.sparkSession
    scratch = Scratch(spark, "warc")
    manifest = write_archives(pages, f"{scratch.base}/archives", scratch, least_bytes)
    records = read_records(scratch.write(locate_records(manifest), "places"))
    full = F.col("record_type") == "response"
    return records.select(
        F.col("id").alias("page_id"),
        F.when(full, F.octet_length("payload")).otherwise(F.col("length")).cast("long").alias("payload_bytes"),
        F.when(full, F.sha2("payload", 256)).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
