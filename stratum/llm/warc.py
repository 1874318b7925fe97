"""WARC archives with a two-level capture index.

Pages are written as WARC/1.1 records, each a gzip member of its own, into files of bounded size. The index sorts all
captures by URL key (host reversed, then path) into compressed blocks; of each block its directory keeps the first
key. A lookup searches the directory by halving, reads one block by its range, searches that, and reads the record by
its range. Directories are per index part, and what tells parts apart is one row for each.

Tasks write and read the files with ``pyarrow.fs``, so the folder may be on any store that knows (local, HDFS, S3, GCS,
ABFS). File names are new for each attempt of a task; only what a successful attempt returns is in the index.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.tables import stored
from stratum.session import work_root

FILE_BYTES = 64 << 20
BLOCK_ENTRIES = 256
PART_ENTRIES = 100_000
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
GZIP = 31  # window bits of a gzip member

ENTRY = pa.schema([("url_key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
ENTRY_SQL = "url_key string, page_id long, file string, offset long, length long"


def url_key(url: Column) -> Column:
    """``https://Blog.Example.com:80/a?b#c`` as ``com,example,blog)/a?b``; empty for a missing url, no case change in the path."""
    prefix = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?"
    url = F.coalesce(url, F.lit(""))
    host = F.array_join(F.reverse(F.split(F.lower(F.regexp_extract(url, prefix, 1)), r"\.")), ",")
    rest = F.regexp_replace(F.regexp_replace(url, prefix, ""), "#.*$", "")
    return F.when(url == "", "").otherwise(F.concat(host, F.lit(")"), rest))


# --- records --------------------------------------------------------------------------------------------------------


class Record(NamedTuple):
    page_id: int | None
    payload_bytes: int
    payload_digest: str
    record_type: str
    refers_to: int | None
    payload: bytes | None


def _page_uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page_of(uri: str | None) -> int | None:
    number = uri.removeprefix("<urn:x-page:").removesuffix(">") if uri else ""
    return int(number) if number else None


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record. A revisit has the HTTP head of the full payload but not the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_page_uri(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%/:?#[]@!$&'()*+,;=~-._"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_page_uri(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def parse_record(data: bytes) -> Record:
    """The record again. A response whose payload does not have the digest that it is filed under is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_fields(http)["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return Record(_page_of(fields["WARC-Record-ID"]), size, digest, kind, _page_of(fields.get("WARC-Refers-To")),
                  payload if kind == "response" else None)


class _Files:
    """Files written one after another into a folder, each closed when it is full."""

    def __init__(self, folder: str, name: str, limit: int):
        self.system, self.path = fs.FileSystem.from_uri(folder)
        self.system.create_dir(self.path, recursive=True)
        self.name, self.limit, self.stream = name, limit, None

    def append(self, data: bytes) -> tuple[str, int]:
        if self.stream is None:
            self.file, self.size = self.name.format(uuid.uuid4().hex), 0
            self.stream = self.system.open_output_stream(f"{self.path}/{self.file}", compression=None)
        at = self.size
        self.stream.write(data)
        self.size += len(data)
        if self.size >= self.limit:
            self.close()
        return self.file, at

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def _write_records(folder: str, file_bytes: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, "pages-{}.warc.gz", file_bytes)
        for batch in batches:
            out = {name: [] for name in ENTRY.names}
            for page_id, url, key, html, sha1, revisit, refers_to in zip(*(batch.column(c) for c in (
                    "page_id", "url", "url_key", "payload", "sha1", "revisit", "refers_to"))):
                digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                data = record_bytes(page_id.as_py(), url.as_py(), html.as_py().encode(), digest, refers_to.as_py(), revisit.as_py())
                pack = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                data = pack.compress(data) + pack.flush()
                file, offset = files.append(data)
                for name, value in zip(ENTRY.names, (key.as_py(), page_id.as_py(), file, offset, len(data))):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, ENTRY)
        files.close()

    return write


# --- index ----------------------------------------------------------------------------------------------------------


class Archive(NamedTuple):
    folder: str  # of the records
    index: str  # of the blocks and directories
    parts: list[tuple[str, str]]  # first key and directory file of each part, in order of keys


def _sort_key(url_key: str, page_id: int | None) -> tuple[bytes, int]:
    return url_key.encode(), -1 << 63 if page_id is None else page_id


def _write_index(folder: str):
    """Blocks of entries in one file per part, and a directory of their first keys beside it."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, directory, held = _Files(folder, "blocks-{}.gz", 1 << 62), [], []

        def flush() -> None:
            data = zlib.compress("\n".join(map(json.dumps, held)).encode(), LEVEL)
            file, offset = files.append(data)
            directory.append([*held[0][:2], file, offset, len(data)])
            held.clear()

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ENTRY.names)):
                held.append(row)
                if len(held) == BLOCK_ENTRIES:
                    flush()
        if held:
            flush()
        files.close()
        if directory:
            sparse = _Files(folder, "directory-{}.gz", 0)
            file, _ = sparse.append(zlib.compress(json.dumps(directory).encode(), LEVEL))
            yield pa.RecordBatch.from_pydict({"url_key": [directory[0][0]], "page_id": pa.array([directory[0][1]], pa.int64()), "directory": [file]})

    return write


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The pages with payload, digest, and the page that each revisits.

    The originals are one row per payload, grouped without the payloads and stored: Spark broadcasts them if their
    measured size is small, so that no payload moves. Otherwise both sides of the join end in a shuffle of their own, and
    AQE splits the copies of a payload that comes very often.
    """
    payload = F.coalesce("html", F.lit(""))
    captures = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", url_key(F.col("url")).alias("url_key"), payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("sha1"))
    latest = pages.where(F.octet_length(payload) >= min_bytes).groupBy(F.sha1(payload.cast("binary")).alias("sha1")).agg(
        F.max(F.col("page_id").cast("long")).alias("original"))
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return captures.join(stored(latest), "sha1", "left").withColumn("revisit", revisit).withColumn(
        "refers_to", F.when(F.col("revisit"), F.col("original"))).drop("original")


def write_archive(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, file_bytes: int = FILE_BYTES,
                  part_entries: int = PART_ENTRIES) -> Archive:
    """Archives of ``pages(page_id, url, html)`` with their index, in a new folder below the shared one.

    A missing html is an empty payload, a missing url an empty key. Of the pages with one payload of at least
    ``min_bytes`` that with the largest page_id is a response and the others are revisits of it; smaller payloads and
    those of pages without any page_id are all responses. If the row of the largest page_id is repeated, each is a
    response. An empty table gives an archive without records. Extra columns are not looked at.
    """
    folder = folder or work_root(pages.sparkSession)
    records = with_originals(pages, min_bytes)
    entries = stored(records.mapInArrow(_write_records(f"{folder}/records", file_bytes), ENTRY_SQL))
    parts = entries.count() // part_entries + 1
    order = ("url_key", "page_id", "file", "offset")
    index = entries.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    written = index.mapInArrow(_write_index(f"{folder}/index"), "url_key string, page_id long, directory string").collect()
    written.sort(key=lambda r: (_sort_key(r.url_key, r.page_id), r.directory))
    return Archive(f"{folder}/records", f"{folder}/index", [(r.url_key, r.page_id, r.directory) for r in written])


# --- lookups --------------------------------------------------------------------------------------------------------


class _Ranges:
    """Range reads from the files of a folder, the last one kept open."""

    def __init__(self, folder: str):
        self.system, self.path = fs.FileSystem.from_uri(folder)
        self.name, self.file = None, None

    def read(self, name: str, offset: int | None = None, length: int | None = None) -> bytes:
        if name != self.name:
            self.name, self.file = name, self.system.open_input_file(f"{self.path}/{name}")
        if offset is None:
            offset, length = 0, self.file.size()
        return self.file.read_at(length, offset)


def _block_entries(ranges: _Ranges, block: list) -> list[list]:
    return [json.loads(line) for line in zlib.decompress(ranges.read(*block[2:])).decode().split("\n")]


def find_entries(ranges: _Ranges, directory: list[list], keys: Iterable[tuple[str, int | None]]) -> Iterator[list]:
    """All entries of each (different) key that this part has; ``keys`` in order, so each block is read once."""
    firsts = [_sort_key(*row[:2]) for row in directory]
    at, entries, sorts = -1, [], []
    for key in keys:
        wanted = _sort_key(*key)
        block = max(0, bisect.bisect_left(firsts, wanted) - 1)  # equal keys may begin in the block before
        while block < len(directory) and (block == 0 or firsts[block] <= wanted):
            if block != at:
                at, entries = block, _block_entries(ranges, directory[block])
                sorts = [_sort_key(*e[:2]) for e in entries]
            yield from entries[bisect.bisect_left(sorts, wanted) : bisect.bisect_right(sorts, wanted)]
            block += 1


def _locate(archive_index: str, directories):
    def locate(group: pa.Table) -> pa.Table:
        ranges = _Ranges(archive_index)
        name = directories.value[group.column("part")[0].as_py()]
        directory = json.loads(zlib.decompress(ranges.read(name)))
        keys = sorted(set(zip(group.column("url_key").to_pylist(), group.column("page_id").to_pylist())), key=lambda k: _sort_key(*k))
        found = list(zip(*find_entries(ranges, directory, keys))) or [[] for _ in ENTRY.names]
        return pa.table(dict(zip(ENTRY.names, map(list, found))), ENTRY)

    return locate


def _parts_of(firsts):
    """The parts that can hold a key: the last one that begins before it, and all that begin with it."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins = firsts.value
        for batch in batches:
            keys = [_sort_key(*k) for k in zip(batch.column("url_key").to_pylist(), batch.column("page_id").to_pylist())]
            low = np.maximum([bisect.bisect_left(begins, k) - 1 for k in keys], 0)
            high = [max(a + 1, bisect.bisect_right(begins, k)) for a, k in zip(low.tolist(), keys)]
            counts = np.array(high) - low
            row = np.repeat(np.arange(len(keys)), counts)
            part = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("url_key").take(pa.array(row)), batch.column("page_id").take(pa.array(row)), pa.array(part.astype(np.int64))],
                ["url_key", "page_id", "part"])

    return rows


def lookup(spark: SparkSession, archive: Archive, keys: DataFrame) -> DataFrame:
    """The index entries of all different ``keys(url_key, page_id)``, through directory and blocks."""
    context = spark.sparkContext
    if not archive.parts:
        return spark.createDataFrame([], ENTRY_SQL)
    firsts = context.broadcast([_sort_key(k, i) for k, i, _ in archive.parts])
    names = context.broadcast([name for *_, name in archive.parts])
    routed = keys.select("url_key", F.col("page_id").cast("long").alias("page_id")).distinct().mapInArrow(
        _parts_of(firsts), "url_key string, page_id long, part long")
    return routed.groupBy("part").applyInArrow(_locate(archive.index, names), ENTRY_SQL)


RECORD_SQL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64()), ("payload", pa.binary())])


def _read_records(folder: str):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = _Ranges(folder)
        for batch in batches:
            rows, held = [], 0
            for place in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                rows.append(parse_record(zlib.decompress(ranges.read(*place), GZIP)))
                held += rows[-1].payload_bytes
                if held > 8 << 20:
                    yield _records(rows)
                    rows, held = [], 0
            yield _records(rows)

    return read


def _records(rows: list[Record]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({name: [getattr(r, name) for r in rows] for name in _RECORD.names}, _RECORD)


def read_records(archive: Archive, entries: DataFrame) -> DataFrame:
    """The records at these entries, read by range, file by file in order of their places."""
    places = entries.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    return places.mapInArrow(_read_records(archive.folder), RECORD_SQL)


def fetch(spark: SparkSession, archive: Archive, url: str) -> list[Record]:
    """All captures of one url, read by the driver: halving over parts, directory and block, then range reads."""
    key = spark.range(1).select(url_key(F.lit(url))).first()[0]
    begins = [k.encode() for k, _, _ in archive.parts]
    blocks, records, out = _Ranges(archive.index), _Ranges(archive.folder), []
    first = max(0, bisect.bisect_left(begins, key.encode()) - 1)
    for _, _, name in archive.parts[first : max(first + 1, bisect.bisect_right(begins, key.encode()))]:
        directory = json.loads(zlib.decompress(blocks.read(name)))
        firsts = [row[0].encode() for row in directory]
        at = max(0, bisect.bisect_left(firsts, key.encode()) - 1)
        for block in directory[at : max(at + 1, bisect.bisect_right(firsts, key.encode()))]:
            entries = _block_entries(blocks, block)
            keys = [e[0].encode() for e in entries]
            for e in entries[bisect.bisect_left(keys, key.encode()) : bisect.bisect_right(keys, key.encode())]:
                out.append(parse_record(zlib.decompress(records.read(*e[2:]), GZIP)))
    return out
