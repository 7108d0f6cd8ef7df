"""Operator 9: WARC archives with a two-level capture index.

Archives: every page becomes one gzip member, a ``response`` record or, where a
page of a smaller id has the same payload, a ``revisit`` record that names it
and carries the HTTP head (with the payload's length and digest) only.

Index: one line for each record, keyed by the URL with its host reversed
(``com,example)/path``), sorted over all archives, gzipped in blocks of
``BLOCK_LINES`` lines. The second level has one line for each block: its first
key, file, offset and length. A search finds the index file by its first key,
binary-searches that file's block directory, reads the blocks that may hold
the key and then the records by byte ranges. Keys of one task's range meet in
the same blocks, so a block is read once for many keys.

Rows and ties. A null html is an empty payload. Payloads are equal by length
and SHA-1. Pages that repeat both page_id and payload are responses each if
theirs is the smallest id (null ids count as larger than any other). A null url
has the key of an empty one. Empty tables give empty results. Other columns
are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_folder, ship, stage

BLOCK_LINES = 2000
ARCHIVE_BYTES = 1 << 28
MIN_REVISIT_BYTES = 0
#: Ranges of an archive that are this near are read at once.
#: Archive bytes that a reading task gets, searches of a searching one.
READ_BYTES, SEARCHES = 4 << 20, 20_000
GAP = 1 << 16
_DATE = "2024-01-01T00:00:00Z"      # a record needs one; pages carry none


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def surt(url: str | None) -> str:
    """Reversed-host key of a URL, printable characters only; unreadable ones keep their text after ``)``."""
    url = _clean((url or "").strip())
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return f"){url}"
    if host.startswith("www."):
        host = host[4:]
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "") + ")" + path


def _clean(text: str | None) -> str:
    return "".join(c if c.isprintable() and c != " " else f"%{ord(c):02X}" for c in (text or ""))


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """A WARC/1.1 record; ``refers`` is the response's page_id for a revisit, else None."""
    revisit = refers is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {_DATE}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>",
            f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(member: bytes) -> dict:
    """page_id, payload (None in a revisit), payload_bytes, payload_digest, record_type and refers_to of a record."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest32(payload) != digest):
        raise ValueError(f"damaged record of page {fields.get('X-Page-ID')}")
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page")
    return {"page_id": int(page) if page else None, "payload": payload if kind == "response" else None,
            "payload_bytes": length, "payload_digest": digest, "record_type": kind,
            "refers_to": int(refers) if refers else None}


# --- writing -----------------------------------------------------------------

class _Appender:
    """Files of gzip members in a folder; a new file beyond ``limit`` bytes."""

    def __init__(self, folder: str, suffix: str, limit: int):
        self.folder, self.suffix, self.limit, self.out, self.at = folder, suffix, limit, None, 0

    def add(self, member: bytes) -> tuple[str, int]:
        if self.out is None or self.at >= self.limit:
            self.close()
            self.path = f"{self.folder}/{uuid.uuid4().hex}.{self.suffix}"
            fs, where = _fs(self.path)
            fs.create_dir(where.rsplit("/", 1)[0], recursive=True)
            self.out, self.at = fs.open_output_stream(where, compression=None), 0
        spot = self.at
        self.out.write(member)
        self.at += len(member)
        return self.path, spot

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


LINES = "key string, page_id long, file string, at long, size long"


def _lines_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 5
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                      ["key", "page_id", "file", "at", "size"])


def _write_archives(folder: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rows = _Appender(folder, "warc.gz", limit), []
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, html, digest, refers = (batch.column(j)[i].as_py() for j in range(5))
                payload = (html or "").encode()
                member = gzip.compress(record(page, url, payload, digest32(payload), refers), 6, mtime=0)
                file, at = out.add(member)
                rows.append((surt(url), page, file, at, len(member)))
                if len(rows) >= 10_000:
                    yield _lines_batch(rows)
                    rows = []
        out.close()
        yield _lines_batch(rows)

    return run


def _write_index(folder: str, block_lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, directory, lines, first = _Appender(folder, "idx.gz", 1 << 62), [], [], None
        key0 = None

        def flush():
            nonlocal lines
            if lines:
                member = zlib_member("\n".join(lines))
                _, at = out.add(member)
                directory.append(f"{key0}\t{at}\t{len(member)}")
                lines = []

        for batch in batches:
            for key, page, file, at, size in zip(*[batch.column(j).to_pylist() for j in range(5)]):
                if not lines:
                    key0 = key
                first = key if first is None else first
                lines.append(f"{key}\t{'' if page is None else page}\t{file}\t{at}\t{size}")
                if len(lines) >= block_lines:
                    flush()
        flush()
        names = ["file", "first_key", "directory_at", "directory_size"]
        if first is None:
            yield pa.RecordBatch.from_arrays([pa.array([], pa.string()), pa.array([], pa.string()),
                                              pa.array([], pa.int64()), pa.array([], pa.int64())], names)
            return
        member = zlib_member("\n".join(directory))
        path, at = out.add(member)
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([first]), pa.array([at], pa.int64()),
                                          pa.array([len(member)], pa.int64())], names)

    return run


def zlib_member(text: str) -> bytes:
    return gzip.compress(text.encode("utf-8", "surrogatepass"), 6, mtime=0)


def write_archives(pages: DataFrame, folder: str | None = None, block_lines: int = BLOCK_LINES,
                   min_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives and index of ``pages`` (page_id, url, html); returns the index files.

    Payload digests are grouped with a minimum (pre-aggregated) and joined
    back for payloads that occur more than once.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = folder or fresh_folder(spark, "warc")
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                       F.expr("sha1(coalesce(html, ''))").alias("d"),
                       F.expr("octet_length(coalesce(html, ''))").alias("n"))
    shared = (src.where(F.col("n") >= min_bytes).groupBy("d", "n")
              .agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"))
    told = src.join(shared, ["d", "n"], "left").select(
        "page_id", "url", "html", "d", F.expr("IF(page_id IS NULL OR page_id <> least, least, NULL)").alias("refers"))
    lines = stage(told.mapInArrow(_write_archives(folder, archive_bytes), LINES), "captures")
    ordered = lines.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "file", "at")
    return stage(ordered.mapInArrow(_write_index(folder, block_lines),
                                    "file string, first_key string, directory_at long, directory_size long"), "index")


# --- searching -----------------------------------------------------------------

class Index:
    """Search over the index files (path, first key, place of the block directory), in key order."""

    def __init__(self, files: list[tuple[str, str, int, int]]):
        self.files = sorted(files, key=lambda f: f[1])
        self.first = [f[1] for f in self.files]
        self._opened: dict[str, tuple] = {}
        self._block: tuple | None = None

    def _open(self, i: int):
        path, _, at, size = self.files[i]
        if path not in self._opened:
            if len(self._opened) > 16:
                self._opened.clear()
            fs, where = _fs(path)
            f = fs.open_input_file(where)
            rows = [x.split("\t") for x in gzip.decompress(f.read_at(size, at)).decode("utf-8", "surrogatepass").split("\n")]
            self._opened[path] = f, [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]
        return self._opened[path]

    def _lines(self, i: int, block: int) -> tuple[list[str], list[list[str]]]:
        if self._block is None or self._block[0] != (i, block):
            f, _, spots = self._open(i)
            at, size = spots[block]
            rows = [x.split("\t") for x in gzip.decompress(f.read_at(size, at)).decode("utf-8", "surrogatepass").split("\n")]
            self._block = (i, block), ([r[0] for r in rows], rows)
        return self._block[1]

    def files_of(self, key: str) -> range:
        """The index files that may hold a key: by binary search over their first keys."""
        return range(max(0, bisect_left(self.first, key) - 1), bisect_right(self.first, key))

    def find(self, key: str, i: int) -> Iterator[tuple[int | None, str, int, int]]:
        """(page_id, archive, offset, length) of the captures of a key in file i."""
        _, firsts, _ = self._open(i)
        for block in range(max(0, bisect_left(firsts, key) - 1), bisect_right(firsts, key)):
            keys, rows = self._lines(i, block)
            for r in rows[bisect_left(keys, key):bisect_right(keys, key)]:
                yield int(r[1]) if r[1] else None, r[2], int(r[3]), int(r[4])


def lookup(keys: DataFrame, index: DataFrame) -> DataFrame:
    """Captures (key, page_id, file, at, size) of the distinct ``keys`` (key), by binary search.

    Every (key, index file that may hold it) is searched on its own, dealt by
    file and key: a task's keys lie in neighbouring blocks, and the captures of
    a very frequent key, which fill many files, are found by many tasks. The
    index files (one row each) are known to every task.
    """
    files = [tuple(r) for r in index.collect()]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Index(files)
        for batch in batches:
            pairs = [(k, i) for k in batch.column("key").to_pylist() for i in found.files_of(k)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()),
                                              pa.array([p[1] for p in pairs], pa.int32())], ["key", "i"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Index(files)
        for batch in batches:
            rows = []
            for key, i in zip(batch.column("key").to_pylist(), batch.column("i").to_pylist()):
                for hit in found.find(key, i):
                    rows.append((key, *hit))
                    if len(rows) >= 10_000:
                        yield _lines_batch(rows)
                        rows = []
            yield _lines_batch(rows)

    pairs = stage(keys.distinct().mapInArrow(spread, "key string, i int"), "searches")
    n = max(1, -(-pairs.count() // SEARCHES))
    dealt = pairs.repartitionByRange(n, "i", "key").sortWithinPartitions("i", "key")
    return stage(dealt.mapInArrow(search, LINES), "captures")


RECORDS = "page_id long, payload string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    opened: tuple[str, object] = ("", None)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

    for batch in batches:
        spots = list(zip(*[batch.column(c).to_pylist() for c in ("file", "at", "size")]))
        i, rows, held = 0, [], 0
        while i < len(spots):
            file, at, size = spots[i]
            j, end = i + 1, at + size
            while j < len(spots) and spots[j][0] == file and 0 <= spots[j][1] - end <= GAP and spots[j][1] - at < 4 << 20:
                end = spots[j][1] + spots[j][2]
                j += 1
            if opened[0] != file:
                fs, where = _fs(file)
                opened = file, fs.open_input_file(where)
            raw = opened[1].read_at(end - at, at)
            for _, a, n in spots[i:j]:
                row = parse(raw[a - at:a - at + n])
                row["payload"] = row["payload"].decode("utf-8", "replace") if row["payload"] is not None else None
                held += len(row["payload"] or "")
                rows.append(row)
                if held > 4_000_000 or len(rows) >= 5000:
                    yield batch_of(rows)
                    rows, held = [], 0
            i = j
        yield batch_of(rows)


def read_records(captures: DataFrame) -> DataFrame:
    """The records at ``captures`` (file, at, size), by range reads in the order of each archive.

    As many tasks as the records' own bytes ask for (``READ_BYTES`` a task), not the pointers' few.
    """
    ship(captures.sparkSession)
    total = captures.agg(F.sum("size")).first()[0] or 0
    where = captures.select("file", "at", "size").repartitionByRange(max(1, -(-total // READ_BYTES)), "file", "at")
    where = where.sortWithinPartitions("file", "at")
    return where.mapInArrow(_read_records, RECORDS)


def url_keys(pages: DataFrame) -> DataFrame:
    """The search key of every url of ``pages``."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([surt(u) for u in batch.column(0).to_pylist()], pa.string())], ["key"])

    return pages.select("url").mapInArrow(run, "key string")


def fetch(spark: SparkSession, urls: list[str], index: DataFrame) -> DataFrame:
    """The records of some urls."""
    keys = spark.createDataFrame([(surt(u),) for u in urls], "key string")
    return read_records(lookup(keys, index))
