"""Web archives packed as ZIP files: write deduplicated WARC records, read them back by ranges.

An archive is a ZIP of stored (uncompressed) members: WARC files below ``archive/`` (the writer makes
one, ``archive/data.warc.gz``, a gzip member per record) and CDXJ indexes below ``indexes/`` (plain or
gzipped) that name file, offset and length of every record. The reader fetches the tail of the file,
follows the end record (or the ZIP64 end record) to the central directory, takes the members' places
from it, and then reads single ranges only.
"""
from __future__ import annotations

import base64
import hashlib
import io
import itertools
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import table
from cardwatch.session import saved, scratch_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Payload bytes after which a task begins its next archive.
ARCHIVE_BYTES = 32 << 20
LEAST_BYTES = 1000
#: Archive bytes a reading task gets, in blocks; the most tasks (they stream, so more bytes only take longer).
READ_BYTES, BLOCK_BYTES, MOST_TASKS = 8 << 20, 4 << 20, 32_768

MANIFEST = "archive string, n_records long"
RECORD = ("page_id long, record_type string, refers_to long, payload_digest string, "
          "payload binary, warc_offset long, warc_length long, record_id string, target_uri string")


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a URI and the path in it; a bare path is a folder all executors mount."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC 1.1 record as a gzip member; a revisit keeps its headers only."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {' '.join(url.split())}", "WARC-Date: 1970-01-01T00:00:00Z",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: text/html", f"Content-Length: {len(body)}", "", ""]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + body + b"\r\n\r\n") + packer.flush()


def index_line(url: str, digest: str, revisit: bool, offset: int, length: int) -> str:
    """CDXJ line: host labels from the right, path, time, and the place of the record."""
    try:
        parts = urlsplit(" ".join(url.split()).lower())
        key = f"{','.join(reversed((parts.hostname or '').split('.')))}){parts.path}{'?' + parts.query if parts.query else ''}"
    except ValueError:  # no URL
        key = ")"
    place = {"url": url, "digest": f"sha1:{digest}", "mime": "warc/revisit" if revisit else "text/html",
             "offset": offset, "length": length, "filename": DATA.rpartition("/")[2]}
    return f"{'%20'.join(key.split())} 19700101000000 {json.dumps(place)}"


class ArchiveWriter:
    """Collects records in memory up to ARCHIVE_BYTES and writes them as one ZIP file."""

    def __init__(self, folder: str):
        self.store, self.folder = filesystem(folder)
        self.store.create_dir(self.folder, recursive=True)
        self.scheme = folder[: len(folder) - len(self.folder)]
        self._begin()

    def _begin(self):
        self.data, self.lines, self.raw = io.BytesIO(), [], 0

    def add(self, page_id, url, payload, digest, refers_to):
        member = record(page_id, url, payload, digest, refers_to)
        self.lines.append(index_line(url, digest, refers_to is not None, self.data.tell(), len(member)))
        self.data.write(member)
        self.raw += len(payload)

    def finish(self) -> tuple[str, int]:
        """Write under a name of this attempt alone; a repeated task leaves an unlisted file."""
        name, n = f"{self.folder}/{uuid.uuid4().hex}.wacz", len(self.lines)
        with self.store.open_output_stream(name) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as z:
            z.writestr(INDEX, "".join(f"{line}\n" for line in sorted(self.lines)))
            with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as member:
                member.write(self.data.getbuffer())
        self._begin()
        return self.scheme + name, n


def revisits(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to of every row.

    Among equal payloads (SHA-1 and length) of at least ``least`` bytes the row with the largest
    page_id is the response; rows that share that page_id are all responses. Null html is an empty
    payload; a null page_id never is the largest unless all are null, which gives responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "_n": F.octet_length("payload")})
    last = (rows.filter(F.col("_n") >= least).groupBy("digest", "_n")
            .agg(F.max("page_id").alias("_last"), F.count("*").alias("_rows")).filter("_rows > 1"))
    return (rows.join(last, ["digest", "_n"], "left")
            .select("page_id", "url", "payload", "digest",
                    F.when(~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last")).alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every row as a WARC record into ZIP archives below a shared folder; the manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, writer = [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                writer = writer or ArchiveWriter(folder)
                writer.add(*row)
                if writer.raw >= archive_bytes:
                    done.append(writer.finish())
        if writer and writer.lines:
            done.append(writer.finish())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()),
                                          pa.array([d[1] for d in done], pa.int64())], ["archive", "n_records"])

    return saved(revisits(pages, least).mapInArrow(write, MANIFEST), "manifest")


# Reading -----------------------------------------------------------------------------------------

def _end_record(source, size: int) -> tuple[int, int]:
    """Offset and size of the central directory, from the end record or its ZIP64 form."""
    tail_at = max(0, size - (1 << 16) - 22)
    source.seek(tail_at)
    tail = source.read(size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no ZIP end record")
    length, offset = struct.unpack_from("<II", tail, at + 12)
    if (length == 0xFFFFFFFF or offset == 0xFFFFFFFF or struct.unpack_from("<H", tail, at + 10)[0] == 0xFFFF):
        source.seek(tail_at + at - 20)
        signature, _, end64, _ = struct.unpack("<4sIQI", source.read(20))
        if signature != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        source.seek(end64)
        end = source.read(56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        length, offset = struct.unpack_from("<QQ", end, 40)
    return offset, length


def members(source, size: int) -> dict[str, tuple[int, int]]:
    """Place of the bytes of every stored member: name -> (offset, length)."""
    offset, length = _end_record(source, size)
    source.seek(offset)
    directory, at, found = source.read(length), 0, {}
    while directory[at:at + 4] == b"PK\x01\x02":
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        header, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + n_name].decode()
        extra, x = directory[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while x + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, x)
            if tag == 1:  # 64-bit values of the fields that are full, in this order
                wide = list(struct.unpack_from(f"<{n // 8}Q", extra, x + 4))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                header = wide.pop(0) if header == 0xFFFFFFFF else header
            x += 4 + n
        if method == 0:
            source.seek(header)
            local = source.read(30)
            start = header + 30 + sum(struct.unpack_from("<HH", local, 26))
            found[name] = (start, packed)
        at += 46 + n_name + n_extra + n_comment
    return found


def _lines(source, at: int, size: int, packed: bool) -> Iterator[bytes]:
    """Lines of a range, read and unpacked in blocks; a gzipped one may have several gzip members."""
    rest, unpack = b"", zlib.decompressobj(31) if packed else None
    source.seek(at)
    while size > 0:
        block = source.read(min(size, 1 << 20))
        if not block:
            raise ValueError("index ends early")
        size -= len(block)
        while block:
            plain, more = block, b""
            if unpack:
                plain, more = unpack.decompress(block), unpack.unused_data
                if unpack.eof:
                    unpack = zlib.decompressobj(31)
            *full, rest = (rest + plain).split(b"\n")
            yield from full
            block = more
    if rest:
        yield rest


def places(source, size: int) -> Iterator[tuple[int, int]]:
    """Offset and length, in the archive, of every record its indexes list."""
    at = members(source, size)
    files = {name.rpartition("/")[2]: place for name, place in at.items() if name.startswith("archive/")}
    indexes = sorted(n for n in at if n.startswith("indexes/") and n.removesuffix(".gz").endswith((".cdx", ".cdxj")))
    if not indexes:
        raise ValueError("no index among the stored members")
    for name in indexes:
        for line in _lines(source, *at[name], name.endswith(".gz")):
            entry = json.loads(line[line.index(b"{"):]) if b"{" in line else {}
            if "offset" not in entry:  # header of an index
                continue
            own = entry.get("filename", "").rpartition("/")[2] or (next(iter(files)) if len(files) == 1 else None)
            if own not in files:
                raise ValueError(f"{name} lists a record of {own}, which is no stored member")
            yield files[own][0] + int(entry["offset"]), int(entry["length"])


def parse_record(member: bytes) -> dict:
    """Headers (lower-case names) and payload of one record, gzipped or plain.

    The payload of an HTTP message is what follows its head; ``encoded`` marks one under a transfer encoding.
    """
    plain = member if member.startswith(b"WARC/") else zlib.decompress(member, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    lines = head.decode(errors="replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    out["payload"], out["encoded"] = rest[: int(out["content-length"])], False
    if out.get("content-type", "").lower().startswith("application/http"):
        message, _, out["payload"] = out["payload"].partition(b"\r\n\r\n")
        out["encoded"] = b"\ntransfer-encoding:" in message.lower()
    return out


def _sha1(x: dict) -> tuple[str | None, bool]:
    """Hexadecimal SHA-1 of the payload, and whether the record itself states it."""
    kind, _, value = x.get("warc-payload-digest", "").partition(":")
    if kind.lower() == "sha1" and len(value) == 32:
        return base64.b32decode(value.upper()).hex(), True
    if kind.lower() == "sha1" and len(value) == 40:
        return value.lower(), True
    return (hashlib.sha1(x["payload"]).hexdigest() if x["warc-type"] != "revisit" else None), False


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if urn.startswith("<urn:page:") and number else None


def read_archives(manifest: DataFrame, read_bytes: int = READ_BYTES) -> DataFrame:
    """All indexed records of the archives a manifest lists (column archive), RECORD columns, by range reads.

    Two steps: a task per archive lists its indexes, then the records' ranges are dealt out anew by
    bytes, so a large archive is read by many tasks. page_id and refers_to are null for records whose
    ids are no page numbers; only responses whose stated SHA-1 differs from their payload's are refused.
    """

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                store, path = filesystem(uri)
                with store.open_input_file(path) as source:
                    listed = places(source, source.size())
                    while part := list(itertools.islice(listed, 10_000)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([uri] * len(part), pa.string()), pa.array([p[0] for p in part], pa.int64()),
                             pa.array([p[1] for p in part], pa.int64())], ["archive", "at", "length"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, name = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = []
                for uri, at, length in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns)):
                    if uri != name:
                        if opened:
                            opened.close()
                        store, path = filesystem(uri)
                        opened, name = store.open_input_file(path), uri
                    opened.seek(at)
                    x = parse_record(opened.read(length))
                    sha, stated = _sha1(x)
                    if stated and x["warc-type"] == "response" and not x["encoded"] and hashlib.sha1(x["payload"]).hexdigest() != sha:
                        raise ValueError(f"digest of a record in {uri} at {at} does not fit its payload")
                    rows.append((_page(x["warc-record-id"]), x["warc-type"], _page(x.get("warc-refers-to", "")), sha,
                                 x["payload"] if x["warc-type"] != "revisit" else None, at, length,
                                 x["warc-record-id"], x.get("warc-target-uri")))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                    [c.split()[0] for c in RECORD.split(", ")])
        if opened:
            opened.close()

    listed = saved(manifest.select("archive").mapInArrow(ranges, "archive string, at long, length long"), "ranges")
    total = listed.agg(F.sum("length")).first()[0] or 0
    # a stated number of partitions: their rows are tiny, and would be put together by size otherwise
    tasks = max(1, min(-(-total // read_bytes), MOST_TASKS))
    blocks = listed.repartition(tasks, "archive", F.floor(F.col("at") / BLOCK_BYTES)).sortWithinPartitions("archive", "at")
    return blocks.mapInArrow(fetch, RECORD)


def archived(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Write pages to archives in the shared folder and read them back.

    page_id, payload_bytes, payload_digest, record_type, refers_to per row, empty for an empty
    table. A revisit takes its payload's length from the response it refers to.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    rows = read_archives(write_archives(pages, folder, least)).select(
        "page_id", "record_type", "refers_to", "payload_digest", F.octet_length("payload").cast("long").alias("_n"))
    rows = saved(rows, "records")
    full = (rows.filter("record_type = 'response'").groupBy("payload_digest")
            .agg(F.max("_n").alias("_full")))
    seen = rows.filter("record_type = 'revisit'").join(full, "payload_digest", "left")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (rows.filter("record_type = 'response'").withColumnRenamed("_n", "payload_bytes").select(out)
            .unionByName(seen.withColumnRenamed("_full", "payload_bytes").select(out)))


def op7_warc_zip(spark, folder: str) -> DataFrame:
    return archived(table(spark, folder, "pages"))


SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
l AS (SELECT d, max(page_id) AS last FROM p GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN n >= 1000 AND page_id != last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id != last THEN last END AS refers_to
FROM p JOIN l ON p.d = l.d"""
