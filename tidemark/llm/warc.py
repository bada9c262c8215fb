"""WARC archives under Zstandard: one frame per record, with the dictionary in a leading skippable frame.

Writing is one pass over the pages behind a join that finds revisits: records with a payload that a smaller id already
has refer to that one and carry no payload. Tasks write their archives through the file system of the folder's URI, under
a name of their own attempt first, and move them in place when complete, so a lost executor leaves no broken archive.

Reading loads the dictionary of each archive from its leading frame, decodes a frame per record, and checks headers,
lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import with_hash

DICTIONARY_FRAME = (0x184D2A5D).to_bytes(4, "little")
ZSTD_FRAME = (0xFD2FB528).to_bytes(4, "little")
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
#: Bytes of compressed input that a frame's decoder takes at a time.
STEP = 16 << 10
LAST = (1 << 63) - 1  # stands for a null id: after every other
MANIFEST = "archive string, records long, archive_bytes long"
RECORDS = (
    "archive string, place long, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary, problem string"
)
RECORD_NAMES = [field.split()[0] for field in RECORDS.split(", ")]
RECORD_TYPES = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary(), pa.string()]


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str):
    """The page id in a column of record names; null for the name of a null id."""
    return F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def clean(value: str) -> str:
    """A header value holds no line breaks."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, first_id: int | None, date: str) -> bytes:
    """The bytes of a response, or of a revisit that refers to the response of ``first_id``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = first_id is not None
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_name(page_id)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", clean(url)))
    if revisit:
        headers += [("WARC-Refers-To", record_name(first_id)), ("WARC-Profile", REVISIT_PROFILE)]
    headers += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def header_fields(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.decode().partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"malformed header line {name!r}")
        if name in fields:
            raise ValueError(f"header {name} twice")
        fields[name] = value.strip()
    return fields


def parsed(data: bytes) -> dict:
    """A record's fields; a ValueError says what is wrong with it."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, head = head.partition(b"\r\n")
    if version != VERSION or not gap:
        raise ValueError(f"no {VERSION.decode()} record")
    fields = header_fields(head)
    if lacking := [name for name in REQUIRED if not fields.get(name)]:
        raise ValueError(f"without {', '.join(lacking)}")
    if not fields["Content-Length"].isdecimal() or len(rest) != int(fields["Content-Length"]) + 4:
        raise ValueError(f"Content-Length {fields['Content-Length']} with {len(rest) - 4} bytes")
    if not rest.endswith(b"\r\n\r\n"):
        raise ValueError("no empty lines behind the block")
    block = rest[:-4]
    if fields.get("WARC-Block-Digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise ValueError("block digest differs")
    kind = fields["WARC-Type"]
    out = {"record_type": kind, "record_id": fields["WARC-Record-ID"], "target_uri": fields.get("WARC-Target-URI"), "refers_to": fields.get("WARC-Refers-To")}
    if kind not in ("response", "revisit"):
        return out | {"payload_bytes": len(block), "payload_digest": digest(block), "payload": block}
    status, gap, payload = block.partition(b"\r\n\r\n")
    status, _, http = status.partition(b"\r\n")
    if not status.startswith(b"HTTP/") or not gap:
        raise ValueError("no HTTP head")
    size = {k.lower(): v for k, v in header_fields(http).items()}.get("content-length", "")
    stated = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    if not size.isdecimal() or not stated:
        raise ValueError("without HTTP Content-Length or payload digest")
    if kind == "revisit":
        if payload or not out["refers_to"]:
            raise ValueError("revisit with a payload or without WARC-Refers-To")
    elif len(payload) != int(size) or digest(payload) != stated:
        raise ValueError(f"HTTP Content-Length {size} or payload digest differs from {len(payload)} bytes")
    return out | {"payload_bytes": int(size), "payload_digest": stated, "payload": None if kind == "revisit" else payload}


def dictionary_of(archive: memoryview) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary in the leading skippable frame, itself compressed or not, and where records begin."""
    if archive[:4] != DICTIONARY_FRAME:
        return None, 0
    size = int.from_bytes(archive[4:8], "little")
    data = bytes(archive[8 : 8 + size])
    if len(data) != size:
        raise ValueError("dictionary frame is cut short")
    if data[:4] == ZSTD_FRAME:
        data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    return zstandard.ZstdCompressionDict(data), 8 + size


def frames(archive: bytes) -> Iterator[tuple[int, bytes]]:
    """Place and content of every frame of an archive. A frame is decoded to its end before the next one begins."""
    view = memoryview(archive)
    dictionary, at = dictionary_of(view)
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(view):
        start, frame, out = at, decoder.decompressobj(), []
        while not frame.eof:
            if at >= len(view):
                raise ValueError(f"frame at {start} is cut short")
            out.append(frame.decompress(view[at : at + STEP]))
            at = min(len(view), at + STEP)
        at -= len(frame.unused_data)
        yield start, b"".join(out)


class Archive:
    """An archive in the making: its first frame holds the dictionary, every record is a frame of its own."""

    def __init__(self, folder: str, name: str, dictionary: bytes | None, level: int):
        from pyarrow import fs

        self.files, root = fs.FileSystem.from_uri(folder)
        self.place, self.draft, self.name = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}", name
        self.out, self.records, self.size = self.files.open_output_stream(self.draft), 0, 0
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.encoder = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
        if dictionary:
            packed = zstandard.ZstdCompressor(level=level).compress(dictionary)
            self._write(DICTIONARY_FRAME + len(packed).to_bytes(4, "little") + packed)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        self._write(self.encoder.compress(data))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        try:
            self.files.move(self.draft, self.place)
        except OSError:  # some stores do not replace: another attempt has put the same archive there
            if not self.files.get_file_info(self.place).is_file:
                raise
            self.files.delete_file(self.draft)
        return self.name, self.records, self.size


def trained_dictionary(rows: DataFrame, sample_pages: int, dictionary_bytes: int) -> bytes | None:
    """A dictionary of a bounded sample of pages, drawn by hash among pages up to 64 KiB. Too few pages: none.

    About twice as many pages as wanted pass the hash filter over all tasks, so what reaches the driver does not grow. The
    dictionary changes sizes only; what is read back is the same with any.
    """
    place = F.xxhash64("page_id", "payload")
    thin = max(1, rows.count() // (2 * sample_pages))
    small = rows.where(F.octet_length("payload").between(1, 64 << 10) & (F.pmod(place, F.lit(thin)) == 0))
    rows = small.select(F.col("payload").alias("p")).orderBy(place).limit(sample_pages)
    samples = [record(0, "http://", bytes(r.p), None, "2000-01-01T00:00:00Z") for r in rows.collect()]
    try:
        return zstandard.train_dictionary(dictionary_bytes, samples).as_bytes() if len(samples) >= 8 else None
    except zstandard.ZstdError:
        return None


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    date: str = "2000-01-01T00:00:00Z",
    min_revisit_bytes: int = 0,
    archive_bytes: int = 16 << 20,
    sample_pages: int = 400,
    dictionary_bytes: int = 64 << 10,
    level: int = 3,
) -> DataFrame:
    """Write a record per page below ``folder`` and return the manifest: archive, records, archive_bytes.

    Of records with equal payloads of ``min_revisit_bytes`` or more the one with the smallest id is a response, others
    are revisits of it; smaller payloads are all responses. Null payload: empty. Null id: after all others, named none.
    Rows that repeat an id and payload are alike, all responses if that id is the smallest. Null url: no target header.
    An empty table gives no archive. ``folder`` must be a place that all executors write to; an archive closes once it
    has ``archive_bytes``, so one is never much larger than that and its longest record.
    """
    payload = F.coalesce(F.col(payload_column), F.lit(""))
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("place"),
        F.col(url_column).cast("string").alias("url"),
        F.encode(payload, "UTF-8").alias("payload"),
        F.concat_ws(":", F.sha1(F.encode(payload, "UTF-8")), F.octet_length(payload)).alias("content"),
    )
    large = rows.where(F.octet_length("payload") >= min_revisit_bytes).select("page_id", "place", "content")
    first = large.groupBy("content", with_hash("content")).agg(F.min("page_id").alias("first_id"), F.min("place").alias("least"), F.max("place").alias("most"))
    first = first.where("least < most").select("content", "first_id", "least")
    later = large.join(first, "content").where("place > least")
    later = later.groupBy("place", "content").agg(F.first("first_id").alias("first_id"))
    dealt = rows.join(later, ["place", "content"], "left").select("page_id", "place", "url", "payload", "content", "first_id")
    dealt = dealt.sortWithinPartitions("place", "content").select("page_id", "url", "payload", "first_id")
    dictionary = trained_dictionary(rows, sample_pages, dictionary_bytes)
    _make(folder)

    def run(batches):
        part, count, archive = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            done = []
            for page_id, url, data, first_id in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if archive is None:
                    archive = Archive(folder, f"part-{part:05d}-{count:05d}.warc.zst", dictionary, level)
                    count += 1
                archive.add(record(page_id, url, data, first_id, date))
                if archive.size >= archive_bytes:
                    done.append(archive.close())
                    archive = None
            yield _manifest(done)
        if archive is not None:
            yield _manifest([archive.close()])

    written = dealt.mapInArrow(run, MANIFEST)
    written.write.mode("errorifexists").parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


def _make(folder: str) -> None:
    from pyarrow import fs

    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root)


def _manifest(done: list[tuple[str, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*done, strict=True)) or [[], [], []]
    kinds = [pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["archive", "records", "archive_bytes"])


def read_archives(spark: SparkSession, folder: str, strict: bool = True) -> DataFrame:
    """A row per record below ``folder``: archive, place (byte of its frame), record_type, record_id, target_uri,
    refers_to, payload_bytes, payload_digest (of the full payload), payload (null for a revisit) and problem.

    A record that fails a check stops the job; with ``strict=False`` it becomes a row with its ``problem`` and nulls.
    """
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true")
    stored = stored.load(folder).select("path", "content")

    def rows_of(path: str, content: bytes):
        try:
            for place, data in frames(content):
                row = {"archive": path, "place": place, "problem": None}
                try:
                    row |= parsed(data)
                except (ValueError, UnicodeDecodeError) as wrong:
                    if strict:
                        raise ValueError(f"{path} at {place}: {wrong}") from wrong
                    row["problem"] = str(wrong)
                yield row
        except (ValueError, zstandard.ZstdError) as wrong:
            if strict:
                raise ValueError(f"{path}: {wrong}") from wrong
            yield {"archive": path, "problem": str(wrong)}

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        arrays = [pa.array([r.get(n) for r in rows], k) for n, k in zip(RECORD_NAMES, RECORD_TYPES, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, RECORD_NAMES)

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, size = [], 0
                for row in rows_of(path.as_py(), content.as_py()):
                    rows.append(row)
                    size += len(row.get("payload") or b"")
                    if size >= 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return stored.mapInArrow(run, RECORDS)
