"""WARC archives in Zstandard: one frame a record, the dictionary in a leading skippable frame.

Writing: pages with equal payloads are found by a pre-aggregated grouping of digests,
so only narrow rows meet; each task then writes its records to archives of its own
in the shared folder and returns their names. A task that runs again writes new
files, and only names that arrive in the manifest count. Reading: each task streams
its archives frame by frame, so memory holds one record, and checks every header and
length.
"""

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliorank.storage import new_table_path, write_once

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:page:{}>"

ARCHIVE_BYTES = 64 << 20
MAX_READERS = 1 << 16
SAMPLES = 256  # records of a task from which its dictionary is trained
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 16 << 10
CHUNK = 1 << 16


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """A response record, or a revisit of page ``refers_to`` without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", RECORD_ID.format("null" if page_id is None else page_id)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))))))
    if refers_to is not None:
        fields += [("WARC-Refers-To", RECORD_ID.format(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Fields of one record; ValueError if a header, length or digest is wrong."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError("no WARC header")
    fields = _fields(lines[1:])
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["content-length"].isdigit():
        raise ValueError("Content-Length is not a number")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"block of {max(0, len(rest) - 4)} bytes, {length} announced")
    block = rest[:length]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{payload_digest(block)}":
        raise ValueError("block digest differs")
    kind = fields["warc-type"]
    result = {"record_type": kind, "fields": fields, "payload": None, "payload_bytes": None}
    if fields.get("content-type", "").startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        inner = _fields(http.split(b"\r\n")[1:])
        announced = int(inner.get("content-length", len(payload)))
        if not gap or (kind != "revisit" and announced != len(payload)):
            raise ValueError(f"payload of {len(payload)} bytes, {announced} announced")
        result["payload_bytes"] = announced
        if kind != "revisit":
            result["payload"] = payload
            if fields.get("warc-payload-digest", "") not in ("", f"sha1:{payload_digest(payload)}"):
                raise ValueError("payload digest differs")
    if kind == "revisit" and "warc-refers-to" not in fields:
        raise ValueError("a revisit without WARC-Refers-To")
    return result


def _fields(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name.strip():
            raise ValueError("a header line without a name")
        found[name.strip().lower()] = value.strip()
    return found


def page_number(record_id: str | None) -> int | None:
    if record_id is None:
        return None
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "null" else int(number)


def train_dictionary(samples: list[bytes]) -> bytes | None:
    """A dictionary from sample records; None where they are too few or too alike to train one."""
    import zstandard

    if len(samples) < 8:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return None


def read_archive(stream) -> Iterator[bytes]:
    """Decoded frames of one archive, one at a time."""
    import zstandard

    held = stream.read(8)
    dictionary = None
    if len(held) == 8 and struct.unpack("<I", held[:4])[0] == DICTIONARY_FRAME:
        size = struct.unpack("<I", held[4:])[0]
        content = stream.read(size)
        if len(content) != size:
            raise ValueError("the dictionary frame is cut off")
        if content[:4] == ZSTD_MAGIC:
            content = zstandard.ZstdDecompressor().decompress(content, max_output_size=1 << 28)
        dictionary = zstandard.ZstdCompressionDict(content)
        held = b""
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        held = held or stream.read(CHUNK)
        if not held:
            return
        frame, parts = reader.decompressobj(), []
        while True:
            parts.append(frame.decompress(held))
            held = frame.unused_data
            if frame.eof:
                break
            held = stream.read(CHUNK)
            if not held:
                raise ValueError("the last frame is cut off")
        yield b"".join(parts)


def _open_folder(folder: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    return system, path.rstrip("/")


class _Writer:
    """Archives of one task: a new one when the current one is full."""

    def __init__(self, folder: str, archive_bytes: int):
        self.folder, self.archive_bytes = folder, archive_bytes
        self.system, self.path = _open_folder(folder)
        self.system.create_dir(self.path, recursive=True)
        self.samples: list[bytes] | None = []
        self.sampled = 0
        self.stream = None
        self.finished: list[tuple[str, int]] = []

    def add(self, record: bytes) -> None:
        if self.samples is not None:
            self.samples.append(record)
            self.sampled += len(record)
            if len(self.samples) >= SAMPLES or self.sampled >= SAMPLE_BYTES:
                self._train()
            return
        self._write(record)

    def _train(self) -> None:
        import zstandard

        waiting, self.samples = self.samples, None
        self.dictionary = train_dictionary(waiting)
        data = zstandard.ZstdCompressionDict(self.dictionary) if self.dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=data)
        for record in waiting:
            self._write(record)

    def _write(self, record: bytes) -> None:
        if self.stream is None:
            self.name, self.records = f"{uuid.uuid4().hex}.warc.zst", 0
            self.stream = self.system.open_output_stream(f"{self.path}/{self.name}", compression=None)
            if self.dictionary:
                self.stream.write(struct.pack("<II", DICTIONARY_FRAME, len(self.dictionary)) + self.dictionary)
        self.stream.write(self.compressor.compress(record))
        self.records += 1
        if self.stream.tell() >= self.archive_bytes:
            self._close()

    def _close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.finished.append((f"{self.folder}/{self.name}", self.records))
            self.stream = None

    def close(self) -> list[tuple[str, int]]:
        if self.samples:
            self._train()
        self._close()
        return self.finished


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages (page_id, url, html) with ``refers_to``: the page whose record holds the same payload.

    Of equal payloads of at least ``min_bytes`` bytes the largest page_id keeps the
    payload. Ids that repeat are equal in this; a null id is smaller than any other.
    """
    own = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"], pages["html"])
    body = F.coalesce("html", F.lit("")).cast("binary")
    keyed = own.withColumn("_digest", F.sha1(body)).withColumn("_size", F.octet_length(body))
    equal = write_once(
        keyed.where(F.col("_size") >= min_bytes)
        .groupBy("_digest", "_size")
        .agg(F.max("page_id").alias("_keeper"), F.count("*").alias("_n"))
        .where("_n > 1 AND _keeper IS NOT NULL")
        .drop("_n"),
        "payload_groups",
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_keeper")), F.col("_keeper"))
    return keyed.join(equal, ["_digest", "_size"], "left").select("page_id", "url", "html", refers.alias("refers_to"))


def write_warc(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per page row; returns the manifest (path, records).

    The payload is the html in UTF-8, null as empty; a null url leaves out the target.
    No pages give no archive. Other columns are not looked at.
    """

    def run(batches):
        writer = _Writer(folder, archive_bytes)
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, html, refers_to = (column[i].as_py() for column in batch.columns)
                writer.add(build_record(page_id, url, (html or "").encode(), refers_to, date))
        done = writer.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
            ["path", "records"],
        )

    return write_once(plan_records(pages, min_bytes).mapInArrow(run, "path string, records long"), "manifest")


def read_warc(archives: DataFrame, payload: bool = True) -> DataFrame:
    """Records of the archives named by ``path``: one row a record.

    page_id, url, record_type, refers_to, payload_bytes, payload_digest and, if asked
    for, payload (null in revisits). A broken header, length, digest or frame fails
    the job with the archive's name. An archive without records gives no rows. Archives
    are dealt one to a task, up to ``MAX_READERS`` tasks; records of any length are held one at a time.
    """
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    if payload:
        names, kinds, schema = [*names, "payload"], [*kinds, pa.binary()], schema + ", payload binary"

    def flush(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = _open_folder(uri)
                rows, size = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for number, frame in enumerate(read_archive(stream)):
                        try:
                            found = parse_record(frame)
                        except ValueError as error:
                            raise ValueError(f"{uri}, record {number}: {error}") from error
                        fields = found["fields"]
                        row = (
                            page_number(fields["warc-record-id"]),
                            fields.get("warc-target-uri"),
                            found["record_type"],
                            page_number(fields.get("warc-refers-to")),
                            found["payload_bytes"],
                            fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                        )
                        rows.append((*row, found["payload"]) if payload else row)
                        size += len(frame) if payload else 100
                        if size >= 4 << 20:
                            yield flush(rows)
                            rows, size = [], 0
                if rows:
                    yield flush(rows)

    # An explicit number: rows are few and small, so Spark would put all archives into one task.
    readers = min(MAX_READERS, max(1, archives.count()))
    return archives.select("path").repartitionByRange(readers, "path").mapInArrow(run, schema)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read those back: a row per page row.

    Null html is an empty payload and a null url has no target; rows that repeat are records
    of their own, and the largest page_id of equal payloads is the response. Payloads
    of any length are one frame each. An empty table writes no archive and gives no rows.
    """
    manifest = write_warc(pages, new_table_path(spark, "warc"), min_bytes)
    return read_warc(manifest, payload=False)


WARC_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper
  FROM pages
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform(range(0, 4), lambda c:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(hex, CAST(g * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * c AS INT)) & 31 AS INT), 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p
"""
