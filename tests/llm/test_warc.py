import base64
import hashlib
import io
import random
import struct

import pytest
import zstandard
from pyspark.errors import PythonException

from foliorank.llm import warc

SCHEMA = "page_id long, url string, html string"


def corpus():
    rng = random.Random(3)
    bodies = ["", None, "<p>é</p>", "x" * 300_000] + [f"<html>{rng.random()} body text {i % 9}</html>" for i in range(60)]
    rows = [(i, f"http://a.example/{i}?q=ü\r\nX: y", rng.choice(bodies)) for i in range(300)]
    return rows + [(None, None, "<p>é</p>"), (None, "u", "only without an id"), (7, "again", rows[7][2])]


@pytest.mark.parametrize("min_bytes", [0, 10])
def test_round_trip(spark, tmp_path, min_bytes):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", refers_to int").repartition(3)
    manifest = warc.write_warc(df, f"file://{tmp_path}/w", min_bytes, archive_bytes=20_000)
    assert manifest.count() > 3 and manifest.agg({"records": "sum"}).first()[0] == len(rows)
    found = sorted((tuple(r) for r in warc.read_warc(manifest).collect()), key=str)
    keeper = {}
    for i, _, html in rows:
        keeper[html or ""] = max(keeper.get(html or "", -1), -1 if i is None else i)
    expected = []
    for i, url, html in rows:
        body = (html or "").encode()
        last = keeper[html or ""]
        refers = last if len(body) >= min_bytes and last >= 0 and i != last else None
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        url = url and url.replace("ü", "%C3%BC").replace("\r", "%0D").replace("\n", "%0A").replace(" ", "%20")
        kind = "response" if refers is None else "revisit"
        expected.append((i, url, kind, refers, len(body), digest, body if refers is None else None))
    assert [(*r[:6], bytes(r[6]) if r[6] is not None else None) for r in found] == sorted(expected, key=str)


def test_nothing(spark, tmp_path):
    manifest = warc.write_warc(spark.createDataFrame([], SCHEMA), f"{tmp_path}/w")
    assert manifest.collect() == [] and warc.read_warc(manifest).collect() == []


def test_dictionary_stands_in_front(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"<html><body>shared words {i}</body></html>" * 5) for i in range(100)], SCHEMA)
    path = warc.write_warc(df.coalesce(1), str(tmp_path / "w")).first().path
    raw = open(path, "rb").read()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D
    words = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
    first = zstandard.ZstdDecompressor(dict_data=words).decompressobj().decompress(raw[8 + size :])
    assert first.startswith(b"WARC/1.1\r\n") and len(list(warc.read_archive(io.BytesIO(raw)))) == 100


def test_a_compressed_dictionary_is_read():
    samples = [f"record number {i} with common words".encode() * 4 for i in range(200)]
    words = zstandard.train_dictionary(2048, samples)
    packed = zstandard.ZstdCompressor().compress(words.as_bytes())
    writer = zstandard.ZstdCompressor(dict_data=words)
    raw = struct.pack("<II", 0x184D2A5D, len(packed)) + packed + b"".join(map(writer.compress, samples))
    assert list(warc.read_archive(io.BytesIO(raw))) == samples
    with pytest.raises(ValueError, match="cut off"):
        list(warc.read_archive(io.BytesIO(raw[:-3])))


@pytest.mark.parametrize(
    "old,new",
    [(b"WARC/1.1", b"WARC/9.9"), (b"Content-Length: ", b"Content-Length: 9"), (b"WARC-Date", b"Date"), (b"body", b"bodx"), (b": response", b" response")],
)
def test_broken_records_are_refused(old, new):
    record = warc.build_record(1, "http://a", b"body", None, "1970-01-01T00:00:00Z")
    assert warc.parse_record(record)["payload"] == b"body"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(old, new, 1))


def test_a_broken_archive_fails_the_job(spark, tmp_path):
    (tmp_path / "x.warc.zst").write_bytes(zstandard.compress(b"no record"))
    names = spark.createDataFrame([(str(tmp_path / "x.warc.zst"),)], "path string")
    with pytest.raises(PythonException, match="no WARC header"):
        warc.read_warc(names).collect()


def test_each_archive_has_a_task(spark, tmp_path):
    rows = [(i, "u", "x" * 3000 + str(i)) for i in range(64)]
    manifest = warc.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(8), f"file://{tmp_path}/w")
    assert manifest.count() == 8
    found = warc.read_warc(manifest)
    tasks = found.selectExpr("spark_partition_id() AS task").groupBy("task").count().collect()
    assert sum(t["count"] for t in tasks) == 64 and len(tasks) >= 6
