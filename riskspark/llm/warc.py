"""WARC archives: written as one gzip stream per file, normalised, indexed and read back.

1. Records are written in files of one gzip stream over all records, as many crawlers'
   tools leave them. Of pages with equal payloads of at least ``REVISIT_FROM`` bytes, the
   one with the largest page_id is a response; the others revisit it without the payload.
2. The normaliser inflates such a file once from front to back, in bounded pieces, and
   rewrites every record as its own gzip member. A sidecar index (one JSON line per
   record) has the offset and length of each member, so that one record can be read alone.
3. The reader goes by the index, member by member, checks payloads against their digests,
   and returns a row per record.

The files lie in the shared folder; the tables between the steps hold their paths only.
Each attempt of a task that writes archives gives its files names of their own, as it may meet
its rows in another order and cut them elsewhere. Only the files of the attempt that Spark
commits are in the table returned; others in the folder count for nothing.

Cases: a null html is an empty payload and a null url an empty target. A null page_id has
no record id of its own and counts as smaller than any. Rows repeated with the same
page_id and payload are responses all, if the page_id is the group's largest, else
revisits all. An empty table gives no files and no rows. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import delete, filesystem, materialise, new_folder, uri, write_once

REVISIT_FROM = 1000
#: Bytes of payload per archive, about; a file ends after the record that reaches it.
FILE_BYTES = 32 << 20
DATE = "2026-01-01T00:00:00Z"
_PIECE = 1 << 20
_CRLF = b"\r\n"


def classify(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """The pages with payload, digest and refers_to (null for a response).

    Equal payloads meet as digests only; a group of copies is one row per task before the
    shuffle. The groups found are joined back; adaptive execution splits a large one.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    own = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = own.where(F.length("payload") >= least)
    first = large.groupBy("digest").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    marked = own.join(first.select(F.col("digest").alias("of"), "largest"), (F.col("digest") == F.col("of")) & (F.length("payload") >= least), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return marked.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _id(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"" if page_id is None else str(page_id).encode())


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response or revisit record, headers and block."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    kind = b"response" if refers_to is None else b"revisit"
    head = [b"WARC/1.1", b"WARC-Type: " + kind, b"WARC-Record-ID: " + _id(page_id)]
    # line breaks would end a header early
    head += [b"WARC-Target-URI: " + (url or "").encode().replace(b"\r", b"%0D").replace(b"\n", b"%0A"), b"WARC-Date: " + DATE.encode()]
    head += [b"WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest))]
    if refers_to is None:
        block += payload
    else:
        head += [b"WARC-Refers-To: " + _id(refers_to), b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return _CRLF.join(head) + 2 * _CRLF + block + 2 * _CRLF


def _gzip(level: int):
    return zlib.compressobj(level, zlib.DEFLATED, 31)


def _file_task(work: Callable[[dict], dict]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from work(row)

    return run


def write(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write archives of one gzip stream each; returns their paths and record counts."""
    folder = uri(pages.sparkSession, folder)
    rows = classify(pages).select(F.spark_partition_id().alias("part"), "*")
    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = filesystem(folder)
        files.create_dir(at, recursive=True)
        stream, out, held, records, number, part = _gzip(1), [], 0, 0, 0, 0
        attempt = uuid.uuid4().hex

        def close() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:04d}-{attempt}.warc.gz"
            write_once(files, f"{at}/{name}", b"".join([*out, stream.flush()]))
            return pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "records": records}], schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                part = row.pop("part")
                data = record(**row)
                out.append(stream.compress(data))
                held, records = held + len(data), records + 1
                if held >= file_bytes:
                    yield close()
                    stream, out, held, records, number = _gzip(1), [], 0, 0, number + 1
        if records:
            yield close()

    return materialise(rows.mapInArrow(run, "path string, records long"), "archives")


def _inflated(f) -> Iterator[bytes]:
    """A gzip file's content in pieces, whether of one member or of many."""
    engine, data = zlib.decompressobj(31), f.read(_PIECE)
    while data:
        piece = engine.decompress(data, _PIECE)
        if piece:
            yield piece
        if engine.eof:
            data = engine.unused_data or f.read(_PIECE)
            engine = zlib.decompressobj(31)
        else:
            data = engine.unconsumed_tail or f.read(_PIECE)
    rest = engine.flush()
    if rest:
        yield rest


def records(f) -> Iterator[bytes]:
    """The records of an open archive, each with its headers and closing blank lines."""
    buffer, pieces, ended = bytearray(), _inflated(f), False

    def more(n: int) -> bool:
        nonlocal ended
        while len(buffer) < n and not ended:
            piece = next(pieces, None)
            ended = piece is None
            buffer.extend(piece or b"")
        return len(buffer) >= n

    while True:
        looked = 0
        while (end := buffer.find(b"\r\n\r\n", max(0, looked - 3))) < 0:
            looked = len(buffer)
            if not more(looked + 1):
                if buffer.strip():
                    raise ValueError("the archive ends inside a record")
                return
        size = int(headers(bytes(buffer[: end + 4]))["content-length"])
        total = end + 4 + size + 4
        if not more(total):
            raise ValueError("the archive ends inside a record")
        yield bytes(buffer[:total])
        del buffer[:total]


def headers(data: bytes) -> dict[str, str]:
    """The named fields of a record, names in lower case."""
    lines = data.split(b"\r\n\r\n", 1)[0].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record where one should begin")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives with a gzip member per record, and an index beside each; returns both paths."""
    folder = uri(archives.sparkSession, folder)
    schema = pa.schema([("path", pa.string()), ("index_path", pa.string()), ("records", pa.int64())])

    def work(row: dict) -> Iterator[pa.RecordBatch]:
        files, at = filesystem(folder)
        files.create_dir(at, recursive=True)
        name = row["path"].rsplit("/", 1)[1].removesuffix(".warc.gz")
        source, path = filesystem(row["path"])
        members, index, offset = [], [], 0
        with source.open_input_stream(path, compression=None) as f:
            for data in records(f):
                engine = _gzip(6)
                member = engine.compress(data) + engine.flush()
                field = headers(data)
                index.append(json.dumps({"offset": offset, "length": len(member), "id": field["warc-record-id"], "type": field["warc-type"], "uri": field["warc-target-uri"], "digest": field["warc-payload-digest"]}))
                members.append(member)
                offset += len(member)
        write_once(files, f"{at}/{name}.members.warc.gz", b"".join(members))
        write_once(files, f"{at}/{name}.index.jsonl", "\n".join(index).encode())
        row = {"path": f"{folder}/{name}.members.warc.gz", "index_path": f"{folder}/{name}.index.jsonl", "records": len(index)}
        yield pa.RecordBatch.from_pylist([row], schema=schema)

    spread = archives.repartitionByRange(max(1, archives.count()), "path")
    return materialise(spread.mapInArrow(_file_task(work), "path string, index_path string, records long"), "normalised")


def _page(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse(data: bytes) -> dict:
    """What a record says: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    field = headers(data)
    block = data.split(b"\r\n\r\n", 1)[1][: int(field["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(line[15:]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    digest = base64.b32decode(field["warc-payload-digest"].removeprefix("sha1:")).hex()
    response = field["warc-type"] == "response"
    if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {field['warc-record-id']} is damaged")
    return {
        "page_id": _page(field["warc-record-id"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": field["warc-type"],
        "refers_to": None if response else _page(field["warc-refers-to"]),
        "url": field["warc-target-uri"],
    }


def read(normalised: DataFrame) -> DataFrame:
    """A row per record, read member by member at the offsets of the index."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])

    def work(row: dict) -> Iterator[pa.RecordBatch]:
        files, at = filesystem(row["index_path"])
        with files.open_input_stream(at, compression=None) as f:
            index = [json.loads(line) for line in f.read().decode().split("\n") if line]
        files, at = filesystem(row["path"])
        with files.open_input_file(at) as f:
            for low in range(0, len(index), 500):
                found = []
                for x in index[low : low + 500]:
                    f.seek(x["offset"])
                    found.append(parse(zlib.decompress(f.read(x["length"]), 31)))
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    spread = normalised.repartitionByRange(max(1, normalised.count()), "path")
    return spread.mapInArrow(
        _file_task(work), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back; the single-stream files go once they are rewritten."""
    spark = pages.sparkSession
    raw, own = new_folder(spark, "warc-raw"), new_folder(spark, "warc")
    done = normalise(write(pages, raw), own)
    delete(spark, raw)
    return read(done)
