"""WARC archives of pages, index first.

``write`` stores a record per page in gzip members of rolling archives below a shared
folder, and an index row per record: file, offset, length, url and digest.  Of pages with
equal payloads of at least ``least_bytes`` the one with the smallest page_id is a response,
the others are revisits of it.  ``read`` takes index rows, sorts them by place, joins
neighbouring byte ranges into one read each and parses the records.

Null html: an empty payload.  Null page_id: always a response, and nothing refers to it.
Repeated rows: one is the response, the others revisit it, so refers_to is their own page_id; they
meet in one task, row after row.
Null url: the record has none.  Empty tables give an empty index.  Extra columns are not
stored.  A task that is run again writes new files; only the index of the successful run
is kept, so files of lost tasks are never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tickloom.llm.store import lean, staged, to_arrow
from tickloom.session import work_path

#: Payloads below this are never revisits.
LEAST_BYTES = 0
#: An archive is closed beyond this; a task gets about this much payload.
ARCHIVE_BYTES = 256 << 20
#: Ranges with at most so many bytes between them are one read, up to so many bytes.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
#: Bytes of archives that a task reads.
TASK_BYTES = 128 << 20
GZIP_LEVEL = 1
DATE = "1970-01-01T00:00:00Z"
#: Fixed value of the format.
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = StructType(
    [
        StructField("page_id", LongType()),
        StructField("url", StringType()),
        StructField("digest", StringType()),
        StructField("record_type", StringType()),
        StructField("file", StringType()),
        StructField("offset", LongType()),
        StructField("length", LongType()),
    ]
)
RECORD = StructType(
    [
        StructField("page_id", LongType()),
        StructField("url", StringType()),
        StructField("payload_bytes", LongType()),
        StructField("payload_digest", StringType()),
        StructField("record_type", StringType()),
        StructField("refers_to", LongType()),
        StructField("payload", StringType()),
    ]
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None, digest: str) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{digest}"


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, again: int) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_name(page_id, digest)}{f':{again}' if again else ''}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        fields += [("WARC-Refers-To", f"<{_name(refers_to, digest)}>"), ("WARC-Profile", IDENTICAL)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(record: bytes) -> dict:
    """A record's columns; its payload is held against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(line for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")).split(b":")[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not have the payload of its digest")
    number = lambda name: int(n) if (n := fields[name].split(":")[2]) else None
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("WARC-Refers-To") if kind == "revisit" else None,
        "payload": payload.decode() if kind == "response" else None,
    }


class _Archive:
    """The archives of a task: one open file at a time."""

    def __init__(self, folder: str, limit: int):
        self.folder, self.limit, self._out, self._at = folder, limit, None, 0

    def add(self, record: bytes) -> tuple[str, int, int]:
        if self._out is None or self._at >= self.limit:
            self.close()
            self.file = f"{self.folder}/{uuid.uuid4().hex}.warc.gz"
            system, path = fs.FileSystem.from_uri(self.file)
            system.create_dir(path.rsplit("/", 1)[0], recursive=True)
            self._out, self._at = system.open_output_stream(path, compression=None, buffer_size=1 << 20), 0
        member = gzip.compress(record, GZIP_LEVEL, mtime=0)
        self._out.write(member)
        place = self.file, self._at, len(member)
        self._at += len(member)
        return place

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self._out = None


def _written(folder: str, limit: int, least_bytes: int):
    """Rows (page_id, url, html, hex, first), equal payloads of a page together, to archives; yields the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, before, again = _Archive(folder, limit), None, 0
        try:
            for whole in batches:
                for lo in range(0, whole.num_rows, 500):
                    rows = []
                    for row in whole.slice(lo, 500).to_pylist():
                        page, payload, refers = row["page_id"], (row["html"] or "").encode(), row["first"]
                        digest = base32_sha1(payload)
                        again = again + 1 if (page, digest) == before else 0
                        before = (page, digest)
                        if refers is None and again and page is not None and len(payload) >= least_bytes:
                            refers = page
                        place = archive.add(_record(page, row["url"], payload, digest, refers, again))
                        rows.append((page, row["url"], digest, "response" if refers is None else "revisit", *place))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), to_arrow(INDEX), strict=True)], schema=to_arrow(INDEX))
        finally:
            archive.close()

    return run


def write(pages: DataFrame, folder: str | None = None, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archive all pages; the index, as a stored table."""
    spark = pages.sparkSession
    folder = folder or work_path(spark, "llm-warc")
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html", F.sha1(payload.cast("binary")).alias("hex"))
    # The payloads of one page, and pages without an id, are dealt out apart; only equal payloads of a page must meet.
    key = F.when(F.col("page_id").isNull(), F.xxhash64("url", "hex")).otherwise(F.xxhash64("page_id", "hex"))
    facts = staged(rows.select("page_id", "hex", F.octet_length(payload).cast("long").alias("n")), "payloads")
    # The least page of each payload that several rows have; then the rows that revisit it, by page.
    groups = facts.where(F.col("n") >= least_bytes).groupBy("hex").agg(F.min("page_id").alias("first"), F.count("page_id").alias("rows")).where("rows > 1").drop("rows")
    revisits = facts.select("page_id", "hex").distinct().join(groups, "hex").where("page_id > first")
    revisits = revisits.select(F.xxhash64("page_id", "hex").alias("__key"), "first")
    total = facts.agg(F.sum("n")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // archive_bytes))
    placed = rows.withColumn("__key", key).repartition(tasks, "__key").join(revisits, "__key", "left").drop("__key")
    return staged(placed.sortWithinPartitions("page_id", "hex").mapInArrow(lean(_written(folder, archive_bytes, least_bytes)), INDEX), "index")


def _ranges(places: list[dict], gap: int, most: int) -> Iterator[list[dict]]:
    """Runs of sorted places of one file that are read at once."""
    run: list[dict] = []
    for place in places:
        if run and (place["file"] != run[0]["file"] or place["offset"] - run[-1]["offset"] - run[-1]["length"] > gap or place["offset"] + place["length"] - run[0]["offset"] > most):
            yield run
            run = []
        run.append(place)
    if run:
        yield run


def _read(gap: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, name, source = to_arrow(RECORD), None, None
        for batch in batches:
            for places in _ranges(batch.to_pylist(), gap, most):
                if places[0]["file"] != name:
                    if source is not None:
                        source.close()
                    name = places[0]["file"]
                    system, path = fs.FileSystem.from_uri(name)
                    source = system.open_input_file(path)
                low = places[0]["offset"]
                data = source.read_at(places[-1]["offset"] + places[-1]["length"] - low, low)
                rows = [parse(zlib.decompress(data[p["offset"] - low : p["offset"] - low + p["length"]], 31)) for p in places]
                yield pa.RecordBatch.from_pylist(rows, schema=types)
        if source is not None:
            source.close()

    return run


def read(index: DataFrame, gap: int = GAP_BYTES, most: int = READ_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records of index rows: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    The index says how many bytes there are to read, and so how many tasks they take.
    """
    spark = index.sparkSession
    places = index.select("file", "offset", "length")
    total, rows = places.agg(F.sum("length"), F.count("*")).first()
    tasks = max(-(-(total or 0) // task_bytes), min(rows, spark.sparkContext.defaultParallelism))
    block = F.floor(F.col("offset") / min(most, task_bytes))
    places = places.repartition(max(1, tasks), "file", block).sortWithinPartitions("file", "offset")
    return places.mapInArrow(lean(_read(gap, most)), RECORD)
