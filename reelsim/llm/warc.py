"""WARC archives: write, normalise a monolithic gzip stream, read back.

``write_archives`` writes one WARC record per page with Spark's text writer:
each file is a single gzip stream over all its records, which cannot be
entered in the middle.  ``normalise`` inflates every such file once, from
front to back, rewrites each record as a gzip member of its own and writes a
sidecar index of members' offsets beside the archive.  ``read_records`` seeks
each indexed member and reads it alone.

Of pages with equal payloads of at least ``DEDUP_BYTES`` bytes the smallest
page_id is a response, the others are revisits that refer to it and carry no
payload, only its digest and length.

Defined results: a null payload is empty; a null url is written as
``urn:page:<id>``, line breaks in a url are percent-encoded; a page_id that
repeats gives a record for every row; rows without a page_id get a record
too and are never referred to; an empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsim.llm.common import shuffle_partitions, split_join, store, trimmed
from reelsim.llm.files import open_store, whole_file

DEDUP_BYTES = 100
BREAK = "\r\n"
READ_BYTES = 1 << 20
DATE = "2024-01-01T00:00:00Z"
INDEX = "archive string, offset long, length long, record_id string, record_type string"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def plan_records(pages: DataFrame) -> DataFrame:
    """Pages with payload, digest and, for revisits, the response's page_id."""
    spark = pages.sparkSession
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    p = p.select("*", F.octet_length("payload").cast("long").alias("n"), F.sha2("payload", 256).alias("digest"))
    large = p.filter((F.col("n") >= DEDUP_BYTES) & F.col("page_id").isNotNull())
    first = store(large.groupBy("digest").agg(F.min("page_id").alias("leader"), F.count("*").alias("copies"))
                       .filter("copies > 1"), "payloads")
    total = (first.agg(F.sum("copies").alias("n")).first()["n"] or 0)
    out = split_join(p, first, "digest", "copies", total, "left", F.xxhash64("page_id"))
    revisit = (F.col("n") >= DEDUP_BYTES) & F.col("leader").isNotNull() & (F.col("page_id") != F.col("leader"))
    return out.withColumn("leader", F.when(revisit, F.col("leader")))


def record_text() -> Column:
    """A record without its closing blank lines, which the writer adds."""
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    uri = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.concat(F.lit("urn:page:"), page)), "\r", "%0D"), "\n", "%0A")
    again = F.col("leader").isNotNull()
    block = F.when(again, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("payload")))
    head = [F.lit("WARC/1.1"),
            F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
            F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
            F.lit(f"WARC-Date: {DATE}"),
            F.concat(F.lit("WARC-Target-URI: "), uri),
            F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
            F.concat(F.lit("X-Payload-Length: "), F.col("n")),
            F.when(again, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("leader"), F.lit(">"))),
            F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            F.lit("Content-Type: application/http; msgtype=response"),
            F.concat(F.lit("Content-Length: "), F.octet_length(block))]
    return F.concat(F.concat_ws(BREAK, *head), F.lit(BREAK + BREAK), block)


def write_archives(pages: DataFrame, path: str, per_file: int = 50_000) -> None:
    """Monolithic gzip files of WARC records; Spark's writer closes every
    record with the two line breaks that the format asks for."""
    (plan_records(pages).select(record_text().alias("value"))
     .write.option("compression", "gzip").option("lineSep", BREAK + BREAK)
     .option("maxRecordsPerFile", per_file).text(path))


def inflated(stream) -> Iterator[bytes]:
    """A gzip stream of any number of members, inflated once, in pieces of
    at most ``READ_BYTES`` however far it inflates."""
    unzip, inside = zlib.decompressobj(31), False
    while raw := stream.read(READ_BYTES):
        while raw:
            yield unzip.decompress(raw, READ_BYTES)
            raw, inside = unzip.unconsumed_tail, not unzip.eof
            if unzip.eof:
                raw, unzip = unzip.unused_data, zlib.decompressobj(31)
    if inside:
        raise ValueError("truncated gzip stream")


def records_of(stream) -> Iterator[bytes]:
    """Raw records of a gzip stream; memory is one record and one piece."""
    buf, need = bytearray(), None
    for piece in inflated(stream):
        buf += piece
        while True:
            if need is None:
                at = buf.find(b"\r\n\r\n")
                if at < 0:
                    break
                size = next(int(x.split(b":")[1]) for x in bytes(buf[:at]).split(b"\r\n") if x.lower().startswith(b"content-length:"))
                need = at + 4 + size + 4
            if len(buf) < need:
                break
            yield bytes(buf[:need])
            del buf[:need]
            need = None
    if buf:
        raise ValueError("truncated WARC record")


def headers(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields of a record (names lower-cased) and its block."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return {k.lower(): v for k, v in fields.items()}, block[:int(fields["Content-Length"])]


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Every ``*.gz`` file of ``source`` becomes ``target/<name>.warc.gz``,
    a gzip member per record, and ``.idx``, its members as JSON lines."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path", "length")
    n = files.count()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                name = path.rpartition("/")[2].partition(".")[0]
                archive = f"{target}/{name}.warc.gz"
                at, lines = 0, 0
                fs, where = open_store(path)
                with fs.open_input_stream(where, compression=None) as stream, whole_file(archive) as out, whole_file(archive + ".idx") as side:
                    for record in records_of(stream):
                        fields, _ = headers(record)
                        z = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = z.compress(record) + z.flush()
                        out.write(member)
                        line = {"archive": archive, "offset": at, "length": len(member),
                                "record_id": fields["warc-record-id"], "record_type": fields["warc-type"]}
                        side.write((json.dumps(line) + "\n").encode())
                        at += len(member)
                        lines += 1
                yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([lines], pa.int64())], ["archive", "records"])

    if n:
        # one task per file; the driver gets one row per file's sum
        (files.repartition(min(n, 4 * shuffle_partitions(spark)), "path").mapInArrow(trimmed(work), "archive string, records long")
              .agg(F.sum("records")).collect())


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of normalised archives, each read by its offset:
    ``page_id, url, record_type, refers_to, payload_bytes, payload_digest,
    html`` (html is null for revisits)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        name, file = None, None
        page = lambda x: None if x is None or x[10:-1] == "none" else int(x[10:-1])
        for b in batches:
            rows, held = [], 0

            def flush():
                cols = list(zip(*rows))
                rows.clear()
                types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                  ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "html"])

            for archive, offset, length in zip(*(b.column(x).to_pylist() for x in range(3))):
                if archive != name:
                    fs, where = open_store(archive)
                    name, file = archive, fs.open_input_file(where)
                file.seek(offset)
                f, block = headers(zlib.decompress(file.read(length), 31))
                url = None if f["warc-target-uri"].startswith("urn:page:") else f["warc-target-uri"]
                if f["warc-type"] == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    size, digest, html = len(payload), hashlib.sha256(payload).hexdigest(), payload.decode()
                else:
                    size, digest, html = int(f["x-payload-length"]), f["warc-payload-digest"].partition(":")[2], None
                rows.append((page(f["warc-record-id"]), url, f["warc-type"], page(f.get("warc-refers-to")), size, digest, html))
                held += size
                if held > 8 << 20:
                    yield flush()
                    held = 0
            if rows:
                yield flush()

    index = spark.read.schema(INDEX).option("pathGlobFilter", "*.idx").json(path)
    return index.select("archive", "offset", "length").mapInArrow(
        work, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, html string")
