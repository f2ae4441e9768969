"""WARC archives with an index: records are found by file, offset and length, and read by byte ranges.

``write`` puts every page into an archive of gzip members, one member a record, and
stores an index row for each: file, offset, length, URL, digest. A task writes files of
its own, whose names no other attempt uses, and the index names those of the tasks that
succeeded; what a lost executor left behind is never read. ``read`` takes any selection
of index rows, sorts them by file and offset, and fetches neighbours with one request.

Archives are opened in the tasks through ``pyarrow.fs``, so the folder has to be one it
knows (a shared mount, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import common
from tradelake.session import scratch_path

LEAST_REVISIT = 1000  # bytes; smaller equal payloads are all stored
FILE_BYTES = 1 << 30  # a task begins a new archive beyond it
SPAN_BYTES = 4 << 20  # most that one request fetches, unless one record is longer
GAP_BYTES = 64 << 10  # unselected bytes that a request may run across
TASK_BYTES = 16 << 20  # archive bytes that one reading task is given
DATE = "2024-01-01T00:00:00Z"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
INDEX = ("page_id long, url string, file string, offset long, length long, record_type string, record_id string, "
         "payload_digest string")
RECORD = ("page_id long, url string, record_type string, record_id string, refers_to_id string, "
          "payload_digest string, payload binary")


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(NAMES, f'{page_id}:{digest}')}"


def target(url: str | None) -> str:
    """The URL as a header value: no blanks or controls."""
    return "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    """One record, without compression; ``first`` is the page that a revisit refers to."""
    http = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}", "", ""]
    head = "\r\n".join(http).encode()
    block = head if first is not None else head + payload
    lines = [
        "WARC/1.0", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <{record_id(page_id, digest)}>",
        f"WARC-Date: {date}", f"WARC-Target-URI: {target(url)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if first is not None:
        lines += [f"WARC-Refers-To: <{record_id(first, digest)}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return b"".join(("\r\n".join(lines).encode(), block, b"\r\n\r\n"))


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record; raises if it isn't whole."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    length = int(headers["content-length"])
    if not first.startswith("WARC/") or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"broken record {headers.get('warc-record-id')}")
    return headers, rest[:length].partition(b"\r\n\r\n")[2]


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if "://" in path or path.startswith("/") else path)


def _writer(folder: str, date: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                found = []
                for page_id, url, payload, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    member = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = member.compress(record(page_id, url, payload, digest, first, date)) + member.flush()
                    out.write(data)
                    kind = "response" if first is None else "revisit"
                    found.append((page_id, url, name, at, len(data), kind, record_id(page_id, digest), digest))
                    at += len(data)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found), _types(INDEX))], names=_names(INDEX))
        finally:
            if out is not None:
                out.close()  # index rows are kept only if the task gets past this

    return run


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _types(schema: str) -> list[pa.DataType]:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return [kinds[field.split()[1]] for field in schema.split(", ")]


def first_copies(keyed: DataFrame, least: int) -> DataFrame:
    """``payload_digest, first``: payloads of at least ``least`` bytes that several pages have, and the largest page_id."""
    groups = keyed.where(F.octet_length("payload") >= least).groupBy("payload_digest").agg(
        F.max("page_id").alias("first"), F.min("page_id").alias("_low"),
        F.count_if(F.col("page_id").isNull()).alias("_nulls"))
    return groups.where("_low < first or (_nulls > 0 and first is not null)").select("payload_digest", "first")


def write(pages: DataFrame, root: str, least: int = LEAST_REVISIT, date: str = DATE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archive all ``pages(page_id, url, html)`` below ``root`` and return the stored index.

    A page whose payload (the html in UTF-8, null as empty) has at least ``least`` bytes and
    stands under a larger page_id too becomes a revisit of that page; rows that repeat this
    largest id are all responses, a null id is smaller than any. Other pages are responses.
    Other columns are ignored; an empty table gives an empty index. A very long text needs
    about three times its bytes in one worker.
    """
    spark = pages.sparkSession
    folder = f"{root}/archives"
    store, path = opened(folder)
    store.create_dir(path, recursive=True)
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    keyed = keyed.withColumn("payload_digest", F.sha1("payload"))
    # stored, so that its true size decides whether the payloads have to be shuffled for the join
    copies = common.stored(first_copies(keyed, least), "copies")
    joined = keyed.join(copies, "payload_digest", "left")
    revisits = (F.octet_length("payload") >= least) & F.col("first").isNotNull() & (
        F.col("page_id").isNull() | (F.col("page_id") < F.col("first")))
    rows = joined.select("page_id", "url", "payload", "payload_digest", F.when(revisits, F.col("first")).alias("first"))
    rows.mapInArrow(_writer(folder, date, file_bytes), INDEX).write.parquet(f"{root}/index")
    return index(spark, root)


def index(spark: SparkSession, root: str) -> DataFrame:
    """The index of the archives below ``root``; ``file`` names them in full."""
    rows = spark.read.schema(INDEX).parquet(f"{root}/index")
    return rows.withColumn("file", F.concat(F.lit(f"{root}/archives/"), "file"))


def spans(rows: list[tuple], most: int, gap: int) -> Iterator[list[tuple]]:
    """Neighbours of ``rows(page_id, url, file, offset, length)``, sorted, that one request fetches."""
    span: list[tuple] = []
    for row in rows:
        if span:
            near = row[2] == span[0][2] and row[3] - end <= gap and max(end, row[3] + row[4]) - span[0][3] <= most
            if not near:
                yield span
                span = []
        end = max(end, row[3] + row[4]) if span else row[3] + row[4]
        span.append(row)
    if span:
        yield span


def _fetcher(most: int, gap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            for span in spans(list(zip(*(c.to_pylist() for c in batch.columns))), most, gap):
                if span[0][2] != name:
                    if file is not None:
                        file.close()
                    name = span[0][2]
                    store, path = opened(name)
                    file = store.open_input_file(path)
                start = span[0][3]
                file.seek(start)
                data = memoryview(file.read(max(r[3] + r[4] for r in span) - start))
                found = []
                for page_id, url, _, offset, length in span:
                    headers, payload = parsed(zlib.decompress(data[offset - start : offset - start + length], 31))
                    digest = base64.b32decode(headers["warc-payload-digest"].partition(":")[2]).hex()
                    found.append((page_id, url, headers["warc-type"], headers["warc-record-id"].strip("<>"),
                                  headers.get("warc-refers-to", "").strip("<>") or None, digest, payload))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), _types(RECORD))], names=_names(RECORD))
        if file is not None:
            file.close()

    return run


def read(selected: DataFrame, span_bytes: int = SPAN_BYTES, gap_bytes: int = GAP_BYTES) -> DataFrame:
    """The records of the ``selected`` index rows, each as often as it is selected.

    ``payload`` is what the record itself holds; a revisit holds none. A broken record raises.
    Tasks get ranges of about ``TASK_BYTES`` of the archives, whatever the index weighs.
    """
    size = selected.agg(F.sum("length")).first()[0] or 0
    rows = selected.select("page_id", "url", "file", "offset", "length")
    rows = rows.repartitionByRange(max(1, -(-size // TASK_BYTES)), "file", "offset").sortWithinPartitions("file", "offset")
    return rows.mapInArrow(_fetcher(span_bytes, gap_bytes), RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of records read back.

    Length and SHA-1 are taken from the payloads; a revisit has those of the response that it refers to.
    """
    short = common.stored(records.select(
        "page_id", "record_type", "record_id", "refers_to_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest")), "records")
    responses = short.where("record_type = 'response'")
    revisits = short.where("record_type = 'revisit'").select("page_id", F.col("refers_to_id").alias("record_id"))
    # one row for each record: repeated rows share its id
    origin = responses.groupBy("record_id").agg(
        F.max("page_id").alias("refers_to"), F.first("payload_bytes").alias("payload_bytes"),
        F.first("payload_digest").alias("payload_digest"))
    found = revisits.join(origin, "record_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(columns).union(
        found.withColumn("record_type", F.lit("revisit")).select(columns))


def round_trip(pages: DataFrame) -> DataFrame:
    """All ``pages`` written to archives in the shared folder, read back by their index and resolved."""
    root = scratch_path(pages.sparkSession, "warc")
    return resolved(read(write(pages, root)))
