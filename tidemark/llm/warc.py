"""WARC archives with an index, read by coalesced byte ranges (operator 9).

Writing: each partition streams its records into archives of the shared folder, one gzip member per record, and
returns the *index*: archive, offset, length, URL, digest of every record. The name of an archive carries the task
attempt, and only the attempt that Spark commits gets into the index table; what a lost attempt wrote is never read.
Equal payloads of at least `min_revisit` bytes are stored once, by the smallest page_id; others are revisit records.

Reading starts from the index. The selected records are sorted by archive and offset, neighbouring byte ranges are
merged into one read of at most READ_BYTES (gaps up to GAP_BYTES are read over), and each record is checked against
its digest. Archives are divided into spans of SPAN_BYTES, so that readers are many however large an archive is.

Files go through pyarrow's file systems, by the URI of the folder that spark.checkpoint.dir names.

Cases: a null html is an empty payload; a null url writes no target URI, control characters in one are written
percent-encoded (the index keeps it as it was); a null page_id is never preferred as the response; rows with equal
page_id and payload are all responses; an empty table gives an empty index; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SALTS, scratch, written

MIN_REVISIT = 100             # smaller payloads are always stored
ARCHIVE_BYTES = 256 << 20     # an archive is closed when it has grown to this
SPAN_BYTES = 16 << 20         # index rows of so many bytes of an archive go to one reader
READ_BYTES = 8 << 20          # one read at most (a larger record alone is read whole)
GAP_BYTES = 64 << 10          # unselected bytes read over rather than skipped

_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def classify(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html (null: empty), digest, size, record_type, refers_to."""
    rows = (pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
            .withColumn("digest", F.sha2("html", 256)).withColumn("size", F.octet_length("html").cast("long")))
    # one row for each payload that occurs again: pre-aggregated before the shuffle, whatever the number of copies
    first = (rows.where(F.col("size") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
             .where("n > 1 and first_id is not null").select("digest", "first_id"))
    # a payload may hold any share of the rows: they are dealt to parts, and a narrow row of each part finds the payload's first
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    parts = dealt.where(F.col("size") >= min_revisit).select("digest", "salt").distinct().join(first, "digest")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return (dealt.join(parts, ["digest", "salt"], "left")
            .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(again, F.col("first_id")))
            .select("page_id", "url", "html", "digest", "size", "record_type", "refers_to"))


def record(page_id, url, payload: bytes, digest: str, size: int, kind: str, refers_to) -> bytes:
    """One WARC 1.1 record, not yet compressed."""
    name = uuid.uuid5(uuid.NAMESPACE_OID, f"{page_id}|{digest}|{kind}")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}", "Content-Type: text/html; charset=utf-8"]
    if url is not None:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page-Id: {refers_to}"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of a record; broken records raise."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not sep or first != "WARC/1.1":
        raise ValueError("no WARC record here")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("a WARC record of another length than it says")
    return fields, rest[:n]


_INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
                    ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string())])
_INDEX_DDL = "archive string, offset long, length long, page_id long, url string, digest string, record_type string"


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write classified pages below folder; returns the index (a written table)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        stem = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out, name, offset, no = None, "", 0, 0
        try:
            for b in batches:
                rows: list[tuple] = []
                for page_id, url, html, digest, size, kind, ref in zip(*(b.column(c).to_pylist() for c in (
                        "page_id", "url", "html", "digest", "size", "record_type", "refers_to"))):
                    if out is None or offset >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, offset, no = f"{stem}-{no:04d}.warc.gz", 0, no + 1
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                    data = pack.compress(record(page_id, url, html.encode("utf-8"), digest, size, kind, ref)) + pack.flush()
                    out.write(data)
                    rows.append((name, offset, len(data), page_id, url, digest, kind))
                    offset += len(data)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX)], schema=_INDEX)
        finally:
            if out is not None:
                out.close()

    return written(records.mapInArrow(run, _INDEX_DDL), "warc-index")


_RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                      ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                      ("refers_to", pa.int64())])


def coalesced(rows: Iterator[dict]) -> Iterator[list[dict]]:
    """Runs of index rows, sorted by archive and offset, that one read fetches."""
    run: list[dict] = []
    end = 0
    for r in rows:
        if run and (r["archive"] != run[0]["archive"] or r["offset"] > end + GAP_BYTES
                    or r["offset"] + r["length"] - run[0]["offset"] > READ_BYTES):
            yield run
            run = []
        end = max(end, r["offset"] + r["length"]) if run else r["offset"] + r["length"]
        run.append(r)
    if run:
        yield run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the selected index rows: page_id, url, record_type, payload (null for a revisit),
    payload_bytes, payload_digest, refers_to. Each is checked against its digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        name, source = "", None
        for reads in coalesced(r for b in batches for r in b.to_pylist()):
            if reads[0]["archive"] != name:
                if source is not None:
                    source.close()
                name, source = reads[0]["archive"], store.open_input_file(f"{base}/{reads[0]['archive']}")
            start = reads[0]["offset"]
            data = source.read_at(max(r["offset"] + r["length"] for r in reads) - start, start)
            out: list[tuple] = []
            for r in reads:
                at = r["offset"] - start
                head, payload = parse(zlib.decompress(data[at:at + r["length"]], 31))
                kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha256:")
                if kind == "response" and hashlib.sha256(payload).hexdigest() != r["digest"] or digest != r["digest"]:
                    raise ValueError(f"{name} at {r['offset']}: the payload doesn't have the digest of the index")
                page_id, ref = head.get("x-page-id"), head.get("x-refers-to-page-id")
                out.append((None if page_id is None else int(page_id), r["url"], kind,
                            payload if kind == "response" else None, int(head["x-payload-length"]), digest,
                            None if ref is None else int(ref)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RECORDS)], schema=_RECORDS)
        if source is not None:
            source.close()

    span = F.floor(F.col("offset") / SPAN_BYTES)
    return (index.select("archive", "offset", "length", "url", "digest", span.alias("span")).repartition("archive", "span")
            .sortWithinPartitions("archive", "offset").mapInArrow(
        run, "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, "
             "refers_to long"))


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages and read all records back."""
    folder = scratch(spark, "warc")
    return read_records(write_archives(classify(pages), folder), folder)
