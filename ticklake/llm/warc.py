"""WARC archives: written with an index first, read back by coalesced byte ranges.

`write_archives` lets every task stream its records into one archive of its
own (gzip, one member a record) and returns an index with the file, offset,
length, URL and digest of each record. `read_records` takes any selection of
index rows, sorts them by file and offset, joins neighbours into ranges and
fetches each range with a single read.

Edges: null html is an empty payload; a null URL is written as `urn:page:<id>`;
no pages give no archives; repeated rows are written and returned as often as
they occur. Of equal payloads of at least `min_revisit` bytes the largest
page_id is the response (rows that repeat that page_id too); the others are
revisits. A null page_id is a revisit if any other page has the payload.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.session import qualified, work_path

from .common import saved, text_or_empty

MIN_REVISIT = 1000
RANGE_BYTES = 8 << 20   # a coalesced range ends beyond this size
GAP_BYTES = 64 << 10    # unselected bytes that are cheaper to read than to skip
_ROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
INDEX = ("page_id long, url string, file string, offset long, length long, digest string, "
         "payload_bytes long, record_type string, refers_to long")
RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _ROW[c.split()[1]]) for c in ddl.split(",")])


def _filesystem(path: str):
    """The store and path of a URI."""
    return fs.FileSystem.from_uri(path)


def classify(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, payload_bytes, digest, record_type, refers_to. Only ids and
    digests are grouped; the payloads themselves join by page, so no digest is a hot key for them."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.encode(text_or_empty("html"), "UTF-8").alias("payload"))
    p = p.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    long_ = p.where(F.col("payload_bytes") >= min_revisit).select("page_id", "digest", "payload_bytes")
    # a group of one needs no entry, so the table below holds shared payloads alone
    shared = (long_.groupBy("digest", "payload_bytes").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
              .where("n > 1 AND keeper IS NOT NULL").drop("n"))
    revisits = (long_.join(shared, ["digest", "payload_bytes"]).where("NOT page_id <=> keeper")
                .groupBy("page_id", "digest").agg(F.first("keeper").alias("refers_to")))
    j = p.join(revisits.select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "refers_to"),
               F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest")), "left")
    return j.select("page_id", "url", "payload", "payload_bytes", "digest",
                    F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"), "refers_to")


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 1, mtime=0)


def _record(row: dict, url: str) -> bytes:
    ident = str(uuid.uuid5(uuid.NAMESPACE_URL, f"page:{row['page_id']}:{row['digest']}"))
    headers = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<urn:uuid:{ident}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
               ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
               ("Content-Type", "application/http; msgtype=response"), ("X-Page-ID", "" if row["page_id"] is None else str(row["page_id"])),
               ("X-Payload-Length", str(row["payload_bytes"]))]
    if row["record_type"] == "revisit":
        refers = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{row['refers_to']}:{row['digest']}")
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", f"<urn:uuid:{refers}>"), ("X-Refers-To-Page", str(row["refers_to"]))]
        return _member(headers, b"HTTP/1.1 200 OK\r\n\r\n")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    return _member(headers, http.encode() + row["payload"])


def write_archives(pages: DataFrame, folder: str | None = None, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write one archive a task below `folder` and return the index, itself a written table.
    An attempt has a file name of its own, and only files that the index names count:
    what a lost executor left half-written is never read."""
    # workers open the files themselves, so the folder is named as Spark resolves it: on a cluster whose default
    # store isn't the local disk a path without a scheme is in that store
    folder = qualified(pages.sparkSession, folder or work_path(pages.sparkSession, "llm-warc"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, name = None, 0, f"{folder}/part-{uuid.uuid4().hex}.warc.gz"
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if out is None:
                        store, path = _filesystem(name)
                        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                        out = store.open_output_stream(path, compression=None)
                        info = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                        ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")],
                                       b"format: WARC File Format 1.1\r\n")
                        out.write(info)
                        at = len(info)
                    url = row["url"] if row["url"] is not None else f"urn:page:{row['page_id']}"
                    member = _record(row, url.replace("\r", "%0D").replace("\n", "%0A"))
                    out.write(member)
                    rows.append(row | {"file": name, "offset": at, "length": len(member)})
                    at += len(member)
                yield pa.RecordBatch.from_pylist(rows, _schema(INDEX))
        finally:
            if out is not None:
                out.close()

    return saved(classify(pages, min_revisit).mapInArrow(write, INDEX), "warc-index")


def _parse(raw: bytes) -> dict:
    """Row of RECORD from one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    h = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    revisit = h["WARC-Type"] == "revisit"
    return {"page_id": int(h["X-Page-ID"]) if h["X-Page-ID"] else None, "url": h["WARC-Target-URI"],
            "payload": None if revisit else rest[:int(h["Content-Length"])].partition(b"\r\n\r\n")[2],
            "payload_bytes": int(h["X-Payload-Length"]), "payload_digest": h["WARC-Payload-Digest"].removeprefix("sha1:"),
            "record_type": h["WARC-Type"], "refers_to": int(h["X-Refers-To-Page"]) if revisit else None}


def read_records(index: DataFrame, range_bytes: int = RANGE_BYTES, gap_bytes: int = GAP_BYTES) -> DataFrame:
    """The records of the selected index rows (columns file, offset, length), fetched by sorted, coalesced ranges.
    A payload whose SHA-1 differs from its record's digest raises an error."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = source = None
        for batch in batches:
            wants = list(zip(*(c.to_pylist() for c in batch.columns)))
            i = 0
            while i < len(wants):
                file, first, length = wants[i]
                j, end = i + 1, first + length
                while (j < len(wants) and wants[j][0] == file and wants[j][1] - end <= gap_bytes
                       and sum(wants[j][1:]) - first <= range_bytes):
                    end = max(end, sum(wants[j][1:]))
                    j += 1
                if file != name:
                    if source is not None:
                        source.close()
                    store, path = _filesystem(file)
                    source, name = store.open_input_file(path), file
                data, rows = source.read_at(end - first, first), []
                for _, at, size in wants[i:j]:
                    row = _parse(zlib.decompress(data[at - first:at - first + size], 31))
                    if row["payload"] is not None and hashlib.sha1(row["payload"]).hexdigest() != row["payload_digest"]:
                        raise ValueError(f"damaged record at {at} of {file}")
                    rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, _schema(RECORD))
                i = j
        if source is not None:
            source.close()

    spark = index.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (index.select("file", "offset", "length").repartitionByRange(n, "file", "offset")
            .sortWithinPartitions("file", "offset").mapInArrow(fetch, RECORD))


def op3(spark, sf_dir: str) -> DataFrame:
    """Every page through an archive and back."""
    from .common import read
    index = write_archives(read(spark, sf_dir, "pages"))
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest AS d, payload_bytes AS b, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keeper IS NULL OR keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON d = payload_digest AND b = payload_bytes
"""
