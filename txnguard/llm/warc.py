"""WARC archives with an index, read back by coalesced byte ranges.

Writing: each task appends its pages to its own gzip-per-record WARC files in the shared folder and
returns one index row per record: file, offset, length, URL, digest. Of pages with equal payloads of
at least `min_revisit` bytes, the one with the smallest id is a `response`, the others are `revisit`
records that refer to it. A file's name holds the task attempt, and only the index (written once,
as a table) says which files count, so a retried or lost task leaves nothing half-written behind.

Reading: the selected index rows are sorted by file and offset, neighbours are joined into ranges
(up to `max_gap` bytes apart, `max_read` bytes in all), and each range is one read.

A null payload is empty; a null URL gives a record without target. Rows that repeat both id and
payload of a response are responses too. A row without id is a record of its own.
"""

from __future__ import annotations

import hashlib
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import pick, shared_path, small_batches

CRLF = b"\r\n"
# fixed values: header names of the WARC 1.1 format
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("page_id string, file string, offset long, length long, url string, digest string, "
         "record_type string")
RECORDS = ("page_id string, url string, record_type string, refers_to string, "
           "payload_bytes long, payload_digest string, payload binary")


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers),
             f"Content-Length: {len(block)}".encode()]
    plain = CRLF.join(lines) + CRLF + CRLF + block + CRLF + CRLF
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(plain) + z.flush()


def _name(page) -> str:
    """Ids are percent-encoded, so a line break ends no header; a missing id has no colon."""
    return "<urn:page>" if page is None else f"<urn:page:{quote(str(page))}>"


def page_record(page, url, payload: bytes, digest: str, first, date: str) -> bytes:
    """A response record, or a revisit of page `first` if that is given."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + CRLF + CRLF)
    headers = [("WARC-Type", "response" if first is None else "revisit"),
               ("WARC-Record-ID", _name(page)), ("WARC-Date", date),
               ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", f"sha256:{digest}")]
    if url is not None:
        headers.insert(1, ("WARC-Target-URI", quote(url, safe="%:/?#[]@!$&'()*+,;=~-._")))
    if first is None:
        return _record(headers, http + payload)
    return _record([*headers, ("WARC-Profile", REVISIT_PROFILE),
                    ("WARC-Refers-To", _name(first))], http)


def parse_record(data: bytes) -> dict:
    """Headers, HTTP headers and payload of one compressed record."""
    plain = zlib.decompress(data, 31)
    head, _, block = plain.partition(CRLF + CRLF)
    version, *lines = head.split(CRLF)
    if version != VERSION:
        raise ValueError("not a WARC record")
    headers = dict(line.decode().split(": ", 1) for line in lines)
    block = block[:int(headers["Content-Length"])]
    http, _, payload = block.partition(CRLF + CRLF)
    headers["http"] = dict(x.decode().split(": ", 1) for x in http.split(CRLF)[1:])
    headers["payload"] = payload
    return headers


def with_decisions(pages: DataFrame, page: str, url: str, payload: str,
                   min_revisit: int) -> DataFrame:
    """Pages with digest and `first`: the page that a revisit refers to, null for a response.

    One partial aggregate over digests finds the smallest ids; only repeated digests are joined
    back, so a digest held by a third of the pages is pre-aggregated and its join side splits."""
    body = F.coalesce(F.col("body").cast("binary"), F.lit(b""))
    rows = (pick(pages, page, url, payload).toDF("page", "url", "body")
            .select("page", "url", body.alias("payload")))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    repeated = (rows.filter(F.octet_length("payload") >= min_revisit).groupBy("digest")
                .agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n"))
                .filter("n > 1 and first is not null").select("digest", "first"))
    same = F.col("first").eqNullSafe(F.col("page"))
    return (rows.join(repeated, "digest", "left")
            .select(F.col("page").cast("string").alias("page"), "url", "payload", "digest",
                    F.when(~same, F.col("first")).cast("string").alias("first")))


def write_archive(pages: DataFrame, folder: str | None = None, page: str = "page_id",
                  url: str = "url", payload: str = "html", min_revisit: int = 100,
                  date: str = "1970-01-01T00:00:00Z", max_file: int = 1 << 30) -> DataFrame:
    """Write the archive and its index below `folder` (a new shared one by default); returns the
    index as a table. Its page_id is text."""
    spark = pages.sparkSession
    small_batches(spark)
    folder = folder or shared_path(spark, "warc")

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        out, part = None, 0
        for b in batches:
            rows = {k: [] for k in ("page_id", "file", "offset", "length", "url", "digest",
                                    "record_type")}
            for r in b.to_pylist():
                if out is None or out.tell() >= max_file:
                    if out is not None:
                        out.close()
                    file = f"pages-{task.partitionId():05d}-{part:03d}-{task.taskAttemptId()}.warc.gz"
                    out, part = store.open_output_stream(f"{root}/{file}", compression=None), part + 1
                    out.write(_record([("WARC-Type", "warcinfo"), ("WARC-Date", date),
                                       ("WARC-Record-ID", f"<urn:file:{file}>"),
                                       ("WARC-Filename", file),
                                       ("Content-Type", "application/warc-fields")],
                                      b"format: WARC File Format 1.1\r\n"))
                data = page_record(r["page"], r["url"], r["payload"], r["digest"], r["first"], date)
                for k, v in zip(rows, (r["page"], file, out.tell(), len(data), r["url"],
                                       r["digest"], "response" if r["first"] is None else "revisit")):
                    rows[k].append(v)
                out.write(data)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(
                [(k, pa.int64() if k in ("offset", "length") else pa.string()) for k in rows]))
        if out is not None:
            out.close()

    index = with_decisions(pages, page, url, payload, min_revisit).mapInArrow(run, INDEX)
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(index.schema).parquet(f"{folder}/index").withColumn(
        "file", F.concat(F.lit(f"{folder}/"), F.col("file")))


def coalesced(rows: list[tuple[str, int, int]], max_gap: int, max_read: int):
    """Ranges (file, from, to, positions of the rows) covering (file, offset, length) rows that
    are sorted by file and offset."""
    out: list[list] = []
    for i, (file, offset, length) in enumerate(rows):
        if (out and out[-1][0] == file and offset - out[-1][2] <= max_gap
                and offset + length - out[-1][1] <= max_read):
            out[-1][2] = max(out[-1][2], offset + length)
            out[-1][3].append(i)
        else:
            out.append([file, offset, offset + length, [i]])
    return out


def read_records(index: DataFrame, max_gap: int = 1 << 16, max_read: int = 8 << 20,
                 task_bytes: int = 64 << 20, with_payload: bool = True) -> DataFrame:
    """The records that rows of the index name: page_id, url, record_type, refers_to (text ids),
    payload_bytes and payload_digest of the full payload, payload (null for revisits)."""
    spark = index.sparkSession
    total = index.agg(F.sum("length")).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    chosen = (index.select("file", "offset", "length").repartitionByRange(parts, "file", "offset")
              .sortWithinPartitions("file", "offset"))

    def run(batches):
        opened: tuple = (None, None)
        for b in batches:
            rows = list(zip(*(b[c].to_pylist() for c in ("file", "offset", "length"))))
            for file, lo, hi, members in coalesced(rows, max_gap, max_read):
                if opened[0] != file:
                    if opened[1] is not None:
                        opened[1].close()
                    store, path = fs.FileSystem.from_uri(file)
                    opened = (file, store.open_input_file(path))
                data = opened[1].read_at(hi - lo, lo)
                got = [_row(parse_record(data[rows[i][1] - lo:rows[i][1] - lo + rows[i][2]]),
                            with_payload) for i in members]
                yield pa.RecordBatch.from_pylist(got, schema=pa.schema(
                    [("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("payload", pa.binary())]))
        if opened[1] is not None:
            opened[1].close()

    return chosen.mapInArrow(run, RECORDS)


def _page(name: str | None):
    return unquote(name[len("<urn:page:"):-1]) if name and name != "<urn:page>" else None


def _row(r: dict, with_payload: bool) -> dict:
    revisit = r["WARC-Type"] == "revisit"
    size = int(r["http"]["Content-Length"])
    digest = r["WARC-Payload-Digest"].split(":")[1]
    if not revisit and (hashlib.sha256(r["payload"]).hexdigest(), len(r["payload"])) != (digest,
                                                                                         size):
        raise ValueError(f"damaged record {r['WARC-Record-ID']}")
    return {"page_id": _page(r["WARC-Record-ID"]), "url": r.get("WARC-Target-URI"),
            "record_type": r["WARC-Type"], "refers_to": _page(r.get("WARC-Refers-To")),
            "payload_bytes": size, "payload_digest": digest,
            "payload": r["payload"] if with_payload and not revisit else None}
