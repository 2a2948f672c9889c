"""Web archives (WARC) with an index that is written first and read first.

write_archives: each task writes its pages as records of one file after the other, each record a gzip member of its own,
and returns an index row per record: file, offset, length, URL, digest.  Only the index rows of the attempt
that succeeded count, so files that a lost executor has begun are never read.

read_records: the selected index rows, sorted by file and offset over range partitions; neighbours are coalesced into
one read as long as the gap between them is small and the read is not too long, and the records are cut out of it.

A payload that a record before holds already is a revisit: a record without the payload that names the other.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, pick, shared_folder, table

#: Payloads of fewer bytes are never revisits.
LEAST = 100
#: An archive is closed beyond so many bytes; a read takes so many at most, unless one record is longer, and passes over
#: gaps of so many.
FILE_BYTES, READ_BYTES, GAP_BYTES = 1 << 30, 8 << 20, 64 << 10
#: A digest with this share of all rows is hot.
_HOT = 1000

INDEX = "file string, offset long, length long, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _open(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"urn:x-page:{'' if page_id is None else page_id}:{digest[:32]}"


def _page_of(record_id: str) -> int | None:
    page = record_id.split(":")[2]
    return int(page) if page else None


def _field(url: str) -> str:
    """A URL as a header's value: blanks, control characters and such percent-encoded."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, other_url: str | None, revisit: bool) -> bytes:
    """A response, or a revisit of refers_to, in the form of WARC 1.1; the HTTP header tells the full payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{_record_id(page_id, digest)}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    lines += [f"WARC-Target-URI: {_field(url)}"] if url is not None else []
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_record_id(refers_to, digest)}>"]
        lines += [f"WARC-Refers-To-Target-URI: {_field(other_url)}"] if other_url is not None else []
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """A record's fields as RECORD names them; payload is null for a revisit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not match its digest")
    id_ = _page_of(fields["WARC-Record-ID"].strip("<>"))
    return {"page_id": id_, "record_type": fields["WARC-Type"], "refers_to": _page_of(fields["WARC-Refers-To"].strip("<>")) if revisit else None, "payload_bytes": length, "payload_digest": digest, "payload": None if revisit else payload}


def with_originals(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """pages (page_id, url, html) with payload_digest, and original and original_url: the smallest page_id among equal
    payloads of at least `least` bytes, null where no two rows share one.

    Digests that very many rows share are few and broadcast; no hot digest is a join's key, nor is a small payload.
    """
    rows = pages.withColumn("payload_digest", F.sha2(F.coalesce("html", F.lit("")), 256)).withColumn("large", F.octet_length(F.coalesce("html", F.lit(""))) >= least)
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url")))
    sets = rows.where("large").groupBy("payload_digest").agg(F.count("*").alias("c"), first.alias("o")).where("c > 1")
    sets = kept(sets.select(F.col("payload_digest").alias("d"), "c", F.col("o.page_id").alias("original"), F.col("o.url").alias("original_url")))
    hot = F.col("c") >= F.greatest(F.lit(2.0), F.lit(sets.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0] / _HOT))
    often = sets.where(hot).select(F.col("d").alias("often"), F.col("original").alias("o1"), F.col("original_url").alias("u1"))
    rest = sets.select(F.col("d").alias("key"), F.col("original").alias("o2"), F.col("original_url").alias("u2"))
    rows = rows.join(F.broadcast(often), F.col("large") & (F.col("payload_digest") == F.col("often")), "left")
    alone = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))  # matches nothing
    rows = rows.withColumn("key", F.when(F.col("large") & F.col("often").isNull(), F.col("payload_digest")).otherwise(alone)).join(rest, "key", "left")
    known = F.col("often").isNotNull()
    return rows.select("page_id", "url", "html", "payload_digest", F.when(known, F.col("o1")).otherwise(F.col("o2")).alias("original"), F.when(known, F.col("u1")).otherwise(F.col("u2")).alias("original_url"))


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of pages (page_id, url, html) to archives in folder; returns the index, a kept() table.

    folder is a path or URI that all executors reach through pyarrow.fs.  A null html is an empty payload, a null url
    leaves the header out, a null page_id is written as an empty one and never is the response of equal payloads
    unless all their page_ids are null; rows that repeat are a record each, and all rows of the smallest page_id among
    equal payloads are responses; an empty table writes nothing; other columns are ignored.
    """
    rows = with_originals(pick(pages, page_id="long", url="string", html="string"), least)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        files.create_dir(root, recursive=True)
        out, path, at = None, "", 0
        try:
            for batch in batches:
                index = []
                for r in batch.to_pylist():
                    payload = (r["html"] or "").encode()
                    revisit = r["original"] is not None and r["original"] != r["page_id"]
                    refers_to = r["original"] if revisit else None
                    raw = gzip.compress(record(r["page_id"], r["url"], payload, r["payload_digest"], refers_to, r["original_url"], revisit), 4, mtime=0)
                    if out is None or at + len(raw) > file_bytes and at:
                        if out is not None:
                            out.close()
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        path, at = f"{folder.rstrip('/')}/{name}", 0
                        out = files.open_output_stream(f"{root.rstrip('/')}/{name}", compression=None)
                    out.write(raw)
                    index.append({"file": path, "offset": at, "length": len(raw), "page_id": r["page_id"], "url": r["url"], "payload_bytes": len(payload), "payload_digest": r["payload_digest"], "record_type": "revisit" if revisit else "response", "refers_to": refers_to})
                    at += len(raw)
                yield pa.RecordBatch.from_pylist(index, schema=_schema(INDEX))
        finally:
            if out is not None:
                out.close()

    return kept(rows.mapInArrow(write, INDEX))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def coalesced(offsets: list[int], lengths: list[int], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int]]:
    """(first, end) of the runs of sorted byte ranges of one file that are read at once."""
    out: list[tuple[int, int]] = []
    first = 0
    for i in range(1, len(offsets) + 1):
        if i == len(offsets) or offsets[i] - (offsets[i - 1] + lengths[i - 1]) > gap or offsets[i] + lengths[i] - offsets[first] > most:
            out.append((first, i))
            first = i
    return out


def read_records(index: DataFrame, gap: int = GAP_BYTES, most: int = READ_BYTES) -> DataFrame:
    """The records of some index rows, as RECORD: read from the archives by coalesced byte ranges, checked against their
    digests.  A revisit has the length and digest of the payload that it stands for, and a null payload."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, source = None, None
        for batch in batches:
            rows = batch.to_pylist()
            cuts = [i for i in range(len(rows)) if not i or rows[i]["file"] != rows[i - 1]["file"]] + [len(rows)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if rows[a]["file"] != file:
                    if source is not None:
                        source.close()
                    file = rows[a]["file"]
                    files, path = _open(file)
                    source = files.open_input_file(path)
                for first, end in coalesced([r["offset"] for r in rows[a:b]], [r["length"] for r in rows[a:b]], gap, most):
                    some = rows[a + first : a + end]
                    base = some[0]["offset"]
                    data = memoryview(source.read_at(some[-1]["offset"] + some[-1]["length"] - base, base))
                    got = [parsed(gzip.decompress(data[r["offset"] - base : r["offset"] - base + r["length"]])) | {"url": r["url"]} for r in some]
                    yield pa.RecordBatch.from_pylist(got, schema=_schema(RECORD))
        if source is not None:
            source.close()

    wanted = index.select("file", "offset", "length", "url")
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wanted.repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(read, RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """records, revisits with the payload of the record that they refer to, if it is among them: each payload that is
    asked for goes to the tasks that hold revisits of it, of which Spark splits the large ones."""
    got = records.where("record_type = 'response'").dropDuplicates(["page_id", "payload_digest"])
    got = got.select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload").alias("original"))
    revisits = records.where("record_type = 'revisit'").drop("payload").join(got, ["refers_to", "payload_digest"], "left").withColumnRenamed("original", "payload")
    return records.where("record_type = 'response'").unionByName(revisits.select(*records.columns))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(table(spark, sf_dir, "pages"), f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP12_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
