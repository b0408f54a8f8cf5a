"""WARC archives of page tables, with an index that is written first and read first.

write() makes one archive file a task (one gzip member a record) and an index
row for each record: file, offset, length, url, digest, page_id, record_type.
The index is saved by Spark's commit protocol, so it names only files of tasks
that succeeded; a lost task's file is never referred to. read() takes any
selection of index rows, sorts them by file and offset, and coalesces
neighbouring byte ranges into single reads of bounded size.

Of records with equal payloads of at least min_bytes bytes the one with the
smallest page_id is a response, the others are revisits that carry the digest
and no payload.

Defined cases: null html is an empty payload; a null page_id can't be the
smallest while there is another, and its records keep a null id; rows that
repeat a page_id with an equal payload share their role; a null url is left out
of the record; line breaks in urls are escaped; an empty table makes no records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, saved

#: Ranges at most this far apart are read at once, up to READ bytes.
GAP, READ = 64 << 10, 8 << 20
INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_URN = "urn:tidelog:page:"
_DATE = "1970-01-01T00:00:00Z"


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <{_URN}{refers_to}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], names=[n for n, _ in fields])


def write(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Writes pages (page_id, url, html) and returns the saved index. path is a folder that all executors share."""
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha", F.unhex(F.sha1("payload")))
    # saved, so that both sides of the join come from files and a hot digest's rows can be split
    firsts = saved(rows.groupBy("sha").agg(F.min("page_id").alias("first")), "first-pages")
    typed = rows.join(firsts, "sha").select(
        "page_id",
        "url",
        "payload",
        "sha",
        F.when((F.octet_length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for b in batches:
            made = []
            for page_id, url, payload, sha, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    t = TaskContext.get()
                    file = f"{path}/part-{t.partitionId():06d}-{t.taskAttemptId()}.warc.gz"
                    files, inner = _filesystem(file)
                    files.create_dir(inner.rpartition("/")[0], recursive=True)
                    out, at = files.open_output_stream(inner, compression=None), 0
                digest = base64.b32encode(sha).decode()
                z = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = z.compress(_record(page_id, url, payload, digest, refers_to)) + z.flush()
                out.write(data)
                made.append((file, at, len(data), url, digest, page_id, "response" if refers_to is None else "revisit"))
                at += len(data)
            yield _batch(made, INDEX)
        if out is not None:
            out.close()

    return saved(typed.mapInArrow(run, INDEX), "warc-index")


def parse(record: bytes) -> tuple:
    """A RECORD row of one uncompressed record; a response's length and digest are taken from its payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda k: (int(v) if (v := fields[k][len(_URN) + 1 : -1]) else None) if k in fields else None
    if fields["WARC-Type"] == "revisit":
        n = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
        digest, payload = fields["WARC-Payload-Digest"][5:], None
    else:
        n, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if "sha1:" + digest != fields["WARC-Payload-Digest"]:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} doesn't have its digest")
    return number("WARC-Record-ID"), fields.get("WARC-Target-URI"), n, digest, fields["WARC-Type"], number("WARC-Refers-To"), payload


def _ranges(rows: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(offset, length, members) of coalesced reads of sorted (offset, length)."""
    group: list[tuple[int, int]] = []
    for offset, length in rows:
        if group and (offset - sum(group[-1]) > GAP or offset + length - group[0][0] > READ):
            yield group[0][0], sum(group[-1]) - group[0][0], group
            group = []
        group.append((offset, length))
    if group:
        yield group[0][0], sum(group[-1]) - group[0][0], group


def read(index: DataFrame, payloads: bool = True, task_bytes: int = 32 << 20) -> DataFrame:
    """RECORD rows of the records that the rows of index select. A task takes runs of neighbouring ranges."""
    spark = index.sparkSession
    total = index.agg(F.sum("length")).first()[0] or 0
    n = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    dealt = (
        index.select("file", "offset", "length", F.floor(F.col("offset") / F.lit(READ)).alias("block"))
        .repartition(n, "file", "block")
        .sortWithinPartitions("file", "offset")
        .select("file", "offset", "length")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = source = None
        for b in batches:
            files, offsets, lengths = (c.to_pylist() for c in b.columns)
            at = 0
            while at < len(files):
                end = at
                while end < len(files) and files[end] == files[at]:
                    end += 1
                if files[at] != name:
                    if source is not None:
                        source.close()
                    name = files[at]
                    system, inner = _filesystem(name)
                    source = system.open_input_file(inner)
                for start, size, members in _ranges(list(zip(offsets[at:end], lengths[at:end]))):
                    data = source.read_at(size, start)
                    rows = (parse(zlib.decompress(data[o - start : o - start + k], 31)) for o, k in members)
                    yield _batch([r if payloads else (*r[:-1], None) for r in rows], RECORD)
                at = end

    return dealt.mapInArrow(run, RECORD)
