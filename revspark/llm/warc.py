"""WARC archives of pages: a writer, and a splittable reader of gzipped WARC files.

The writer's tasks each write one ``.warc.gz`` file with a gzip member per record, and the files'
names reach the reader through a manifest that Spark commits: what a lost or repeated task left
behind is never read. Records of equal payloads refer to the one with the smallest page id
(``revisit``): the digest decides, computed before the join, and only (digest, page id) pairs
are grouped.

The reader deals byte ranges of the files to tasks. A task looks for the gzip magic in its range,
takes a place for a member only if it decodes to a WARC header with a length that the member
has, and owns the records whose members start inside the range, reading past its end for the
last one.

Defined results: a null page text is an empty payload; a null url is replaced by a name made of
the id; of repeated rows of the smallest id all are responses; a null id is never the one
referred to unless all ids of the payload are null, and then all are responses; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.llm.common import shuffle_partitions, slices, written
from revspark.scratch import shared_path

# ---- fixed values of the format ---------------------------------------------------------------
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the table holds no time of capture
GZIP_MAGIC = b"\x1f\x8b\x08"
# ----------------------------------------------------------------------------------------------
RANGE_BYTES = 4 << 20
READ_BYTES = 256 << 10
LEVEL = 4

MANIFEST = "path string, size long, records long"
PAGES = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, target_uri string")


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system that a Hadoop-style path names, and the path within it."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    uri = re.sub(r"^s3[an]:", "s3:", uri)
    return pyarrow.fs.FileSystem.from_uri(uri)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, kind: str, digest: str, size: int,
           payload: bytes | None, refers_to: int | None) -> bytes:
    """One WARC record; a revisit's block holds the HTTP head alone."""
    name = f"urn:page:{'none' if page_id is None else page_id}"
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = head + (payload or b"")
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", DATE),
        ("WARC-Target-URI", name if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + lines + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """(fields, block) of a member's record, or None if it isn't a whole WARC record."""
    if not data.startswith(b"WARC/1."):
        return None
    end = data.find(b"\r\n\r\n")
    fields = {}
    for line in data[:end].split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if end < 0 or not size.isdigit() or len(data) != end + 8 + int(size):
        return None
    return fields, data[end + 4: end + 4 + int(size)]


def inflate(read, at: int) -> tuple[bytes, int] | None:
    """(data, place behind it) of the gzip member at ``at``; None if there is no WARC member.
    ``read(start, n)`` gives the file's bytes."""
    unpack, parts, held = zlib.decompressobj(31), [], 0
    while not unpack.eof:
        raw = read(at, READ_BYTES)
        if not raw:
            return None
        try:
            parts.append(unpack.decompress(raw))
        except zlib.error:
            return None
        at += len(raw) - len(unpack.unused_data)
        if not held and parts[0] and not VERSION.startswith(parts[0][:7]):
            return None
        held += len(parts[-1])
    return b"".join(parts), at


def records_in(read, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records whose members start in [start, end) of a file."""
    at = start
    while at < end:
        raw = read(at, min(READ_BYTES, end - at + len(GZIP_MAGIC) - 1))
        found = raw.find(GZIP_MAGIC)
        if found < 0:
            if len(raw) < len(GZIP_MAGIC):
                return
            at += len(raw) - len(GZIP_MAGIC) + 1
            continue
        at += found
        if at >= end:
            return
        got = inflate(read, at)
        parsed = parse(got[0]) if got else None
        if parsed is None:
            at += 1  # the magic's bytes inside a member's data
        else:
            yield parsed
            at = got[1]


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write all pages to WARC files under the shared folder; returns their manifest.

    Equal payloads of at least ``min_bytes`` bytes: the smallest id is the response, the others
    revisit it.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    repeated = (
        rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", "first")
    )
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    typed = rows.join(repeated, "digest", "left").select(
        "page_id", "url", "digest", F.octet_length("payload").cast("long").alias("size"),
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, F.col("first")).alias("refers_to"))
    folder = shared_path(pages.sparkSession, "warc")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        size = count = 0
        out = None
        for batch in slices(batches, "payload"):
            out = out or store.open_output_stream(f"{base}/{name}", compression=None)
            for row in batch.to_pylist():
                code = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                kind = "response" if row["refers_to"] is None else "revisit"
                data = member(record(row["page_id"], row["url"], kind, code, row["size"],
                                     row["payload"], row["refers_to"]))
                out.write(data)
                size += len(data)
                count += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{name}"]), pa.array([size]), pa.array([count])],
                names=["path", "size", "records"])

    return written(typed.mapInArrow(work, MANIFEST), "warc-manifest")


def read_archives(spark: SparkSession, manifest: DataFrame, range_bytes: int = RANGE_BYTES
                  ) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to,
    target_uri. A response's size and digest are those of the payload as read; a mismatch with
    its header fails the job."""
    last = F.greatest(F.lit(0), F.ceil(F.col("size") / range_bytes) - 1)
    ranges = manifest.select(
        "path", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("number"), "size")
    ranges = ranges.select(
        "path", (F.col("number").cast("long") * range_bytes).alias("start"),
        F.least(F.col("size"), (F.col("number").cast("long") + 1) * range_bytes).alias("end"))

    def page(name: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
        return int(found[1]) if found else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_store(row["path"])
                with store.open_input_file(path) as file:
                    size = file.size()

                    def read(at: int, n: int, file=file, size=size) -> bytes:
                        return file.read_at(min(n, size - at), at) if at < size else b""

                    out = []
                    for fields, block in records_in(read, row["start"], row["end"]):
                        head, _, body = block.partition(b"\r\n\r\n")
                        told = fields["warc-payload-digest"].removeprefix("sha1:")
                        length = int(re.search(rb"(?mi)^content-length: *(\d+)", head)[1])
                        kind = fields["warc-type"]
                        if kind == "response" and (len(body) != length or digest_of(body) != told):
                            raise ValueError(f"{path}: a payload differs from its record's header")
                        out.append((page(fields["warc-record-id"]), length, told, kind,
                                    page(fields.get("warc-refers-to")),
                                    fields.get("warc-target-uri")))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                columns = zip(*out) if out else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, kinds)],
                    names=[x.split()[0] for x in PAGES.split(", ")])

    dealt = ranges.repartition(shuffle_partitions(spark), "path", "start")
    return dealt.mapInArrow(work, PAGES)


def archived_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = 0,
                   range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write the pages to WARC files and read them back."""
    manifest = write_archives(pages, id_col, url_col, html_col, min_bytes)
    return read_archives(pages.sparkSession, manifest, range_bytes)
