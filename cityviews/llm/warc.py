"""WARC archives: a sharded writer whose files do not depend on how Spark ran, and a reader.

Of pages with equal payloads of ``REPEATS`` bytes or more, the one with the least ``page_id`` is a
response and the others revisit it. Every record is a gzip member of its own. Records are sorted
by ``page_id``, then digest and url; a file begins where the compressed bytes before it reach the
next multiple of the file size, so the files' bytes follow from the pages alone. Pages of one id,
or without one, are spread over files like others, as far as their payloads differ.

A task writes each file under a temporary name and renames it when it is whole; a file counts only
if the manifest, which Spark commits last, names it. A task that runs again writes the same bytes.

Null html is an empty payload, a null url is left out. Pages with a null id come first; such a
page revisits like others. Rows with one id and one payload are all responses.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import uuid
import zlib
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityviews.llm.common import before, by_bytes, place, saved
from cityviews.sinks.workdir import work_folder

REPEATS = 100            # bytes from which equal payloads are stored once
LEAST = 16 << 20         # compressed size at which a file is full: at least, and
MOST = 1 << 30           # at most
LEVEL = 4                # of gzip
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 20

MANIFEST = "name string, records bigint, bytes bigint, digest string"


def _record(page, url, n, digest, refers_to, revisit, payload: bytes) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n"
            ).encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:page:{_name(page)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{_name(refers_to)}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}",
              f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
              "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return gzip.compress(head + block + b"\r\n\r\n", LEVEL, mtime=0)


def _name(page) -> str:
    return "null" if page is None else str(page)


def _facts(pages: DataFrame) -> DataFrame:
    """A narrow row per page: what decides on its record, and the compressed size as a response."""

    def measured(batches):
        for batch in by_bytes(batches, "html"):
            out = []
            for page, url, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                payload = (text or "").encode()
                digest = hashlib.sha256(payload).hexdigest()
                size = len(_record(page, url, len(payload), digest, None, False, payload))
                out.append((page, url, len(payload), digest, size))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate(
                    (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                ["page_id", "url", "payload_bytes", "payload_digest", "size"])

    return _plain(pages).mapInArrow(
        measured, "page_id bigint, url string, payload_bytes bigint, payload_digest string, size bigint")


def _plain(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))


def _settled(facts: DataFrame) -> DataFrame:
    """``facts`` with ``refers_to`` and ``revisit``, and the sizes of revisits."""
    heads = facts.where(F.col("payload_bytes") >= REPEATS).groupBy("payload_digest").agg(
        F.count("*").alias("_c"), F.min("page_id").alias("head")).where("_c > 1")
    rows = facts.join(heads, "payload_digest", "left").withColumn(
        "revisit", F.col("_c").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head")))
    rows = rows.withColumn("refers_to", F.when(F.col("revisit"), F.col("head")))
    names = ("page_id", "url", "payload_bytes", "payload_digest", "refers_to", "revisit", "size")

    def sized(batches):
        for batch in batches:
            sizes = batch.column("size").to_pylist()
            for i in np.flatnonzero(batch.column("revisit").to_numpy(zero_copy_only=False)).tolist():
                sizes[i] = len(_record(*(batch.column(k)[i].as_py() for k in names[:-1]), b""))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in names[:-1]), pa.array(sizes, pa.int64())], list(names))

    return rows.select(*names).mapInArrow(
        sized, "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
        "refers_to bigint, revisit boolean, size bigint").drop("url", "payload_bytes")


def write_archives(pages: DataFrame, folder: str, file_bytes: int | None = None) -> DataFrame:
    """Write ``pages(page_id, url, html)`` below ``folder``; returns the manifest.

    Without ``file_bytes`` a file has a thousandth of all bytes, but neither less than ``LEAST`` nor
    more than ``MOST``. Narrow rows alone decide where files begin; the html is shuffled once.
    """
    spark = pages.sparkSession
    order = ["page_id", "payload_digest", "size"]
    rows = _settled(saved(_facts(pages), "facts")).repartitionByRange(*order).withColumn(
        "part", F.spark_partition_id())
    rows = saved(rows, "sizes")
    if file_bytes is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        file_bytes = min(MOST, max(LEAST, total // 1000))
    placed = before(rows, [], "part", [F.col(c) for c in order], F.col("size"), "_at")
    cuts = work_folder(spark, "cuts")
    placed.groupBy(F.floor(F.col("_at") / file_bytes).alias("file")).agg(F.min(F.struct(
        F.col("page_id").isNotNull().alias("known"), F.coalesce("page_id", F.lit(0)).alias("page_id"),
        "payload_digest")).alias("first")).select("first.*", "file").write.parquet(cuts)
    files = max(1, spark.read.parquet(cuts).count())

    def numbered(batches):
        system, path = place(cuts)
        first = pq.read_table(path, filesystem=system)  # a row per file, read by each task
        first = sorted(zip(*(first.column(k).to_pylist() for k in ("known", "page_id", "payload_digest", "file"))))
        starts, numbers = [x[:3] for x in first], [x[3] for x in first]
        for batch in by_bytes(batches, "html"):
            ids = batch.column("page_id").to_pylist()
            digests = [d or hashlib.sha256((x or "").encode()).hexdigest() for d, x in zip(
                batch.column("payload_digest").to_pylist(), batch.column("html").to_pylist())]
            at = [max(0, bisect.bisect_right(starts, (i is not None, i or 0, d)) - 1) for i, d in zip(ids, digests)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array([numbers[k] for k in at], pa.int64()), batch.column("page_id"),
                 pa.array(digests, pa.string()), batch.column("refers_to"), batch.column("url"), batch.column("html")],
                ["place", "file", "page_id", "payload_digest", "refers_to", "url", "html"])

    none = F.lit(None).cast("string")
    # the plan of a revisit comes before the page itself
    plans = rows.where("revisit").select(
        "page_id", "payload_digest", "refers_to", none.alias("url"), none.alias("html")).distinct()
    whole = _plain(pages).select(
        "page_id", none.alias("payload_digest"), F.lit(None).cast("bigint").alias("refers_to"), "url", "html")
    sent = plans.unionByName(whole).mapInArrow(
        numbered, "place int, file bigint, page_id bigint, payload_digest string, refers_to bigint, url string, html string")
    sent = sent.repartitionById(files, F.col("place")).sortWithinPartitions(
        "file", "page_id", "payload_digest", F.col("refers_to").isNull(), "url")

    def written(batches):
        done, writer, plan = [], None, None
        for batch in by_bytes(batches, "html"):
            for file, page, digest, refers_to, url, text in zip(*(batch.column(k).to_pylist() for k in (
                    "file", "page_id", "payload_digest", "refers_to", "url", "html"))):
                if refers_to is not None:
                    plan = page, digest, refers_to
                    continue
                payload = (text or "").encode()
                revisit = plan is not None and plan[:2] == (page, digest)
                member = _record(page, url, len(payload), digest, plan[2] if revisit else None, revisit, payload)
                if writer is None or writer.number != file or writer.size >= 2 * file_bytes:
                    part = 0
                    if writer is not None:
                        part = writer.part + 1 if writer.number == file else 0
                        done.append(writer.close())
                    writer = _File(folder, file, part)
                writer.add(member)
        if writer is not None:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in done], t) for i, t in enumerate(
                (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["name", "records", "bytes", "digest"])

    sent.mapInArrow(written, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


class _File:
    """One archive, under a temporary name until it is closed."""

    def __init__(self, folder: str, number: int, part: int):
        self.system, self.folder = place(folder)
        self.number, self.part, self.size, self.records = number, part, 0, 0
        self.name = f"pages-{number + 1:08d}-{part:04d}.warc.gz"
        self.temporary = f"{self.folder}/_tmp/{self.name}.{uuid.uuid4().hex}"
        self.system.create_dir(f"{self.folder}/_tmp", recursive=True)
        self.digest = hashlib.sha256()
        self.out = self.system.open_output_stream(self.temporary, compression=None)

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.digest.update(member)
        self.size += len(member)
        self.records += 1

    def close(self):
        self.out.close()
        self.system.move(self.temporary, f"{self.folder}/{self.name}")
        return self.name, self.records, self.size, self.digest.hexdigest()


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record of the archives that the manifest of ``folder`` names.

    Payload digests of responses are taken from the bytes read, and must agree with the headers.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("name", "bytes")
    files = max(1, manifest.count())

    def read(batches):
        system, path = place(folder)
        for batch in batches:
            for name, size in zip(batch.column("name").to_pylist(), batch.column("bytes").to_pylist()):
                out = []
                with system.open_input_stream(f"{path}/{name}", compression=None) as f:
                    for record in _records(f, name, size):
                        out.append(_parsed(record))
                        if len(out) == 1000:
                            yield _rows(out)
                            out = []
                yield _rows(out)

    return manifest.repartition(min(files, 10_000)).mapInArrow(
        read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def _rows(out) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)],
        ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def _records(f, name: str, size: int):
    """The records of an archive, one member after another."""
    read, member, parts = 0, None, []
    data = f.read(CHUNK)
    while data:
        read += len(data)
        while data:
            member = member or zlib.decompressobj(wbits=31)
            parts.append(member.decompress(data))
            data = b""
            if member.eof:
                data, member = member.unused_data, None
                yield b"".join(parts)
                parts = []
        data = f.read(CHUNK)
    if member is not None or read != size:
        raise ValueError(f"{name} is cut off: {read} of {size} bytes")


def _parsed(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"{fields['WARC-Record-ID']}: the block doesn't have the digest of its header")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response":
        n = len(payload)
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"{fields['WARC-Record-ID']}: the payload doesn't have the digest of its header")
    else:
        n = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    return _id(fields["WARC-Record-ID"]), n, digest, kind, _id(fields.get("WARC-Refers-To"))


def _id(name: str | None):
    if name is None or name == "<urn:page:null>":
        return None
    return int(name.removeprefix("<urn:page:").removesuffix(">"))
