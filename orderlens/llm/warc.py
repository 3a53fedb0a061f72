"""Pages as WARC archives: a deterministic sharded writer, and a reader that checks.

Records are sorted by page and cut into shards of about equal size at places that depend
on the data alone. Every shard is one task's work: it writes compressed records under a
temporary name, begins a new file when one is full, and renames complete files. What
counts is the manifest, a table with a row per file, which Spark commits once all tasks are
done; files that it doesn't name aren't part of the archive. A task that runs twice makes
the same files.
"""

from __future__ import annotations

import contextlib
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.llm.common import mapped
from orderlens.sources.scratch import run_folder, written

# Bytes of one shard (a task) before compression, compressed bytes at which a file is full, and
# about the bytes of a record's headers. A shard fills several files.
SHARD_BYTES = 32 * 1024 * 1024
FILE_BYTES = 2 * 1024 * 1024
HEADER_BYTES = 500
SLOTS_PER_SHARD = 16
# Slots whose sizes one task adds up.
SLOTS_PER_RANGE = 4096
LEAST_REVISITED = 100

# Lines and names of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


@dataclass(frozen=True)
class Archive:
    """A written archive: its folder and the manifest (shard, file, records, bytes, digest)."""

    folder: str
    manifest: DataFrame


def _record_id(page_id: int | None, digest: str) -> str:
    name = f"null:{digest}" if page_id is None else str(page_id)
    return f"<urn:page:{name}>"


def _clean(value: str | None) -> str:
    """A header value on one line."""
    return " ".join((value or "").split())


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
    is_revisit: bool,
) -> bytes:
    """One WARC record. A revisit has the headers of the page, but no payload."""
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if is_revisit else head + payload
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
    ]
    if is_revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}"]
        lines += [f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
    lines += [
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _filesystem(folder: str):
    """File system and path of a folder that all executors see."""
    if "://" in folder or folder.startswith("file:"):
        if folder.startswith("file:/") and not folder.startswith("file://"):
            folder = "file://" + folder[len("file:") :]
        return pyarrow.fs.FileSystem.from_uri(folder)
    return pyarrow.fs.LocalFileSystem(), folder


class _ShardWriter:
    """Rolling files of one shard."""

    def __init__(self, folder: str, shard: int, file_bytes: int):
        self.fs, self.folder = _filesystem(folder)
        self.shard, self.file_bytes = shard, file_bytes
        self.number, self.out = 0, None
        self.done: list[tuple] = []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"shard-{self.shard:08d}-{self.number:05d}.warc.gz"
            self.partial = f"{self.folder}/_partial-{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.partial)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
        member = gzip.compress(data, 6, mtime=0)
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.records += 1
        if self.size >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.fs.move(self.partial, f"{self.folder}/{self.name}")
        self.done.append((self.shard, self.name, self.records, self.size, self.sha.hexdigest()))
        self.out, self.number = None, self.number + 1

    def abandon(self) -> None:
        if self.out is not None:
            with contextlib.suppress(OSError):
                self.out.close()
                self.fs.delete_file(self.partial)


MANIFEST = "shard long, file string, records long, bytes long, digest string"


def _shards(folder: str, file_bytes: int):
    """Writes the sorted rows of a partition; yields a manifest row per file."""

    def listed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = ["shard", "file", "records", "bytes", "digest"]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, revisits = None, (None, None)
        try:
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                for shard, page, digest, is_page, refers_to, url, html in zip(
                    *columns, strict=True
                ):
                    if not is_page:
                        revisits = ((shard, page, digest), refers_to)
                        continue
                    if writer is None or writer.shard != shard:
                        if writer is not None:
                            writer.close()
                            yield listed(writer.done)
                        writer = _ShardWriter(folder, shard, file_bytes)
                    revisit = revisits[0] == (shard, page, digest)
                    first = revisits[1] if revisit else None
                    writer.add(record(page, url, (html or "").encode(), digest, first, revisit))
            if writer is not None:
                writer.close()
                yield listed(writer.done)
        except BaseException:
            if writer is not None:
                writer.abandon()
            raise

    return work


def _known(pages: DataFrame) -> DataFrame:
    """Pages with the digest of their payload and a number that tells rows of a slot apart."""
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumns(
        {"digest": F.sha2("html", 256), "spread": F.xxhash64("url", F.sha2("html", 256))}
    )


def revisits(headers: DataFrame, least: int = LEAST_REVISITED) -> DataFrame:
    """The rows of ``headers`` (page_id, digest, payload_bytes, ...) that revisit an earlier
    page, with ``refers_to``. Of equal payloads of at least ``least`` bytes the smallest
    page_id is the response, also if it is there more than once; null ids come last."""
    first = (
        headers.filter(F.col("payload_bytes") >= least)
        .groupBy(F.col("digest").alias("_d"))
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1 AND refers_to IS NOT NULL")
        .drop("_n")
    )
    later = (F.col("digest") == F.col("_d")) & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return headers.join(first, later).drop("_d")


def _shard_places(headers: DataFrame, shard_bytes: int) -> tuple[DataFrame, Column, int]:
    """Where slots begin: (_slot, _at, _parts), the slot of a page, and the number of shards.
    The range of the ids is divided into slots of equal width; slots are filled into shards
    in their order, and a slot of more than a shard's bytes is divided by a hash of its
    rows. All of this depends on the rows alone."""
    size = F.col("payload_bytes") + HEADER_BYTES
    span = headers.agg(
        F.sum(size).alias("bytes"), F.min("page_id").alias("low"),
        F.max("page_id").alias("high"),
    ).first()
    shards = max(1, -(-(span["bytes"] or 0) // shard_bytes))
    low, high = span["low"] or 0, span["high"] or 0
    width = max(1, -(-(high - low + 1) // (shards * SLOTS_PER_SHARD)))
    slot = F.coalesce(F.floor((F.col("page_id") - low) / width), F.lit(-1)).cast("long")
    # One row per slot: a shard's worth of pages has sixteen of them.
    sizes = headers.groupBy(slot.alias("_slot")).agg(F.sum(size).alias("size"))
    sizes = written(
        sizes.withColumn("_range", F.floor(F.col("_slot") / SLOTS_PER_RANGE)), "sizes"
    )
    # What precedes a slot: the ranges of slots before its own (one row each), and the slots
    # before it in its range.
    ranges = sizes.groupBy("_range").agg(F.sum("size").alias("_of_range")).select(
        F.col("_range").alias("_r"),
        F.coalesce(
            F.sum("_of_range").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_ranges_before"),
    )
    until = W.partitionBy("_range").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(until), F.lit(0)) + F.col("_ranges_before")
    places = sizes.join(ranges, F.col("_range") == F.col("_r")).select(
        "_slot",
        F.floor(before / shard_bytes).alias("_at"),
        F.greatest(F.ceil(F.col("size") / shard_bytes), F.lit(1)).alias("_parts"),
    )
    return written(places, "slots"), slot, shards


def write_archive(
    pages: DataFrame,
    folder: str,
    least: int = LEAST_REVISITED,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
) -> Archive:
    """Write a record per row of ``pages`` (page_id, url, html) below ``folder``, which must be
    new and seen by all executors (a path or URI that pyarrow opens).

    A null page is an empty payload, a null URL an empty one; null ids go to a shard of
    their own range; repeated rows are repeated records; other columns are ignored. An
    empty table gives an archive without files. Runs jobs.
    """
    fs, path = _filesystem(folder)
    fs.create_dir(path, recursive=True)
    known = _known(pages)
    headers = written(
        known.select("page_id", "digest", "spread",
                     F.octet_length("html").cast("long").alias("payload_bytes")),
        "headers",
    )
    places, slot, shards = _shard_places(headers, shard_bytes)

    def in_shards(rows: DataFrame) -> DataFrame:
        part = F.pmod(F.col("spread"), F.col("_parts"))
        rows = rows.join(places, slot == F.col("_slot"))
        return rows.withColumn("shard", (F.col("_at") + part).cast("long"))

    # Payloads are shuffled once: what a page revisits comes to it as a row of its own, just
    # before it, instead of by a join.
    columns = ["shard", "page_id", "digest", "is_page", "refers_to", "url", "html"]
    wide = known.withColumns({"is_page": F.lit(True), "refers_to": F.lit(None).cast("long")})
    narrow = revisits(headers, least).withColumns(
        {"is_page": F.lit(False), "url": F.lit(None).cast("string"),
         "html": F.lit(None).cast("string")}
    )
    placed = (
        in_shards(wide).select(*columns).unionByName(in_shards(narrow).select(*columns))
        .repartitionById(shards, F.pmod("shard", F.lit(shards)).cast("int"))
        .sortWithinPartitions("shard", "page_id", "digest", "is_page", "url")
    )
    manifest = written(mapped(placed, _shards(folder, file_bytes), MANIFEST), "manifest")
    return Archive(folder, manifest)


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an uncompressed archive."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]):
            raise ValueError("a record ends early")
        yield headers, block


def _page_of(record_id: str) -> int | None:
    name = record_id.strip("<>").removeprefix("urn:page:")
    return None if name.startswith("null") else int(name)


RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "url string, html string, file string"
)


def _read(folder: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _filesystem(folder)
        names = [part.split()[0] for part in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
                 pa.string(), pa.string()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names
            )

        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{path}/{file}", compression=None) as raw:
                    with gzip.GzipFile(fileobj=raw) as plain:
                        for headers, block in parse(io.BufferedReader(plain)):
                            rows.append(_row(headers, block, file))
                            size += len(block)
                            if len(rows) >= 500 or size >= 16_000_000:
                                yield batch_of(rows)
                                rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return work


def _row(headers: dict[str, str], block: bytes, file: str) -> tuple:
    if headers["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"{file}: the block of {headers['warc-record-id']} is damaged")
    head, _, payload = block.partition(b"\r\n\r\n")
    length = next(
        int(line.partition(b":")[2])
        for line in head.split(b"\r\n")
        if line.lower().startswith(b"content-length:")
    )
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    revisit = headers["warc-type"] == "revisit"
    if not revisit and (len(payload), hashlib.sha256(payload).hexdigest()) != (length, digest):
        raise ValueError(f"{file}: the payload of {headers['warc-record-id']} is damaged")
    refers_to = _page_of(headers["warc-refers-to"]) if revisit else None
    return (
        _page_of(headers["warc-record-id"]), length, digest, headers["warc-type"], refers_to,
        headers["warc-target-uri"], None if revisit else payload.decode(), file,
    )


def read_archive(archive: Archive) -> DataFrame:
    """A row per record of the files in the manifest, with digests checked: page_id,
    payload_bytes, payload_digest, record_type, refers_to, url, html (null for revisits),
    file. A damaged record ends the job. Files are read as streams, one per task."""
    files = archive.manifest.select("file")
    count = max(1, files.count())
    return mapped(files.repartition(count, "file"), _read(archive.folder), RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` into the shared folder and read them back."""
    return read_archive(write_archive(pages, run_folder(spark, "warc")))
