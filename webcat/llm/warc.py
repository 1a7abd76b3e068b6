"""Deterministic sharded WARC archives of pages, written and read back.

Pages are cut into shards by id, at bounds that follow from the bytes per range of ids, sorted within them and written
as one gzip member per record, rolling to a new file by compressed size. Headers and digests are
made anew from the payload. Of pages with equal payloads of ``REVISIT`` bytes or more the one with the largest id is the
response and the others revisit it. A task writes files under temporary names and returns their names; only what
finished tasks returned is moved to its final name and listed in the manifest, which is what readers follow.

Cases: a null payload is an empty one. A null id comes first; it never is the response of a group unless all ids are null,
and then all are responses. Rows that share id and payload are one page: all of them are responses or all revisits.
Line ends and other control characters in URLs are percent-encoded. An empty table gives an empty archive.
The output folder must be reachable from all executors. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from base64 import b16encode, b32decode, b32encode
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcat.llm.common import checked_broadcast, has_rows, parallelism, saved, slices, text_or_empty

REVISIT = 1000
ROLL_BYTES = 16 << 20
SHARD_BYTES = 32 << 20
#: Ranges of ids whose bytes are summed to place the shards; so many rows come to the driver at most.
RANGES = 1 << 14
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, temporary string, records long, bytes long, sha1 string"


def record_id(ident: int | None, digest: str) -> str:
    return f"<urn:page:{'' if ident is None else ident}:{digest}>"


def _member(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    sha = b32encode(hashlib.sha1(block).digest()).decode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}", *(f"{k}: {v}" for k, v in headers),
             f"WARC-Block-Digest: sha1:{sha}", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # the gzip header it writes holds no time
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(ident: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    raw = hashlib.sha1(payload).digest()
    digest = raw.hex()
    target = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:page:{'' if ident is None else ident}"
    headers = [("WARC-Record-ID", record_id(ident, digest)), ("WARC-Target-URI", target),
               ("WARC-Payload-Digest", "sha1:" + b32encode(raw).decode()), ("Content-Type", "application/http; msgtype=response")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return _member("response", headers, http + payload)
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("WARC-Refers-To-Date", DATE)]
    return _member("revisit", headers, http)


class _Files:
    """The files that one task writes, one after the other."""

    def __init__(self, out: str, roll: int) -> None:
        self.fs, root = pyarrow.fs.FileSystem.from_uri(out)
        context = TaskContext.get()
        self.folder = f"{root}/_temporary/{context.taskAttemptId() if context else 0}-{uuid.uuid4().hex}"
        self.roll, self.stream = roll, None
        self.fs.create_dir(self.folder, recursive=True)

    def open(self, shard: int, number: int) -> None:
        self.name = f"part-{shard:05d}-{number:05d}.warc.gz"
        self.shard, self.number, self.records, self.bytes, self.sha = shard, number, 0, 0, hashlib.sha1()
        self.stream = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        head = [("WARC-Record-ID", f"<urn:archive:{self.name}>"), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
        self._put(_member("warcinfo", head, b"format: WARC File Format 1.1\r\n"))

    def _put(self, member: bytes) -> None:
        self.stream.write(member)
        self.sha.update(member)
        self.bytes += len(member)

    def close(self) -> list[tuple]:
        if self.stream is None:
            return []
        self.stream.close()
        self.stream = None
        return [(self.name, f"{self.folder}/{self.name}", self.records, self.bytes, self.sha.hexdigest())]

    def add(self, shard: int, member: bytes) -> list[tuple]:
        done = []
        if self.stream is None or shard != self.shard:
            done = self.close()
            self.open(shard, 0)
        elif self.records and self.bytes + len(member) > self.roll:
            done = self.close()
            self.open(shard, self.number + 1)
        self._put(member)
        self.records += 1
        return done


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    names = ["file", "temporary", "records", "bytes", "sha1"]
    schema = pa.schema([(n, pa.int64() if n in ("records", "bytes") else pa.string()) for n in names])
    return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=schema)


def _writer(out: str, roll: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, known = None, None
        for batch in slices(batches, -1):
            files = files or _Files(out, roll)
            done = []
            for r in batch.to_pylist():
                key = (r["shard"], r["id"], r["digest"])
                if r["kind"] == 0:  # says what the pages of this key refer to
                    known = (key, r["refers_to"])
                    continue
                refers_to = known[1] if known and known[0] == key else None
                done += files.add(r["shard"], page_record(r["id"], r["url"], r["payload"].encode("utf-8"), refers_to))
            yield _manifest(done)
        if files:
            yield _manifest(files.close())

    return run


def _mover(out: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(out)
        for batch in batches:
            for r in batch.to_pylist():
                final = f"{root}/archive/{r['file']}"
                there = fs.get_file_info([r["temporary"], final])
                if there[0].type != pyarrow.fs.FileType.NotFound:
                    fs.move(r["temporary"], final)
                elif there[1].type == pyarrow.fs.FileType.NotFound or there[1].size != r["bytes"]:
                    raise OSError(f"{r['file']} is neither written nor committed")  # a repeated task finds it moved
            yield batch

    return run


def write_archives(
    pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write ``pages`` below the new folder ``out``; returns the manifest (also written there), a row per file."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), text_or_empty(payload_col).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    size = F.octet_length("payload")
    groups = rows.filter(size >= REVISIT).groupBy("digest").agg(F.max("id").alias("refers_to"), F.count("*").alias("n"))
    groups = saved(groups.filter("n > 1 AND refers_to IS NOT NULL").select("digest", "refers_to"), "payloads")
    revisits = rows.filter(size >= REVISIT).select("id", "digest").join(checked_broadcast(groups, 120), "digest")
    revisits = revisits.filter(~F.col("id").eqNullSafe(F.col("refers_to")))

    ends = rows.agg(F.min("id").alias("a"), F.max("id").alias("b")).first()
    low, high = (ends["a"] or 0), (ends["b"] or 0)
    width = (high - low) // RANGES + 1
    place = F.coalesce(F.floor((F.col("id") - F.lit(low)) / F.lit(width)).cast("int"), F.lit(0))
    sums = rows.groupBy(place.alias("place")).agg(F.sum(size.cast("long") + 500).alias("bytes")).orderBy("place").collect()
    shard, filled, shards = 0, 0, []
    for r in sums:
        if filled and filled + r["bytes"] > shard_bytes:
            shard, filled = shard + 1, 0
        filled += r["bytes"]
        shards.append((r["place"], shard))
    spark = pages.sparkSession
    shards = F.broadcast(spark.createDataFrame(shards, "place int, shard int"))  # RANGES rows at most
    everything = rows.select("id", "digest", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers_to"), "url", "payload").union(
        revisits.select("id", "digest", F.lit(0), "refers_to", F.lit(None).cast("string"), F.lit(None).cast("string")))
    dealt = everything.withColumn("place", place).join(shards, "place").select("shard", "id", "digest", "kind", "refers_to", "url", "payload")
    dealt = dealt.repartition(parallelism(pages), "shard").sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "digest", "kind", "url")
    written = saved(dealt.mapInArrow(_writer(out, roll_bytes), MANIFEST), "written")
    fs, root = pyarrow.fs.FileSystem.from_uri(out)
    fs.create_dir(f"{root}/archive", recursive=True)
    written.mapInArrow(_mover(out), MANIFEST).select("file", "records", "bytes", "sha1").write.parquet(f"{out}/manifest")
    return spark.read.parquet(f"{out}/manifest")


RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload string"
_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string())])


def _members(content: memoryview) -> Iterator[bytes]:
    at = 0
    while at < len(content):
        packed, parts = zlib.decompressobj(31), []
        while not packed.eof:
            if at >= len(content):
                raise ValueError("an archive ends within a record")
            piece = content[at: at + (1 << 16)]
            parts.append(packed.decompress(piece))
            at += len(piece) - len(packed.unused_data)
        yield b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def parse_record(member: bytes) -> dict | None:
    """The page that a record holds; None for the file's own record. Digests are checked."""
    head, _, rest = member.partition(b"\r\n\r\n")
    warc = _fields(head)
    block = rest[: int(warc["Content-Length"])]
    if warc["WARC-Block-Digest"] != "sha1:" + b32encode(hashlib.sha1(block).digest()).decode():
        raise ValueError(f"the block of {warc['WARC-Record-ID']} does not have its digest")
    if warc["WARC-Type"] == "warcinfo":
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = b16encode(b32decode(warc["WARC-Payload-Digest"][5:])).decode().lower()
    response = warc["WARC-Type"] == "response"
    if response and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {warc['WARC-Record-ID']} does not have its digest")
    own, other = (re.match(r"<urn:page:(-?\d*):", warc.get(k, "")) for k in ("WARC-Record-ID", "WARC-Refers-To"))
    return {
        "page_id": int(own[1]) if own[1] else None, "url": warc["WARC-Target-URI"], "record_type": warc["WARC-Type"],
        "payload_bytes": int(_fields(http)["Content-Length"]), "payload_digest": digest,
        "refers_to": int(other[1]) if other else None, "payload": payload.decode("utf-8") if response else None,
    }


def _parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            rows, held = [], 0
            for member in _members(memoryview(content.as_buffer())):
                row = parse_record(member)
                if row:
                    rows.append(row)
                    held += row["payload_bytes"]
                if held > 4 << 20 or len(rows) >= 2000:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def read_archives(spark: SparkSession, out: str) -> DataFrame:
    """A row per record of the files that the manifest lists: ``RECORDS``; revisits have no payload of their own."""
    manifest = spark.read.parquet(f"{out}/manifest")
    if not has_rows(manifest):
        return spark.createDataFrame([], RECORDS)
    files = spark.read.format("binaryFile").load(f"{out}/archive").withColumn("file", F.regexp_extract("path", "[^/]+$", 0))
    listed = checked_broadcast(manifest.select("file"), 100)
    return files.join(listed, "file", "left_semi").select("content").mapInArrow(_parse, RECORDS)
