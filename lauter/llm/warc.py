"""WARC archives: a deterministic sharded writer and a reader.

Writing: payload digests meet once, combined before the shuffle, to find which record is
the response that equal ones refer to. Records are cut into shards of about equal payload
by ranges of their id, sorted within, and each task streams its shards to disk. A shard
rolls to another file when the compressed file reaches ``file_bytes``. Headers, record ids
and digests are made anew from the rows; nothing in a file depends on time, task or
attempt, so a task that runs again writes the same bytes.

Commit: a file is written under a temporary name of its own attempt and moved to its final
name when closed; the manifest is a table written last, by Spark's committer. Readers open
only what the manifest lists, so files of a failed run are never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lauter.llm.common import text_or_empty, written

FILE_BYTES = 16 << 20
SHARD_BYTES = 32 << 20
CELLS = 65_536
DATE = "1970-01-01T00:00:00Z"  # no time of writing: archives are the same whenever made
LEVEL = 6
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: object, copy: int) -> str:
    """Stable for a page; ``copy`` counts rows of the same id."""
    return f"<urn:page:{'none' if page is None else page}:{copy}>"


def page_of(urn: str) -> int | None:
    name = urn.strip("<>").split(":")[2]
    return None if name == "none" else int(name)


def record(page, url: str | None, payload: bytes, refers_to, revisit: bool, copy: int = 0) -> bytes:
    """One WARC record, not yet compressed.

    The block is an HTTP response. A revisit has its headers only, which keep the length
    of the payload that it refers to.
    """
    sha = digest32(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page, copy)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or 'about:blank', safe=':/?#[]@!$&()*+,;=%~')}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"WARC-Block-Digest: sha1:{digest32(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to, 0)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def files_at(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, as any worker opens it."""
    if "://" in path or path.startswith("file:"):
        scheme, _, rest = path.partition(":")
        if scheme == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class ShardWriter:
    """Files of one shard; a record is a gzip member of its own."""

    def __init__(self, path: str, shard: int, file_bytes: int, attempt: str):
        self.store, self.base = files_at(path)
        self.shard, self.file_bytes, self.attempt = shard, file_bytes, attempt
        self.number, self.sink = 0, None
        self.done: list[tuple] = []

    def add(self, data: bytes) -> None:
        member = gzip.compress(data, LEVEL, mtime=0)
        if self.sink and self.held + len(member) > self.file_bytes:
            self.close()
        if not self.sink:
            self.name = f"shard-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.base}/_tmp-{self.attempt}-{self.name}"
            self.sink = self.store.open_output_stream(self.temporary, compression=None)
            self.held, self.records, self.sha = 0, 0, hashlib.sha1()
        self.sink.write(member)
        self.sha.update(member)
        self.held += len(member)
        self.records += 1

    def close(self) -> None:
        if self.sink:
            self.sink.close()
            self.store.move(self.temporary, f"{self.base}/{self.name}")
            self.done.append((self.name, self.shard, self.records, self.held, self.sha.hexdigest()))
            self.sink, self.number = None, self.number + 1


_MANIFEST = pa.schema(
    [("file", pa.string()), ("shard", pa.int64()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())]
)
_MANIFEST_SQL = "file string, shard long, records long, bytes long, sha1 string"


def _shards(rows: DataFrame, shard_bytes: int) -> Callable[[DataFrame], DataFrame]:
    """Adds ``shard`` to a frame: ranges of ids of about ``shard_bytes`` payload each.

    Ids are counted in at most ``CELLS`` equal cells between the smallest and the largest
    (null is the first), so the cut depends on ``rows`` alone, not on how they lie.
    """
    ends = rows.select(F.min("page").alias("low"), F.max("page").alias("high"))
    wide = "greatest(cast(high as decimal(20)) - low + 1, 1)"
    cell = F.expr(f"coalesce(cast(floor(({CELLS} - 1) * ((cast(page as decimal(20)) - low) / {wide})) + 1 as int), 0)")

    def celled(frame: DataFrame) -> DataFrame:
        return frame.crossJoin(F.broadcast(ends)).withColumn("cell", cell).drop("low", "high")  # one row

    cells = celled(rows).groupBy("cell").agg(F.sum("size").alias("held"))
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("held").over(upto) - F.col("held")
    cells = written(cells.select("cell", F.floor(before / shard_bytes).cast("long").alias("shard")), "shards")
    # at most CELLS + 1 rows
    return lambda frame: celled(frame).join(F.broadcast(cells), "cell").drop("cell")


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    *,
    least: int = 0,
    file_bytes: int = FILE_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write a record per row below ``path``, which all executors reach; returns the manifest.

    Null payload counts as empty, null url as ``about:blank``, a null id sorts first. Of
    equal payloads of at least ``least`` bytes the one with the smallest id is the
    response and the others revisit it; of several rows of that id the first in order of
    url is. An empty table makes an empty manifest. Other columns are not written.
    """
    payload = F.encode(text_or_empty(F.col(payload_col)), "UTF-8")
    plain = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    )
    keyed = plain.select("page", "url", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size"))
    keyed = written(keyed.withColumn("size", F.col("size").cast("long")), "payload-digests")
    firsts = keyed.where(F.col("size") >= least).groupBy("sha", "size").agg(
        F.min(F.struct(F.coalesce("page", F.lit(-(2**63))), "page", F.coalesce("url", F.lit("")))).alias("first"),
        F.count("*").alias("same"),
    )
    firsts = firsts.where("same > 1").select("sha", "size", F.col("first.page").alias("refers_to"))
    sharded = _shards(keyed, shard_bytes)
    # payloads travel once, to their shard; what is decided about those that occur more than
    # once travels beside them and is read just before
    none = F.lit(None)
    decisions = keyed.join(firsts, ["sha", "size"]).select(
        "page", "url", none.cast("binary").alias("payload"), "sha", "refers_to", F.lit(True).alias("found")
    )
    payloads = plain.select(
        "page", "url", "payload", F.sha1("payload").alias("sha"), none.cast("long").alias("refers_to"), F.lit(False).alias("found")
    )
    ready = sharded(decisions.unionAll(payloads))
    # a shard lies in one task; within it records are in order
    sort = ["shard", F.col("page").asc_nulls_first(), F.col("url").asc_nulls_first(), "sha", F.desc("found")]
    ordered = ready.select("shard", "page", "url", "payload", "refers_to", "found", "sha")
    ordered = ordered.repartitionByRange("shard").sortWithinPartitions(*sort)

    store, base = files_at(path)
    store.create_dir(base, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        writer, before, copy = None, object(), 0
        decided, first = None, None
        started: set[str] = set()
        done: list[tuple] = []
        for batch in batches:
            for shard, page, url, payload, refers_to, found, sha in zip(*batch.columns, strict=True):
                shard, page, sha, url = shard.as_py(), page.as_py(), sha.as_py(), url.as_py()
                if found.as_py():
                    decided, first = (page, url, sha), refers_to.as_py()
                    continue
                repeated = decided == (page, url, sha)
                if writer is None or writer.shard != shard:
                    if writer:
                        writer.close()
                        done += writer.done
                    writer = ShardWriter(path, shard, file_bytes, attempt)
                copy = copy + 1 if before == page else 0
                if before != page:
                    before, started = page, set()
                revisit = repeated and (first != page or sha in started)
                if repeated:
                    started.add(sha)  # of repeated ids the first is the response
                writer.add(record(page, url, payload.as_py(), first if repeated else None, revisit, copy))
        if writer:
            writer.close()
            done += writer.done
        yield pa.RecordBatch.from_pylist([dict(zip(_MANIFEST.names, d, strict=True)) for d in done], schema=_MANIFEST)

    ordered.mapInArrow(write, _MANIFEST_SQL).write.parquet(f"{path}/manifest.parquet")
    return pages.sparkSession.read.parquet(f"{path}/manifest.parquet")


def records_of(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where it should")
        yield headers, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload``.

    Files are those of the manifest, each read as a stream by one task. Digests are
    computed from what was read and compared with the headers; a difference is an error.
    A revisit's payload is null, its length and digest are those it refers to.
    """
    manifest = spark.read.parquet(f"{path}/manifest.parquet").select("file")
    # a file is at most FILE_BYTES, or one record
    spread = manifest.repartition(max(1, spark.sparkContext.defaultParallelism))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = files_at(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{base}/{name}", compression=None) as raw, gzip.open(raw) as stream:
                    rows, held = [], 0
                    for headers, block in records_of(stream):
                        rows.append(_row(headers, block))
                        held += len(block)
                        if held > 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)

    return spread.mapInArrow(read, _ROWS_SQL)


_ROWS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])
_ROWS_SQL = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)


def _row(headers: dict[str, str], block: bytes) -> dict:
    if headers["WARC-Block-Digest"] != "sha1:" + digest32(block):
        raise ValueError(f"{headers['WARC-Record-ID']}: the block is not what its digest says")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    revisit = headers["WARC-Type"] == "revisit"
    sha = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != length or digest32(payload) != sha):
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload is not what its digest says")
    return {
        "page_id": page_of(headers["WARC-Record-ID"]),
        "url": headers["WARC-Target-URI"],
        "payload_bytes": length,
        "payload_digest": sha,
        "record_type": headers["WARC-Type"],
        "refers_to": page_of(headers["WARC-Refers-To"]) if revisit else None,
        "payload": None if revisit else payload,
    }
