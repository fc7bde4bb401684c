"""Writing and reading WARC archives.

Records are sorted by range, so that a rerun deals the same records to the same task; a task rolls
its files by compressed size. A file is written under a temporary name and then renamed, a manifest
with one line a file is written last, and readers open only what the manifest lists: tasks that run
twice or die leave nothing that is read.
"""

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studymart.session import materialise

#: Compressed bytes after which a task begins a new file.
ROLL_BYTES = 64 << 20
#: Uncompressed payload that one range of the sort is meant to hold.
RANGE_BYTES = 64 << 20
#: Shorter payloads are never revisits.
LEAST_REVISIT = 100
LEVEL = 3
#: All records carry it: archives of equal input are equal byte for byte.
DATE = "1970-01-01T00:00:00Z"

MANIFEST = "file string, records long, bytes long, sha256 string"
_MANIFEST = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
RECORD = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"
_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
    ]
)
_BREAK = b"\r\n\r\n"


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all executors reach, and the folder's path in it."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to); revisits have no payload.

    Only digests are grouped; the payload isn't shuffled for it. Digests of which there is one page
    take no part in the join.
    """
    body = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha2(body, 256).alias("payload_digest"),
    )
    long = rows.filter(F.col("payload_bytes") >= LEAST_REVISIT)
    shared = long.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    shared = materialise(shared.select(F.col("payload_digest").alias("digest"), "first"), "warc_shared")
    match = (rows["payload_digest"] == shared["digest"]) & (rows["payload_bytes"] >= LEAST_REVISIT)
    refers = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    return rows.join(shared, match, "left").select(
        "page_id",
        "url",
        F.when(refers.isNull(), F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        refers.alias("refers_to"),
    )


def _clean(value: str) -> str:
    return value.replace("\\", "\\\\").replace("\r", "\\r").replace("\n", "\\n")


def _dirty(value: str) -> str:
    out, i = [], 0
    while i < len(value):
        pair = value[i : i + 2]
        out.append({"\\\\": "\\", "\\r": "\r", "\\n": "\n"}.get(pair, value[i]))
        i += 2 if pair in ("\\\\", "\\r", "\\n") else 1
    return "".join(out)


def record_bytes(page: int | None, url: str, payload: bytes | None, size: int, digest: str, refers: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    named = {
        "WARC-Type": "response" if refers is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{'' if page is None else page}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": _clean(url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers is not None:
        named["WARC-Refers-To"] = f"<urn:page:{refers}>"
        named["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named.items()) + "\r\n"
    return head.encode() + block + _BREAK


class ShardWriter:
    """The files of one task."""

    def __init__(self, folder: str, task: int, roll: int):
        self.files, self.root = store(folder)
        self.prefix, self.roll, self.n, self.out, self.done = f"part-{task:06d}", roll, 0, None, []

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.temporary = f"{self.root}/_temporary-{uuid.uuid4().hex}"
            self.out, self.records, self.size, self.hash = self.files.open_output_stream(self.temporary), 0, 0, hashlib.sha256()
        packed = zlib.compressobj(LEVEL, wbits=31)  # a gzip member a record, with no time in its header
        member = packed.compress(record) + packed.flush()
        self.out.write(member)
        self.hash.update(member)
        self.records, self.size = self.records + 1, self.size + len(member)
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        name = f"{self.prefix}-{self.n:05d}.warc.gz"
        self.files.move(self.temporary, f"{self.root}/{name}")
        self.done.append((name, self.records, self.size, self.hash.hexdigest()))
        self.n, self.out = self.n + 1, None


def write_archives(records: DataFrame, folder: str, ranges: int, roll: int = ROLL_BYTES) -> DataFrame:
    """Writes the records of ``plan_records`` and returns the manifest, stored in ``folder``/manifest."""
    spark = records.sparkSession
    files, root = store(folder)
    files.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = ShardWriter(folder, TaskContext.get().partitionId(), roll)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                shards.add(record_bytes(*row))
        shards.close()
        columns = list(zip(*shards.done)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MANIFEST)], schema=_MANIFEST)

    ordered = records.select("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")
    ordered = ordered.repartitionByRange(ranges, "page_id", "payload_digest").sortWithinPartitions(
        "page_id", "payload_digest", "url", "refers_to"
    )
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def parse(stream) -> Iterator[tuple]:
    """(page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to) of a gzip stream.

    Raises ValueError where a digest or a length doesn't fit.
    """
    data = pa.CompressedInputStream(stream, "gzip")
    rest = b""
    number = lambda urn: int(x) if (x := urn[len("<urn:page:") : -1]) else None
    while True:
        while (end := rest.find(_BREAK)) < 0:
            if not (more := data.read(1 << 20)):
                if rest:
                    raise ValueError("an archive ends within a record")
                return
            rest += more
        lines = rest[:end].decode().split("\r\n")
        named = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        length, start = int(named["Content-Length"]), end + 4
        pieces, have = [rest[start:]], len(rest) - start
        while have < length + 4:
            if not (more := data.read(max(1 << 20, length + 4 - have))):
                raise ValueError("an archive ends within a record")
            pieces.append(more)
            have += len(more)
        whole = b"".join(pieces)
        block, rest = whole[:length], whole[length + 4 :]
        http, _, payload = block.partition(_BREAK)
        size = int(http.rpartition(b"Content-Length: ")[2])
        digest, kind = named["WARC-Payload-Digest"].removeprefix("sha256:"), named["WARC-Type"]
        answer = kind == "response"
        if named["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}" or (
            answer and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest)
        ):
            raise ValueError(f"record {named['WARC-Record-ID']} is damaged")
        refers = None if answer else number(named["WARC-Refers-To"])
        url = _dirty(named["WARC-Target-URI"])
        yield number(named["WARC-Record-ID"]), url, kind, payload if answer else None, size, digest, refers


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records (``RECORD``) of the files that the manifest lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        rows, size = [], 0

        def flush():
            columns = list(zip(*rows)) or [()] * len(_RECORD)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RECORD)], schema=_RECORD)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for row in parse(stream):
                        rows.append(row)
                        size += len(row[3] or b"") + 200
                        if size >= 8 << 20:
                            yield flush()
                            rows, size = [], 0
        yield flush()

    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("file")
    tasks = max(1, listed.count())
    return listed.repartition(tasks, "file").mapInArrow(run, RECORD)


def archive(pages: DataFrame, folder: str, roll: int = ROLL_BYTES, **columns) -> DataFrame:
    """Writes a record per row of ``pages`` to ``folder`` and returns the manifest.

    Null html and null urls are empty; null ids are kept and sort first; rows that repeat an id are
    a record each. Of equal payloads of at least 100 bytes the smallest id (a null id counts as
    none) is a response, the others are revisits of it. An empty table gives an empty manifest.
    """
    total = pages.agg(F.sum(F.octet_length(F.col(columns.get("html", "html")).cast("string")))).first()[0]
    ranges = max(1, -(-(total or 0) // RANGE_BYTES))
    return write_archives(plan_records(pages, **columns), folder, ranges, roll)
