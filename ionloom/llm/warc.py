"""WARC archives, index first.

Writing: every task appends gzip members, one record each, to an archive of its own in the shared folder and returns an
index row for each record (archive, offset, length, url, digest). The index is a table; what a failed or repeated task
has written is in no index row and so in no result. Reading: the index rows of the wanted records are dealt out by
ranges of (archive, offset), neighbouring byte ranges are joined into larger reads, and the records are parsed.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest page_id is a response and the
others are revisits without a payload; shorter payloads are always responses. A null payload is an empty one. A null url
is an empty one. Rows that repeat the smallest page_id of their payload are all responses; a null page_id is larger than
any other. No rows give no archives and no rows. Extra columns are ignored. Payloads are held one read at a time.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionloom.llm.common import bounded_batches, id_filter, materialize, maybe_in, temporary

#: Bytes after which a task begins a new archive; of one read; and of the gap up to which two ranges are read as one.
ARCHIVE_BYTES, READ_BYTES, GAP_BYTES = 1 << 30, 8 << 20, 64 << 10
#: Bytes of records that one task reads at most, about, and at least where there are tasks for all cores.
TASK_BYTES, LEAST_TASK_BYTES = 256 << 20, 1 << 20
INDEX = "archive string, offset long, length long, url string, payload_digest string, page_id long, record_type string"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _record(page_id: int | None, url: str, payload: bytes, digest: str, size: int, kind: str, refers_to: int | None, date: str) -> bytes:
    """One record: the WARC header, an HTTP header and, for a response, the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>", f"WARC-Date: {date}", f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}", f"X-Page-Id: {'' if page_id is None else page_id}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to}/{digest}')}>", f"X-Refers-To-Page: {refers_to}"]
    else:
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        archive, out, at, files = "", None, 0, 0
        for batch in batches:
            index = {"archive": [], "offset": [], "length": []}
            kinds = []
            for i in range(batch.num_rows):
                page_id, url, payload, digest, size, refers_to = (batch.column(c)[i].as_py() for c in ("page_id", "url", "payload", "payload_digest", "payload_bytes", "refers_to"))
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    archive, at, files = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{files}.warc.gz", 0, files + 1
                    out = store.open_output_stream(f"{root}/{archive}", compression=None)
                kinds.append("response" if refers_to is None else "revisit")
                data = _gzip(_record(page_id, url or "", payload or b"", digest, size, kinds[-1], refers_to, date))
                out.write(data)
                for name, value in (("archive", archive), ("offset", at), ("length", len(data))):
                    index[name].append(value)
                at += len(data)
            yield pa.record_batch({"archive": pa.array(index["archive"], pa.string()), "offset": pa.array(index["offset"], pa.int64()), "length": pa.array(index["length"], pa.int64()), "url": batch.column("url"), "payload_digest": batch.column("payload_digest"), "page_id": batch.column("page_id"), "record_type": pa.array(kinds, pa.string())})
        if out is not None:
            out.close()

    return run


def write_archives(df: DataFrame, folder: str | None = None, min_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> tuple[str, DataFrame]:
    """Write one record for each row (page_id, url, html); returns the folder of the archives and their index. Without a
    folder, which all executors must reach, the archives are temporary."""
    bounded_batches(df.sparkSession)
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    pages = df.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    pages = pages.select("*", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    long = pages.where(F.col("payload_bytes") >= min_bytes).groupBy(F.col("payload_digest").alias("same")).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # a written table, so that Spark may split a digest of very many pages; and only pages that may share theirs move
    first = materialize(long.where((F.col("n") > 1) & F.col("first").isNotNull()).select("same", "first", F.xxhash64("same").alias("key")), "warc-first")
    shared = id_filter(first, "key")
    pages = pages.withColumn("key", F.xxhash64("payload_digest"))
    near = maybe_in(pages, "key", shared).drop("key")
    joined = near.join(first.drop("key"), (near["payload_digest"] == first["same"]) & (near["payload_bytes"] >= min_bytes), "left")
    record = ["page_id", "url", "payload", "payload_digest", "payload_bytes"]
    near = joined.select(*record, F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
    rows = maybe_in(pages, "key", shared, wanted=False).select(*record, F.lit(None).cast("long").alias("refers_to")).unionByName(near)
    folder = folder or temporary(df.sparkSession, "warc")
    return folder, materialize(rows.mapInArrow(_write(folder, date), INDEX), "warc-index")


def _parse(data: bytes) -> dict:
    """The fields of one uncompressed record; its payload is checked against the digest that the header states."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    size, digest, kind = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if fields.get(name) else None
    return {"page_id": number("X-Page-Id"), "url": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number("X-Refers-To-Page"), "payload": payload}


RECORD = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}


def _read(folder: str, payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            wanted = list(zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True))
            at = 0
            while at < len(wanted):
                archive, begin, length = wanted[at]
                stop, end = at + 1, begin + length
                while stop < len(wanted) and wanted[stop][0] == archive and wanted[stop][1] - end <= GAP_BYTES and wanted[stop][1] + wanted[stop][2] - begin <= READ_BYTES:
                    end = wanted[stop][1] + wanted[stop][2]
                    stop += 1
                with store.open_input_file(f"{root}/{archive}") as file:
                    data = file.read_at(end - begin, begin)
                found = [_parse(zlib.decompress(data[o - begin : o - begin + n], 31)) for _, o, n in wanted[at:stop]]
                yield pa.record_batch({c: pa.array([r[c] if c != "payload" or payloads else None for r in found], kind) for c, kind in RECORD.items()})
                at = stop

    return run


def read_records(folder: str, index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that ``index`` (any rows of it) selects: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to and, with ``payloads``, the payload (null for revisits)."""
    held = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    cores = index.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, held // TASK_BYTES, min(held // LEAST_TASK_BYTES, 2 * cores))  # a number of our own is one that Spark doesn't lower to fit the small index
    ranges = index.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    return ranges.mapInArrow(_read(folder, payloads), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
