"""WARC files and a Merkle audit of their replicas.

Every record of a file is hashed at its offset; ordered offset ranges of 64 KB, then of 16 times as much, and so on are
hashed over what they hold, up to one root a file. Two replicas are compared root by root, and only branches that
differ are followed down to the records that are corrupt.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle

#: Bytes of the lowest offset range, as a power of two, and children of a node above it, likewise.
LEAF_BITS, FAN_BITS = 16, 4
READ_BYTES = 8 << 20

_INDEX = (
    T.StructType()
    .add("key", T.LongType())
    .add("file", T.StringType())
    .add("offset", T.LongType())
    .add("length", T.LongType())
)
_LEAVES = T.StructType().add("file", T.StringType()).add("start", T.LongType()).add("length", T.LongType()).add("digest", T.StringType())


def record(url: str | None, payload: bytes) -> bytes:
    """One compressed WARC resource record. The id follows from the content, so equal pages have equal records."""
    digest = hashlib.sha256(payload).hexdigest()
    target = "" if url is None else f"WARC-Target-URI: {' '.join(url.split())}\r\n"
    head = (
        "WARC/1.1\r\nWARC-Type: resource\r\n"
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, (url or '') + digest)}>\r\n{target}"
        f"WARC-Payload-Digest: sha256:{digest}\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    )
    return gzip.compress(head.encode() + payload + b"\r\n\r\n", 1, mtime=0)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    whole = zlib.decompress(raw, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _place(folder: str):
    files, base = pa.fs.FileSystem.from_uri(folder)
    files.create_dir(base, recursive=True)
    return files, base


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a file a task into ``folder`` (a URI that all executors reach); returns the index of the records
    (key, file, offset, length). Nothing is shuffled.

    A null page has an empty payload, a null URL no target; repeated rows are records of their own; an empty table
    writes no file; other columns are not read. Only files that the index names count: a task that runs again
    leaves an unused one.
    """
    narrow = pages.select(F.col(key).cast("bigint").alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))

    def write(batches):
        sink = None
        offset = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if sink is None:
                files, base = _place(folder)
                name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                sink = files.open_output_stream(f"{base}/{name}", compression=None)
            offsets, lengths = [], []
            for target, page in zip(batch.column("url"), batch.column("html")):
                raw = record(target.as_py(), (page.as_py() or "").encode())
                sink.write(raw)
                offsets.append(offset)
                lengths.append(len(raw))
                offset += len(raw)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([name] * n), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], _INDEX.names
            )
        if sink is not None:
            sink.close()

    return settle(narrow.mapInArrow(write, _INDEX))


def _by_file(index: DataFrame) -> DataFrame:
    """A row a file with its records in order; as many tasks as files."""
    listed = index.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "key"))).alias("records"))
    return listed.repartition(max(1, min(index.select("file").distinct().count(), 10_000)))


def copy_replica(index: DataFrame, source: str, folder: str, damaged: Column | None = None) -> None:
    """Copy the files of an index to ``folder``; in records where ``damaged`` (a condition on the index) holds, the
    byte in the middle is turned over, as failing disks do."""
    wrong = F.lit(False) if damaged is None else F.coalesce(damaged, F.lit(False))
    marked = index.withColumn("key", F.when(wrong, 1).otherwise(0).cast("bigint"))

    def copy(batches):
        for batch in batches:
            for row in batch.to_pylist():
                files, base = pa.fs.FileSystem.from_uri(source)
                others, to = _place(folder)
                with files.open_input_stream(f"{base}/{row['file']}", compression=None) as data:
                    # Written under another name and moved: a task that runs again never leaves half a file.
                    spare = f"{to}/.{uuid.uuid4().hex}"
                    with others.open_output_stream(spare, compression=None) as sink:
                        for one in row["records"]:
                            raw = bytearray(data.read(one["length"]))
                            if one["key"]:
                                raw[len(raw) // 2] ^= 0xFF
                            sink.write(bytes(raw))
                    others.move(spare, f"{to}/{row['file']}")
            yield pa.RecordBatch.from_arrays([batch.column("file")], ["file"])

    settle(_by_file(marked).mapInArrow(copy, T.StructType().add("file", T.StringType())))


def record_digests(index: DataFrame, folder: str) -> DataFrame:
    """Hash of the bytes that a replica holds at each record's place; what a file is too short for, or a file
    that is not there, gives hashes of what there is."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                files, base = pa.fs.FileSystem.from_uri(folder)
                path = f"{base}/{row['file']}"
                there = files.get_file_info(path).type == pa.fs.FileType.File
                rows = []
                data = files.open_input_stream(path, compression=None, buffer_size=READ_BYTES) if there else None
                for one in row["records"]:
                    raw = data.read(one["length"]) if there else b""
                    rows.append((row["file"], one["offset"], one["length"], hashlib.sha256(raw).hexdigest()))
                if there:
                    data.close()
                columns = list(zip(*rows))
                types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _LEAVES.names)

    return _by_file(index).mapInArrow(read, _LEAVES)


def _range(level: int) -> Column:
    return F.shiftright("start", LEAF_BITS + FAN_BITS * (level - 1))


def tree(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes by level, leaves first: file, start (offset) and digest over the ordered children."""
    nodes = [settle(leaves.select("file", "start", "digest"))]
    for level in range(1, levels + 1):
        children = F.transform(
            F.sort_array(F.collect_list(F.struct("start", "digest"))), lambda c: F.concat_ws(":", c["start"].cast("string"), c["digest"])
        )
        above = nodes[-1].groupBy("file", _range(level).alias("range")).agg(
            F.min("start").alias("start"), F.sha2(F.array_join(children, "\n").cast("binary"), 256).alias("digest")
        )
        nodes.append(settle(above.select("file", "start", "digest")))
    return nodes


def audit(index: DataFrame, folder: str, other: str) -> DataFrame:
    """Records (file, offset) whose bytes differ between the replicas in the two folders."""
    largest = index.agg(F.max("offset")).first()[0] or 0
    levels = 1
    while largest >> (LEAF_BITS + FAN_BITS * (levels - 1)):
        levels += 1
    one = tree(record_digests(index, folder), levels)
    two = tree(record_digests(index, other), levels)
    suspects = None
    for level in range(levels, -1, -1):
        left, right = one[level], two[level]
        if suspects is not None:  # only what lies below a node that differs
            below = suspects.select("file", _range(level + 1).alias("range"))
            left, right = (
                side.withColumn("range", _range(level + 1)).join(below, ["file", "range"], "left_semi").drop("range")
                for side in (left, right)
            )
        pair = left.join(right.withColumnRenamed("digest", "other"), ["file", "start"], "full")
        suspects = settle(pair.where("NOT (digest <=> other)").select("file", "start"))
    return suspects.select("file", F.col("start").alias("offset"))


def payloads(index: DataFrame, folder: str) -> DataFrame:
    """Per record, read back from the files: key, file, offset, length, size of the payload and its hash. A record
    that does not decompress, or whose own digest is another, has nulls."""
    schema = T.StructType([*_INDEX.fields]).add("n_bytes", T.LongType()).add("payload_sha256", T.StringType())

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                files, base = pa.fs.FileSystem.from_uri(folder)
                rows = []
                with files.open_input_stream(f"{base}/{row['file']}", compression=None, buffer_size=READ_BYTES) as data:
                    for one in row["records"]:
                        raw = data.read(one["length"])
                        size = digest = None
                        try:
                            fields, payload = parse(raw)
                            digest = hashlib.sha256(payload).hexdigest()
                            size = len(payload)
                            if fields["WARC-Payload-Digest"] != f"sha256:{digest}":
                                size = digest = None
                        except (zlib.error, ValueError, KeyError):
                            size = digest = None
                        rows.append((one["key"], row["file"], one["offset"], one["length"], size, digest))
                columns = list(zip(*rows))
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema.names)

    return _by_file(index).mapInArrow(read, schema)
