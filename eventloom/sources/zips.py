"""Lines of zipped CSV members."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from typing import IO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .readers import CORRUPT, with_corrupt

CHUNK = 4 << 20
CHUNKS = "path string, source_file string, start bigint, lines array<string>, error string"
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("source_file", pa.string()),
        ("start", pa.int64()),
        ("lines", pa.list_(pa.string())),
        ("error", pa.string()),
    ]
)


def _lines(stream: IO[bytes]) -> Iterator[list[str]]:
    """Whole lines of a byte stream, a few megabytes at a time."""
    rest = b""
    while chunk := stream.read(CHUNK):
        data = rest + chunk
        cut = data.rfind(b"\n") + 1
        rest = data[cut:]
        if cut:
            text = data[:cut].decode("utf-8", "replace")
            yield text.replace("\r\n", "\n").split("\n")[:-1]
    if rest:
        yield [rest.decode("utf-8", "replace").removesuffix("\r")]


def _member_chunks(path: str, content: bytes) -> Iterator[pa.RecordBatch]:
    """Lines of the first CSV member, one row a chunk.

    The member is read through once for its checksum before any line is passed on, because a file
    that breaks half-way is rejected as a whole.
    """

    def row(name: str | None, start: int | None, lines: list[str] | None, error: str | None = None):
        record = dict(path=path, source_file=name, start=start, lines=lines, error=error)
        return pa.RecordBatch.from_pylist([record], schema=_ARROW)

    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            member = next((m for m in archive.namelist() if m.endswith((".CSV", ".csv"))), None)
            if member is None:
                yield row(None, None, None, "no CSV member")
                return
            with archive.open(member) as stream:
                while stream.read(CHUNK):
                    pass
            start = 0
            with archive.open(member) as stream:
                for lines in _lines(stream):
                    yield row(member, start, lines)
                    start += len(lines)
    except Exception as problem:  # any unreadable zip is one rejected row, the rest goes on
        yield row(None, None, None, f"{type(problem).__name__}: {problem}")


def member_lines(files: DataFrame) -> DataFrame:
    """``(path, source_file, line_no, line, error)`` of frames with ``path`` and ``content``.

    A zip cannot be split, so a file is the unit of work, as it is for the reader of any such feed;
    the lines leave in chunks, and the JVM takes them apart and parses them.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files_batch in batches:
            for path, content in zip(files_batch.column(0), files_batch.column(1)):
                yield from _member_chunks(path.as_py(), content.as_py())

    chunks = files.select("path", "content").mapInArrow(unpack, CHUNKS)
    lines = chunks.select("path", "source_file", "start", "error", F.posexplode_outer("lines").alias("at", "line"))
    return lines.select("path", "source_file", (F.col("start") + F.col("at")).alias("line_no"), "line", "error")


def parse_lines(
    lines: DataFrame, schema: T.StructType, sep: str = "\t", skip_header: int = 0, spread: int | None = None
) -> DataFrame:
    """Typed rows with ``source_file``; what cannot be parsed, and every file that could not be
    opened, is marked in ``_corrupt_record``. ``spread`` deals the lines of large members over that
    many partitions before they are parsed."""
    lines = lines.where(F.col("error").isNotNull() | (F.col("line_no") >= skip_header))
    lines = lines.where(F.col("error").isNotNull() | (F.col("line") != ""))
    if spread:
        lines = lines.repartition(spread, "path", "line_no")
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in with_corrupt(schema).fields)
    parsed = F.from_csv("line", ddl, options)
    rows = lines.select("path", "source_file", "error", parsed.alias("r"))
    problem = F.when(F.col("error").isNotNull(), F.concat_ws(": ", "path", "error")).otherwise(
        F.col(f"r.{CORRUPT}")
    )
    return rows.select(*[F.col(f"r.{f.name}") for f in schema.fields], "source_file", problem.alias(CORRUPT))


def read_zipped_members(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = "\t",
    skip_header: int = 0,
    spread: int | None = None,
) -> DataFrame:
    """Rows of the first ``.CSV``/``.csv`` member of every zip below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return parse_lines(member_lines(files), schema, sep, skip_header, spread)
