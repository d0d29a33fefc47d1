"""Digests of whole files that are never in memory as a whole."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .zips import CHUNK


def located(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and place of a path as Spark writes it, in which nothing is escaped."""
    scheme, found, rest = path.partition(":")
    if not found or scheme == "file":
        return pyarrow.fs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    return pyarrow.fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")


def _open_files(spark: SparkSession, folder: str) -> bool:
    """Whether the store of ``folder`` can be read through open files; some only Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    try:
        located(path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().toString())
    except (pa.ArrowException, OSError):
        return False
    return True


def sha256_of(path: str) -> str:
    system, where = located(path)
    digest = hashlib.sha256()
    with system.open_input_stream(where, compression=None) as file:
        while chunk := file.read(CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def content_digests(files: DataFrame, folder: str) -> DataFrame:
    """``(path, digest)`` of Spark's binary files, a batch or a stream, with the digest of ``sha2``. A file is read through an
    open file, some megabytes at a time; only where the store allows none is its content a value of a row."""
    if not _open_files(files.sparkSession, folder):
        return files.select("path", F.sha2("content", 256).alias("digest"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0)
            yield pa.RecordBatch.from_arrays([paths, pa.array(map(sha256_of, paths.to_pylist()), pa.string())], ["path", "digest"])

    return files.select("path").mapInArrow(hashed, "path string, digest string")
