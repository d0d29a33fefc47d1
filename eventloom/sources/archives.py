"""Zipped feeds as a data source, for batches and streams: a partition is an archive, an offset the name of one."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .zips import CHUNK, _lines

FORMAT = "zipped_members"
SCHEMA = "path string, source_file string, line_no bigint, line string, error string"
_ARROW = pa.schema(
    [("path", pa.string()), ("source_file", pa.string()), ("line_no", pa.int64()), ("line", pa.string()), ("error", pa.string())]
)


@dataclass
class Archive(InputPartition):
    """One archive; its directory is read where the members are read."""

    path: str


class Folder:
    """Archives of a folder, by name; ``contains`` keeps the names that have a text, such as a day."""

    def __init__(self, options: dict):
        self.path, self.contains = options["path"], options.get("contains", "")

    def files(self) -> list[tuple[str, str]]:
        """``(name, path)`` in the order of the names."""
        system, base = pyarrow.fs.FileSystem.from_uri(self.path)
        found = system.get_file_info(pyarrow.fs.FileSelector(base, allow_not_found=True))
        named = [(f.base_name, f.base_name) for f in found if f.is_file and f.base_name.endswith(".zip")]
        return sorted((n, f"{self.path.rstrip('/')}/{p}") for n, p in named if self.contains in n)

    @staticmethod
    def lines(path: str) -> Iterator[pa.RecordBatch]:
        """Lines of the first CSV member, some megabytes at a time. The archive is read through an open file, so neither
        it nor the member is in memory as a whole; the member is read once for its checksum before any line leaves, since
        a file that breaks half-way is set aside as a whole."""

        def batch(name: str | None, start: int | None, lines: list, error: str | None = None) -> pa.RecordBatch:
            n = len(lines)
            columns = [[path] * n, [name] * n, [None if start is None else start + i for i in range(n)], lines, [error] * n]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

        try:
            system, where = pyarrow.fs.FileSystem.from_uri(path)
            with system.open_input_file(where) as file, zipfile.ZipFile(file) as archive:
                member = next((m for m in archive.namelist() if m.endswith((".CSV", ".csv"))), None)
                if member is None:
                    yield batch(None, None, [None], "no CSV member")
                    return
                with archive.open(member) as stream:
                    while stream.read(CHUNK):
                        pass
                start = 0
                with archive.open(member) as stream:
                    for lines in _lines(stream):
                        yield batch(member, start, lines)
                        start += len(lines)
        except Exception as problem:  # any unreadable archive is one rejected row, the rest goes on
            yield batch(None, None, [None], f"{type(problem).__name__}: {problem}")


class ArchiveReader(DataSourceReader):
    def __init__(self, folder: Folder):
        self.folder = folder

    def partitions(self) -> list[Archive]:
        return [Archive(path) for _, path in self.folder.files()] or [Archive("")]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        return Folder.lines(partition.path) if partition.path else iter(())


class ArchiveStream(DataSourceStreamReader):
    """Archives after the last name that was read. A feed's names are its times, so new ones come last; an archive that
    arrives under an earlier name is for the batch form."""

    def __init__(self, folder: Folder):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"name": ""}

    def latestOffset(self) -> dict:
        files = self.folder.files()
        return {"name": files[-1][0] if files else ""}

    def partitions(self, start: dict, end: dict) -> list[Archive]:
        return [Archive(path) for name, path in self.folder.files() if start["name"] < name <= end["name"]]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        return Folder.lines(partition.path)


class ArchiveSource(DataSource):
    """``path``: the folder; ``contains``: text that names must have."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(Folder(self.options))

    def streamReader(self, schema) -> ArchiveStream:
        return ArchiveStream(Folder(self.options))


def archive_lines(spark: SparkSession, folder: str, contains: str = "", stream: bool = False) -> DataFrame:
    """``(path, source_file, line_no, line, error)`` of the archives of a folder, as a batch or a stream."""
    spark.dataSource.register(ArchiveSource)
    reader = (spark.readStream if stream else spark.read).format(FORMAT).option("path", folder)
    return (reader.option("contains", contains) if contains else reader).load()
