"""Tables that change together: staged data and a log of which parts are in which version.

Data is written first, below a new name that no one reads. Then one small file of log rows is added, which is one rename of
Spark's committer: it makes all changes of all tables visible at once. A reader resolves the version it starts with, and
the parts of that version stay as they are. A load that fails before the log row leaves everything as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "version long, writer string, name string, part string, path string, low string, high string, whole boolean"


class Conflict(RuntimeError):
    """Another writer published the same version first."""


class TableSet:
    """Typed tables below one folder. A table is made of parts (files of a feed); a part is replaced as a whole."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).json(f"{self.root}/log")
        except Exception as problem:
            if "PATH_NOT_FOUND" in str(problem):
                return self.spark.createDataFrame([], LOG)
            raise

    def version(self) -> int:
        """Newest published version; 0 if there is none."""
        return self._log().agg(F.max("version")).first()[0] or 0

    def parts(self, name: str, version: int | None = None) -> DataFrame:
        """``(part, path, low, high)`` of a table at a version (the newest if not given)."""
        log = self._log().where(F.col("name") == name)
        # of writers that published one version, the first by name has it; the others were told to stop
        first = log.withColumn("first", F.min("writer").over(Window.partitionBy("version"))).where("writer = first")
        if version is not None:
            first = first.where(F.col("version") <= version)
        fresh = first.agg(F.max(F.when(F.col("whole"), F.col("version")))).first()[0] or 0
        newest = first.where((F.col("version") >= fresh) & F.col("path").isNotNull()).groupBy("part")
        row = F.max(F.struct("version", "path", "low", "high"))
        return newest.agg(row.alias("r")).select("part", "r.path", "r.low", "r.high")

    def read(
        self, name: str, schema: T.StructType | None = None, version: int | None = None, between: tuple[str, str] | None = None
    ) -> DataFrame:
        """Rows of a table at a version (with the schema of its files if none is given). ``between`` opens only the parts whose range of the day column meets it; rows of
        those parts are not filtered."""
        parts = self.parts(name, version)
        if between is not None:
            parts = parts.where((F.col("high") >= between[0]) & (F.col("low") <= between[1]))
        paths = [r["path"] for r in parts.select("path").orderBy("path").collect()]
        if not paths:
            if schema is None:
                raise LookupError(f"{self.root} has no table {name}")
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(*paths)

    def _staged(self, name: str) -> str:
        return f"{self.root}/data/{name}/{uuid.uuid4().hex}"

    def stage(self, name: str, df: DataFrame) -> list[tuple]:
        """Write a whole table where no reader looks."""
        path = self._staged(name)
        df.write.parquet(path)
        return [(name, "", path, None, None, True)]

    def stage_parts(self, name: str, df: DataFrame, part: str, day: str | None = None) -> list[tuple]:
        """Write the parts that ``df`` has rows of, a folder each, with the range of their day column."""
        path = self._staged(name)
        keyed = df.withColumn("_part", F.coalesce(F.md5(F.col(part).cast("string")), F.lit("none")))
        keyed.repartition("_part", F.pmod(F.xxhash64(*df.columns), F.lit(16))).sortWithinPartitions(
            "_part", *([day] if day else [])
        ).write.partitionBy("_part").parquet(path)
        kind = F.col(day).cast("string") if day else F.lit(None).cast("string")
        stored = self.spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_part", T.StringType())])).parquet(path)
        facts = stored.groupBy("_part").agg(
            F.first(F.col(part).cast("string")).alias("part"), F.min(kind).alias("low"), F.max(kind).alias("high")
        )
        return [(name, r["part"], f"{path}/_part={r['_part']}", r["low"], r["high"], False) for r in facts.collect()]

    def publish(self, rows: Sequence[tuple]) -> int:
        """Make staged parts the newest version, all in one step; gives the version."""
        if not rows:
            return self.version()
        version, writer = self.version() + 1, uuid.uuid4().hex
        log = [(version, writer, *row) for row in rows]
        self.spark.createDataFrame(log, LOG).coalesce(1).write.mode("append").json(f"{self.root}/log")
        first = self._log().where(F.col("version") == version).agg(F.min("writer")).first()[0]
        if first != writer:
            raise Conflict(f"version {version} of {self.root} was published by another writer")
        return version

    def replace(self, tables: Mapping[str, DataFrame]) -> int:
        """Replace several tables together."""
        staged = [row for name, df in tables.items() for row in self.stage(name, df)]
        return self.publish(staged)

    def put(self, name: str, df: DataFrame, part: str = "source_file", day: str | None = None) -> int:
        """Add parts to a table; a part that is there already is replaced. Without rows nothing changes."""
        return self.publish(self.stage_parts(name, df, part, day))

