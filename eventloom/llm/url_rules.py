"""URL filter: sorted digest arrays, memory-mapped, probed by vectorised binary search and confirmed by string."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.spread import lookup_join
from ..session import settle
from .flat import text_buffer

#: Keys in one array (about 40 MB with their strings) and keys probed by one task at a time.
ARRAY_KEYS = 1_000_000
PROBE_KEYS = 1_000_000

Rule = tuple[str, str, str]  # verdict, host, path


def host_and_path(url: Column | str) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path of a URL; both empty where it is null or has no ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Longest rule that fits, as ``host/path``, and its verdict; both null where none fits. A rule fits its host
    and all subdomains where the path starts with the rule's; equally long ones: the longer host."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _shard(digest: Column, bits: int) -> Column:
    """Shards by the highest bits, so that each holds one run of the sorted order."""
    return (F.shiftrightunsigned(digest, 64 - bits) if bits else F.lit(0)).cast("int")


def _bits(keys: int, per_array: int) -> int:
    return max(0, int(-(-keys // per_array) - 1).bit_length())


def digest_array(keys: pa.Array, digests: np.ndarray) -> bytes:
    """Image of one array: count, ascending unsigned digests, string offsets, strings."""
    order = np.argsort(digests, kind="stable")
    data, offsets = text_buffer(keys.take(pa.array(order)))
    return b"".join(
        [np.int64(len(order)).tobytes(), digests[order].tobytes(), offsets.astype(np.int64).tobytes(), data.tobytes()]
    )


class DigestArray:
    """A memory-mapped image. Its file has no name: it goes with the task, also with one that is killed."""

    def __init__(self, image: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(image)
            f.flush()
            whole = np.memmap(f, np.uint8, "r")
        n = int(whole[:8].view(np.int64)[0])
        self.digests = whole[8 : 8 + 8 * n].view(np.uint64)
        self.offsets = whole[8 + 8 * n : 16 + 16 * n].view(np.int64)
        self.strings = whole[16 + 16 * n :]

    def contains(self, keys: pa.Array, digests: np.ndarray) -> np.ndarray:
        """Binary search for all digests at once; where one is found, the full strings are compared."""
        data, offsets = text_buffer(keys)
        at = np.searchsorted(self.digests, digests)
        found = np.zeros(len(digests), np.bool_)
        live = np.flatnonzero(at < len(self.digests))
        live = live[self.digests[at[live]] == digests[live]]
        while len(live):
            for i in live.tolist():
                a, b = self.offsets[at[i]], self.offsets[at[i] + 1]
                found[i] = b - a == offsets[i + 1] - offsets[i] and np.array_equal(
                    self.strings[a:b], data[offsets[i] : offsets[i + 1]]
                )
            # Another string may share the digest: look at the next place.
            live = live[~found[live]]
            at[live] += 1
            live = live[at[live] < len(self.digests)]
            live = live[self.digests[at[live]] == digests[live]]
        return found


def build_arrays(entries: DataFrame, per_array: int = ARRAY_KEYS) -> tuple[DataFrame, int]:
    """Table (shard, image) over the distinct strings of the first column of ``entries``, and the shard bits.
    Null and empty entries are left out; without any entry the table is empty."""
    keys = entries.select(F.col(entries.columns[0]).cast("string").alias("key")).where(F.length("key") > 0).distinct()
    keys = settle(keys.withColumn("digest", F.xxhash64("key")))
    bits = _bits(keys.count(), per_array)

    def image(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        digests = rows.column("digest").to_numpy().view(np.uint64)
        made = digest_array(rows.column("key").combine_chunks(), digests)
        return pa.table({"shard": rows.column("shard")[:1], "image": pa.array([made], pa.binary())})

    schema = T.StructType().add("shard", T.IntegerType()).add("image", T.BinaryType())
    return settle(keys.withColumn("shard", _shard(F.col("digest"), bits)).groupBy("shard").applyInArrow(image, schema)), bits


def probe(keys: DataFrame, arrays: DataFrame, bits: int, per_task: int = PROBE_KEYS) -> DataFrame:
    """Those of the distinct strings ``key`` that the arrays hold. Each shard meets its own keys only, at most
    about ``per_task`` of them in one task."""
    digested = settle(keys.select("key", F.xxhash64("key").alias("digest")))
    deals = int(digested.count() // (per_task << bits)) + 1
    deal = F.pmod(F.hash("key"), F.lit(deals)).cast("int")
    asked = digested.withColumn("shard", _shard(F.col("digest"), bits)).withColumn("deal", deal)
    copies = arrays.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.combine_chunks()
        if not rows.num_rows or not right.num_rows:
            return rows.select(["key"]).slice(0, 0)
        array = DigestArray(right.column("image")[0].as_py())
        found = array.contains(rows.column("key").combine_chunks(), rows.column("digest").to_numpy().view(np.uint64))
        return rows.select(["key"]).filter(pa.array(found))

    return (
        asked.groupBy("shard", "deal").cogroup(copies.groupBy("shard", "deal")).applyInArrow(look, T.StructType().add("key", T.StringType()))
    )


def judge(urls: DataFrame, blocked: DataFrame, rules: Sequence[Rule] = (), url: str = "url") -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    The longest rule that fits decides; where none fits, the list ``blocked`` does: its strings are hosts, which
    block themselves and their subdomains, or ``host/path``, which block that address alone; what is on neither
    is allowed. A null URL or one without ``://`` has an empty host and path and is allowed; repeated rows get
    the same verdict; with an empty list or table nothing is blocked or returned. Columns of the four new names
    are replaced.

    Each host and address is probed once however many rows have it; hot hosts are dealt out by ``lookup_join``.
    """
    arrays, bits = build_arrays(blocked)
    host, path = host_and_path(url)
    # No name of the list has more labels than this, so longer endings of a host cannot match.
    name = F.split_part(F.col(blocked.columns[0]).cast("string"), F.lit("/"), F.lit(1))
    labels = blocked.agg(F.max(F.size(F.split(name, r"\.")))).first()[0] or 1
    base = urls.drop("host", "path", "rule", "verdict").withColumn("host", host).withColumn("path", path)
    hosts = base.select("host").where("host <> ''").distinct()
    parts = F.split("host", r"\.")
    last = F.least(F.size(parts), F.lit(labels))
    endings = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(parts, -i, i), "."))
    names = settle(hosts.select("host", F.explode(endings).alias("key")))
    addresses = base.where("host <> ''").select(F.concat("host", "path").alias("key"))
    hits = settle(probe(names.select("key").union(addresses).distinct(), arrays, bits))
    bad_hosts = settle(
        lookup_join(names, hits.withColumn("_hit", F.lit(True)), "key").select("host").distinct().withColumn("_host_hit", F.lit(True))
    )
    bad_addresses = hits.where(F.contains("key", F.lit("/"))).select(
        F.col("key").alias("_address"), F.lit(True).alias("_address_hit")
    )
    found = lookup_join(base.withColumn("_address", F.concat("host", "path")), bad_hosts, "host", "left")
    found = lookup_join(found, bad_addresses, "_address", "left")
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    on_list = F.coalesce(F.col("_host_hit"), F.col("_address_hit"), F.lit(False))
    judged = found.withColumn("rule", rule).withColumn(
        "verdict", F.coalesce(verdict, F.when(on_list, F.lit("block")).otherwise("allow"))
    )
    return judged.select(*base.columns, "rule", "verdict")
