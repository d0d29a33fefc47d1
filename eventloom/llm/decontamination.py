"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, texts scanned once."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle
from .flat import ALNUM_WORDS, LOWER, slices, text_buffer

WINDOW = 10
#: Bytes of item text in one automaton, which takes about 500 times that in memory. A larger benchmark is
#: scanned in several rounds of about this size.
AUTOMATON_BYTES = 512 << 10

_NORMAL = np.where(ALNUM_WORDS, LOWER, 0x20).astype(np.uint8)


def _pairs(low: str, high: str) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(low, T.LongType()), T.StructField(high, T.LongType())]))


_HITS = (
    T.StructType()
    .add("_key", T.LongType())
    .add("n_words", T.LongType())
    .add("hit_ranges", _pairs("first", "after"))
    .add("spans", _pairs("begin", "end"))
    .add("item_ids", T.ArrayType(T.StringType()))
)


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text in lower case between single spaces, one leading and one trailing space.

    Returns the normal bytes, the offsets of the texts in them, and for every normal byte the place of
    its original byte (of a space: where the gap begins).
    """
    n = len(offsets) - 1
    # A space goes before and after each text, so runs of gaps never join two texts.
    place = np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, np.diff(offsets))
    wide = np.full(len(data) + 2 * n, 0x20, np.uint8)
    wide[place] = _NORMAL[data]
    origin = np.zeros(len(wide), np.int64)
    origin[place] = np.arange(len(data))
    edges = offsets[:-1] + 2 * np.arange(n)
    origin[edges] = offsets[:-1]
    origin[offsets[1:] + 2 * np.arange(n) + 1] = offsets[1:]
    keep = wide != 0x20
    keep[1:] |= wide[:-1] != 0x20
    keep[edges] = True
    counts = np.zeros(len(wide) + 1, np.int64)
    np.cumsum(keep, out=counts[1:])
    return wide[keep], counts[np.append(edges, len(wide))], origin[keep]


def item_windows(words: list[str], size: int = WINDOW) -> set[str]:
    """Normal strings of ``size`` consecutive words; of all words where there are fewer."""
    if not words:
        return set()
    last = max(1, len(words) - size + 1)
    return {" " + " ".join(words[i : i + size]) + " " for i in range(last)}


def automaton(items: Iterator[tuple[str, str]], size: int = WINDOW) -> bytes | None:
    """Pickled automaton over the windows of (id, text); None where there is no window."""
    owners: dict[str, set[str]] = {}
    for ident, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        normal, _, _ = normalise(raw, np.array([0, len(raw)]))
        for window in item_windows(normal.tobytes().decode("latin-1").split(" ")[1:-1], size):
            owners.setdefault(window, set()).add(ident)
    if not owners:
        return None
    machine = ahocorasick.Automaton()
    for window, ids in owners.items():
        machine.add_word(window, (window.count(" ") - 1, tuple(sorted(ids))))
    machine.make_automaton()
    return pickle.dumps(machine)


def _scan(batch: pa.RecordBatch, machine) -> pa.RecordBatch:
    data, offsets = text_buffer(batch.column("_text"))
    normal, at, origin = normalise(data, offsets)
    text = normal.tobytes().decode("latin-1")
    gaps = np.flatnonzero(normal == 0x20)
    gap_bounds = np.searchsorted(gaps, at)
    n = batch.num_rows
    n_words = np.maximum(np.diff(gap_bounds) - 1, 0)
    ranges, spans, idents = [[] for _ in range(n)], [[] for _ in range(n)], [()] * n
    if machine is not None:
        for row in range(n):
            found = list(machine.iter(text, int(at[row]), int(at[row + 1]))) if n_words[row] else []
            if not found:
                continue
            own = gaps[gap_bounds[row] : gap_bounds[row + 1]]
            after = np.searchsorted(own, [end for end, _ in found])
            first = after - [hit[0] for _, hit in found]
            merged: list[list[int]] = []
            for a, b in sorted(zip(first.tolist(), after.tolist())):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            ranges[row] = [{"first": a, "after": b} for a, b in merged]
            start = offsets[row]
            spans[row] = [
                {"begin": int(origin[own[a] + 1] - start), "end": int(origin[own[b]] - start)} for a, b in merged
            ]
            idents[row] = sorted({ident for _, hit in found for ident in hit[1]})
    columns = [batch.column("_key"), pa.array(n_words, pa.int64()), ranges, spans, [list(x) for x in idents]]
    types = [
        pa.int64(),
        pa.int64(),
        pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())])),
        pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])),
        pa.list_(pa.string()),
    ]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in _HITS.fields])


def _rounds(items: DataFrame, item_id: str, text: str, limit: int) -> list[DataFrame]:
    """The items in blocks of about ``limit`` bytes by hash of the id: one block for a usual benchmark."""
    size = items.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = int(size // limit) + 1
    if n == 1:
        return [items]
    block = F.pmod(F.xxhash64(item_id), F.lit(n))
    return [items.where(block == k) for k in range(n)]


def _broadcast(block: DataFrame, item_id: str, item_text: str, window: int):
    rows = block.select(F.col(item_id).cast("string"), item_text).toLocalIterator()
    built = automaton(((r[0], r[1]) for r in rows), window)
    return block.sparkSession.sparkContext.broadcast(built)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    limit: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Per row of ``docs``: the key as ``_key``, ``n_words``, ``hit_ranges`` (word ranges inside an occurrence
    of a window), ``spans`` (the same as byte ranges of the original text) and ``item_ids``.

    Words are runs of ASCII letters, digits and anything beyond ASCII, in lower case (A-Z only). A window is
    ``window`` consecutive words of an item, or all of a shorter one. A null or empty text has no words; a null
    or wordless item has no window; repeated rows of either table are judged one by one; an empty table gives
    no rows or no hits. Columns other than the named ones are not looked at. ``limit`` bounds each broadcast: a
    benchmark that needs more than one automaton is scanned in rounds, over rows that were numbered and written
    once, and gives the same rows.
    """
    wanted = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"))
    blocks = _rounds(benchmark.select(item_id, item_text), item_id, item_text, limit)
    schema = _HITS
    if len(blocks) > 1:
        wanted = settle(wanted.withColumn("_at", F.monotonically_increasing_id()))
        schema = T.StructType([*_HITS.fields, T.StructField("_at", T.LongType())])
    parts = []
    for block in blocks:
        built = _broadcast(block, item_id, item_text, window)

        def scan(batches, built=built):
            machine = pickle.loads(built.value) if built.value else None
            for batch in batches:
                for part in slices(batch, "_text"):
                    found = _scan(part, machine)
                    more = [part.column("_at")] if len(schema) > len(_HITS) else []
                    yield pa.RecordBatch.from_arrays([*found.columns, *more], schema.names)

        parts.append(wanted.mapInArrow(scan, schema))
    if len(parts) == 1:
        return parts[0]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    both = F.zip_with(
        "hit_ranges", "spans", lambda r, s: F.struct(r["first"].alias("first"), r["after"].alias("after"), s["begin"].alias("begin"), s["end"].alias("end"))
    )
    found = whole.groupBy("_at").agg(
        F.max("_key").alias("_key"),
        F.max("n_words").alias("n_words"),
        _merged(F.flatten(F.collect_list(both))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
    )
    return found.select(
        "_key",
        "n_words",
        F.transform("hits", lambda x: F.struct(x["first"].alias("first"), x["after"].alias("after"))).alias("hit_ranges"),
        F.transform("hits", lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end"))).alias("spans"),
        "item_ids",
    )


def _merged(hits: F.Column) -> F.Column:
    """Overlapping or touching word ranges joined, and their byte ranges with them."""
    start = F.expr("cast(array() as array<struct<first:bigint,after:bigint,begin:bigint,end:bigint>>)")

    def add(done, x):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(
            last["first"].alias("first"),
            F.greatest(last["after"], x["after"]).alias("after"),
            last["begin"].alias("begin"),
            F.greatest(last["end"], x["end"]).alias("end"),
        )
        return F.when(
            (F.size(done) > 0) & (x["first"] <= last["after"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined)),
        ).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(hits), start, add)


def hit_words() -> F.Column:
    return F.aggregate("hit_ranges", F.lit(0).cast("bigint"), lambda t, r: t + r["after"] - r["first"])


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    limit: int = AUTOMATON_BYTES,
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; all columns stay as they are, rows with a null,
    empty or clean text stay. The rows are judged where they lie: nothing is shuffled."""
    items = benchmark.select(item_id, item_text)
    for block in _rounds(items, item_id, item_text, limit):
        built = _broadcast(block, item_id, item_text, window)

        def clean(batches, built=built):
            machine = pickle.loads(built.value) if built.value else None
            for batch in batches:
                for part in slices(batch, text):
                    keys = pa.array(range(part.num_rows), pa.int64())
                    found = _scan(pa.RecordBatch.from_arrays([keys, part.column(text)], ["_key", "_text"]), machine)
                    yield part.filter(pc.equal(pc.list_value_length(found.column("hit_ranges")), 0))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def ids_digest() -> F.Column:
    return F.sha2(F.array_join(F.array_sort(F.array_distinct("item_ids")), ",").cast("binary"), 256)
