"""Exact repeats of long byte strings across texts: content-placed shards, an induced-sorting suffix array each.

Every window of ``length`` bytes is placed by its smallest q-gram (by hash), its anchor: equal windows have equal
anchors, wherever they stand. Neighbouring windows with the same anchor make one *stretch*. Anchors that occur once
hold no repeat and are gone after one aggregation. Where all stretches of an anchor are equal, all their windows
repeat. The other anchors' distinct stretches are dealt to shards by anchor, so a shard has all windows that can
equal its own; its suffix array and permuted common prefixes show which windows occur twice.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle
from .flat import U64, Hasher, mix, ragged, row_slices, slices, text_buffer, whole_rows
from .suffix_arrays import permuted_common_prefixes, suffix_array

LENGTH = 200
GRAM = 24
#: Bytes of stretches in one suffix array.
SHARD_BYTES = 1 << 20
#: Bytes of text whose windows are placed at once; that takes about 120 times as much memory.
PLACED_BYTES = 1 << 19
#: An anchor with more distinct stretches than this has its windows counted by fingerprint instead of in a shard,
#: so that no anchor can fill a task.
HOT_STRETCHES = 12_000

_ANCHORS = (
    T.StructType()
    .add("ident", T.LongType())
    .add("anchor", T.LongType())
    .add("stretch", T.LongType())
    .add("first", T.LongType())
    .add("count", T.IntegerType())
)
_HITS = T.StructType().add("anchor", T.LongType()).add("stretch", T.LongType()).add("low", T.IntegerType()).add("high", T.IntegerType())


def sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of each run of ``width`` neighbours, by prefix and suffix minima of blocks."""
    n = len(keys)
    blocks = -(-n // width) + 1
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def stretches(data: np.ndarray, offsets: np.ndarray, hasher: Hasher, length: int = LENGTH, gram: int = GRAM):
    """Runs of window starts with the same anchor: text number, first start, number of starts, fingerprints of
    the anchor and of the whole stretch (its bytes and where the anchor lies in it)."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    sums = hasher.prefixes(data)
    places = np.arange(len(data) - gram + 1)
    grams = hasher.ranges(sums, places, places + gram)
    bits = U64(max(1, int(len(data)).bit_length()))
    best = sliding_minimum((grams >> bits << bits) | places.astype(U64), length - gram + 1)
    anchor = (best & ((U64(1) << bits) - U64(1))).astype(np.int64)
    sizes = np.diff(offsets)
    owners = np.flatnonzero(sizes >= length)
    starts = ragged(offsets[owners], sizes[owners] - length + 1)
    owner = np.repeat(owners, sizes[owners] - length + 1)
    mine = anchor[starts]
    fresh = np.append(True, (mine[1:] != mine[:-1]) | (owner[1:] != owner[:-1]))
    at = np.flatnonzero(fresh)
    count = np.diff(np.append(at, len(starts)))
    first = starts[at]
    whole = hasher.ranges(sums, first, first + count - 1 + length)
    whole = mix(whole + (mine[at] - first).astype(U64))
    return owner[at], first - offsets[owner[at]], count, grams[mine[at]].view(np.int64), whole.view(np.int64)


def _ident(key: Column, text: Column) -> Column:
    """What a text's repeats are kept under: rows that repeat both key and text share them."""
    return F.xxhash64(key, text)


def _anchors(texts: DataFrame, length: int) -> DataFrame:
    def find(batches):
        hasher = Hasher(11)
        for batch in batches:
            for part in slices(batch, "_text", PLACED_BYTES):
                data, offsets = text_buffer(part.column("_text"))
                owner, first, count, anchor, whole = stretches(data, offsets, hasher, length)
                ident = part.column("ident").to_numpy()[owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ident), pa.array(anchor), pa.array(whole), pa.array(first), pa.array(count.astype(np.int32))],
                    _ANCHORS.names,
                )

    return texts.mapInArrow(find, _ANCHORS)


def _bytes_of(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (ident, anchor, stretch, first, count, twice) with the bytes of each stretch."""
    by_text = wanted.groupBy("ident").agg(
        F.collect_list(F.struct("first", "count", "anchor", "stretch", "twice")).alias("parts")
    )
    found = texts.join(settle(by_text), "ident")
    schema = T.StructType([wanted.schema[c] for c in ("anchor", "stretch", "count", "twice")]).add("raw", T.BinaryType())

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                data, offsets = text_buffer(part.column("_text"))
                lists = part.column("parts")
                rows = lists.flatten()
                owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                first = rows.field("first").to_numpy() + offsets[owner]
                size = rows.field("count").to_numpy() + (length - 1)
                flat = data[ragged(first, size)]
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [rows.field("anchor"), rows.field("stretch"), rows.field("count"), rows.field("twice"), raw], schema.names
                )

    return found.mapInArrow(cut, schema)


def repeated_windows(raws: list[np.ndarray], length: int = LENGTH) -> list[np.ndarray]:
    """For each byte string of a shard: which of its windows also starts elsewhere in the shard."""
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    # 2 and up: the bytes of UTF-8, which never uses 255; 1 between strings; 0 at the end.
    text = np.ones(int((sizes + 1).sum()) + 1, np.uint8)
    text[-1] = 0
    flat = np.concatenate(raws)
    text[ragged(starts, sizes)] = np.where(flat < 254, flat + 2, 255)
    order = suffix_array(text, 256)
    shared = permuted_common_prefixes(text, order, length)
    twice = shared >= length
    after = np.zeros(len(text), np.bool_)
    after[order[:-1]] = twice[order[1:]]
    twice |= after
    # A window that reaches over the end of its string is none.
    return [twice[a : a + max(0, s - length + 1)] for a, s in zip(starts.tolist(), sizes.tolist())]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of true flags."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


def _shards(raw: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Repeated window starts within the stretches of each shard."""
    size = raw.agg(F.sum(F.octet_length("raw") + 1)).first()[0] or 0
    count = int(size // shard_bytes) + 1

    def induce(table: pa.Table) -> pa.Table:
        data = [np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("raw")]
        anchors, names = table.column("anchor").to_numpy(), table.column("stretch").to_numpy()
        rows: list[tuple] = []
        for i, flags in enumerate(repeated_windows(data, length)):
            for low, high in zip(*_runs(flags)):
                rows.append((anchors[i], names[i], low, high))
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(_HITS.names, columns, types)})

    # Whole anchors go to a shard; their windows spread over all shards by the anchor's hash.
    dealt = raw.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(count)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(induce, _HITS)


def _counted(raw: DataFrame, length: int) -> DataFrame:
    """The same for anchors too hot for a shard: each window by its two fingerprints, counted."""
    schema = (
        T.StructType()
        .add("one", T.LongType())
        .add("other", T.LongType())
        .add("anchor", T.LongType())
        .add("stretch", T.LongType())
        .add("low", T.IntegerType())
    )

    def spell(batches):
        hashers = Hasher(13), Hasher(17)
        for batch in batches:
            for part in slices(batch, "raw"):
                data, offsets = text_buffer(part.column("raw"))
                count = np.diff(offsets) - (length - 1)
                starts = ragged(offsets[:-1], count)
                prints = [h.ranges(h.prefixes(data), starts, starts + length).view(np.int64) for h in hashers]
                owner = np.repeat(np.arange(part.num_rows), count)
                low = starts - offsets[owner]
                columns = [part.column(c).to_numpy()[owner] for c in ("anchor", "stretch")]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*prints, *columns, low.astype(np.int32))], schema.names)

    windows = settle(raw.mapInArrow(spell, schema))
    twice = windows.groupBy("one", "other").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    hits = windows.join(twice, ["one", "other"])
    return hits.select("anchor", "stretch", "low", F.col("low").alias("high"))


def repeat_ranges(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, hot: int = HOT_STRETCHES, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Per ident with repeats the ``starts`` of repeated windows, as an array of (low, high)."""
    texts = docs.select(_ident(F.col(key), F.col(text)).alias("ident"), F.col(text).alias("_text"))
    found = _anchors(texts, length)
    per_anchor = found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("stretch").alias("least"), F.max("stretch").alias("most")
    )
    # Written first, so that the join has a shuffle of its own on both sides and can split a hot anchor.
    per_anchor = settle(per_anchor.where("n > 1").select("anchor", (F.col("least") != F.col("most")).alias("mixed")))
    again = settle(found.join(per_anchor, "anchor"))
    alike = again.where("NOT mixed")
    mixed = again.where("mixed").drop("mixed")
    kinds = mixed.groupBy("anchor", "stretch").agg(
        (F.count(F.lit(1)) > 1).alias("twice"), F.min(F.struct("ident", "first", "count")).alias("sample")
    )
    kinds = settle(kinds.select("anchor", "stretch", "twice", "sample.*"))
    crowded = kinds.groupBy("anchor").count().where(F.col("count") > hot).select("anchor", F.lit(True).alias("hot"))
    wanted = kinds.join(crowded, "anchor", "left")
    raw = settle(_bytes_of(texts, wanted, length).join(crowded, "anchor", "left"))
    hits = _shards(raw.where("hot IS NULL"), length, shard_bytes)
    if not raw.where("hot").isEmpty():
        hits = hits.union(_counted(raw.where("hot"), length))
    whole = kinds.where("twice").select("anchor", "stretch", F.lit(0).alias("low"), (F.col("count") - 1).alias("high"))
    hits = settle(hits.union(whole).groupBy("anchor", "stretch").agg(F.collect_list(F.struct("low", "high")).alias("hits")))
    placed = mixed.join(hits, ["anchor", "stretch"]).select(
        "ident", F.transform("hits", lambda h: F.struct((F.col("first") + h["low"]).alias("low"), (F.col("first") + h["high"]).alias("high"))).alias("starts")
    )
    every = alike.select(
        "ident", F.array(F.struct(F.col("first").alias("low"), (F.col("first") + F.col("count") - 1).alias("high"))).alias("starts")
    )
    ranges = placed.union(every).groupBy("ident").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    return settle(ranges)


def _covered(part_starts: pa.Array, sizes: np.ndarray, length: int) -> list[np.ndarray]:
    """Flags of the bytes of each text that a repeated window covers."""
    out = []
    lists = part_starts if part_starts.null_count == 0 else part_starts.fill_null([])
    rows = lists.flatten()
    low, high = rows.field("low").to_numpy(), rows.field("high").to_numpy()
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    for i, size in enumerate(sizes.tolist()):
        change = np.zeros(size + 1, np.int32)
        a, b = int(ends[i]), int(ends[i + 1])
        np.add.at(change, low[a:b], 1)
        np.add.at(change, high[a:b] + length, -1)
        out.append(np.cumsum(change[:-1]) > 0)
    return out


def _starts_type() -> pa.DataType:
    return pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """Per row: the key, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept_sha256``.

    A byte goes when a string of ``length`` bytes that covers it also starts anywhere else in the texts, in its own
    included; overlaps count, and all is judged on the texts as they are. A null text is empty; texts shorter
    than ``length`` keep all; repeated rows lose all that is long enough, as each repeats the other; an empty table
    gives no rows; other columns are not read.
    """
    ranges = repeat_ranges(docs, key, text, length, **options)
    kind = docs.schema[key]
    rows = docs.select(_ident(F.col(key), F.col(text)).alias("ident"), F.col(key), F.col(text).alias("_text"))
    found = rows.join(ranges, "ident", "left")
    schema = T.StructType([kind])
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema.add(name, T.LongType())
    schema.add("kept_sha256", T.StringType())

    def count(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                data, offsets = text_buffer(part.column("_text"))
                sizes = np.diff(offsets)
                removed, spans, digests = [], [], []
                for i, gone in enumerate(_covered(part.column("starts"), sizes, length)):
                    own = data[offsets[i] : offsets[i + 1]]
                    removed.append(int(gone.sum()))
                    spans.append(len(_runs(gone)[0]) if removed[-1] else 0)
                    digests.append(hashlib.sha256((own[~gone] if removed[-1] else own).tobytes()).hexdigest())
                columns = [part.column(kind.name), pa.array(sizes), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return found.mapInArrow(count, schema)


def cut_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str | None = "n_chars", length: int = LENGTH, **options
) -> DataFrame:
    """``docs`` without the repeated bytes of their texts, every other column as it is (``chars``, where the table
    has it, is counted anew where a text changed). A character of which a byte goes, goes. A row of which no word is left is dropped;
    a row that had none to begin with stays.
    """
    ranges = repeat_ranges(docs, key, text, length, **options)
    rows = whole_rows(docs).withColumn("ident", _ident(F.col(f"_row.{key}"), F.col(f"_row.{text}")))
    changed = rows.join(ranges, "ident", "left")
    fields = docs.schema.fields
    place = docs.columns.index(text)
    count_at = docs.columns.index(chars) if chars in docs.columns else None

    def cut(batches):
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("starts")], ["_row", "starts"])
            done = 0
            for part, texts in row_slices(pair, place):
                starts = pair.column("starts").slice(done, len(part))
                done += len(part)
                data, offsets = text_buffer(texts)
                hit = starts.is_valid().to_numpy(zero_copy_only=False)
                new, counts, keep = texts.to_pylist(), None, []
                if count_at is not None:
                    counts = part.field(count_at).to_pylist()
                for i, gone in enumerate(_covered(starts, np.diff(offsets), length)):
                    if hit[i] and gone.any():
                        own = data[offsets[i] : offsets[i + 1]]
                        # Bytes 10xxxxxx belong to the character before them.
                        head = (own & 0xC0) != 0x80
                        letter = np.cumsum(head) - 1
                        lost = np.zeros(int(head.sum()), np.bool_)
                        lost[letter[gone]] = True
                        new[i] = own[~lost[letter]].tobytes().decode()
                        if counts is not None:
                            counts[i] = len(new[i])
                        keep.append(bool(new[i].strip()))
                    else:
                        keep.append(True)
                columns = [part.field(c) for c in range(len(fields))]
                columns[place] = pa.array(new, columns[place].type)
                if counts is not None:
                    columns[count_at] = pa.array(counts, columns[count_at].type)
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields]).filter(pa.array(keep, pa.bool_()))

    return changed.select("_row", "starts").mapInArrow(cut, docs.schema)
