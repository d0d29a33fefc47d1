"""Texts of an Arrow batch as one flat byte array, cut into words and fingerprinted without a loop per word.

Every function works on slices of a batch that hold a few MB of text, so memory follows the slice or the
longest single text, never the batch or the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64
# Odd 64-bit constants of the polynomial and the finisher.
_BASE = 0x9E3779B97F4A7C15
_MIX1 = 0xBF58476D1CE4E5B9
_MIX2 = 0x94D049BB133111EB


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finisher that spreads every input bit over 64 bits."""
    x = (x ^ (x >> U64(30))) * U64(_MIX1)
    x = (x ^ (x >> U64(27))) * U64(_MIX2)
    return x ^ (x >> U64(31))


def byte_class(members: bytes | range) -> np.ndarray:
    """256 flags: which bytes belong to a word."""
    flags = np.zeros(256, np.bool_)
    flags[list(members)] = True
    return flags


# Words are what lies between the six white-space bytes.
SPACE_WORDS = byte_class([b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D])
# Words are ASCII letters and digits and everything beyond ASCII.
ALNUM_WORDS = byte_class(
    [b for b in range(256) if b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A]
)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def byte_values(seed: int, fold: bool) -> np.ndarray:
    """A random 64-bit value a byte; with ``fold`` A-Z share those of a-z."""
    values = mix(np.arange(1, 257, dtype=U64) * U64(_BASE) + U64(seed))
    return values[LOWER] if fold else values


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``limit`` bytes of text, or a single longer row."""
    if not batch.num_rows:
        return
    offsets = text_buffer(batch.column(column))[1]
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def whole_rows(docs):
    """Every row as one struct ``_row``, so that no helper column can clash with a column of the table."""
    from pyspark.sql import functions as F

    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def row_slices(batch: pa.RecordBatch, field: int, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, pa.Array]]:
    """``slices`` of a batch of ``whole_rows`` by its text field: the rows and their texts."""
    rows = batch.column(0)
    texts = pa.RecordBatch.from_arrays([rows, rows.field(field)], ["rows", "texts"])
    for part in slices(texts, "texts", limit):
        yield part.column("rows"), part.column("texts")


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and the n + 1 offsets; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not (pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)):
        texts = texts.cast(pa.large_binary() if pa.types.is_binary(texts.type) else pa.large_string())
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_large_binary(texts.type) else "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64, len(texts) + 1, texts.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return flat, offsets - offsets[0]


class Hasher:
    """Fingerprints of byte ranges by prefix sums of a polynomial modulo 2**64 over random byte values.

    Equal ranges have equal fingerprints; different ones share one with a chance of about 2**-60.
    """

    def __init__(self, seed: int = 1, fold: bool = False):
        self.values = byte_values(seed, fold)
        self.base = (_BASE * (2 * seed + 1)) % 2**64 | 5
        self.inverse = pow(self.base, -1, 2**64)
        self.powers = self.inverses = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            size = max(n + 1, 2 * len(self.powers))
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(size, base, U64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        """n + 1 prefix sums, to be cut by ``ranges``."""
        self._grow(len(data))
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (sums[ends] - sums[starts]) * self.inverses[starts]
        return mix(raw + (ends - starts).astype(U64) * U64(_MIX1))


def words(data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; a word never crosses a text's end."""
    inside = members[data]
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, np.bool_)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets[1:], starts, "right")


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each of the ranges that ``offsets`` bound."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def bounds(groups: np.ndarray, n: int) -> np.ndarray:
    """n + 1 offsets of the sorted group numbers ``groups``."""
    return np.searchsorted(groups, np.arange(n + 1))


def windows(hashes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and fingerprint of each run of ``size`` words inside one text."""
    if len(hashes) < size:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    n = len(hashes) - size + 1
    total = np.zeros(n, U64)
    for k in range(size):
        total = mix(total + hashes[k : k + n] * U64(_BASE + 2 * k))
    starts = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return starts, total[starts]


def covered(starts: np.ndarray, length: int | np.ndarray, n: int) -> np.ndarray:
    """Flags of the positions 0..n-1 inside one of the runs."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + length, n), -1)
    return np.cumsum(change[:-1]) > 0


def repeated(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys that occur at least twice."""
    if len(keys) < 2:
        return np.zeros(len(keys), np.bool_)
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.zeros(len(keys), np.bool_)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def first_seen(keys: np.ndarray) -> np.ndarray:
    """Flags of the first occurrence of each key."""
    flags = np.zeros(len(keys), np.bool_)
    flags[np.unique(keys, return_index=True)[1]] = True
    return flags


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0]..starts[0]+lengths[0]-1, starts[1].. and so on, in one flat array."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths - np.asarray(starts, np.int64), lengths)
