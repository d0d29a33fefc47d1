"""Token ids in Arrow IPC files of fixed-size-list batches: equal-length sequences and their masks.

A file holds whole documents, one after the other; their ids are cut into sequences of the same length, the last
one padded and masked. The values of a batch lie in one plain buffer, so any sequence or document is a view of
the mapped file. A second small file beside it names the documents and their lengths.
"""

from __future__ import annotations

import json
import os
import re
import sys
import uuid
import zlib
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle
from .flat import byte_class, ragged, slices, text_buffer

SEQUENCE = 2048
BATCH_SEQUENCES = 256
#: Distinct cuts of text that an encoder learns before it forgets those it has not met since the last time.
REMEMBERED = 400_000
#: Cuts that are encoded as one line, and lines at a time.
TOGETHER, LINES = 256, 64
TEXT_SLICE = 8 << 20
_PLAIN = re.compile(r" [^\s\x00-\x1f\x7f]+\Z")

_WHITE = byte_class([0x20, *range(0x09, 0x0E)])
_LINES = byte_class(range(0x09, 0x0E))
_SEEN = byte_class(range(0x21, 0x7F))
_ALNUM = byte_class([b for b in range(0x30, 0x7B) if chr(b).isalnum()])
_MARKS = _SEEN & ~_ALNUM
# First bytes of characters that are not white space; those of _UNSURE are also the first of some that are.
_SOLID = _SEEN | byte_class(range(0xC2, 0xF5))
_UNSURE = byte_class([0xC2, 0xE1, 0xE2, 0xE3])
# First bytes of two-byte characters that are all letters, but for the signs C3 97 and C3 B7.
_LETTERS = byte_class([*range(0xC3, 0xCA), 0xD0, 0xD1])

MANIFEST = (
    T.StructType()
    .add("part", T.IntegerType())
    .add("ids_file", T.StringType())
    .add("docs_file", T.StringType())
    .add("n_docs", T.LongType())
    .add("n_ids", T.LongType())
)


def cut_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions at which texts can be cut and their cuts encoded one by one, each text's start among them.

    A byte-level pre-tokenizer starts a new piece there whatever lies around: at the last white space before something
    else, after it unless it is a space, where white space begins, and between a letter or digit and a mark. Where
    characters beyond ASCII could be white space, texts are not cut.
    """
    n = len(data)
    at = np.zeros(n + 1, np.bool_)
    if n:
        white, seen = _WHITE[data], _SEEN[data]
        solid = _SOLID[data]
        unsure = np.flatnonzero(_UNSURE[data])
        first, second = data[unsure], data[np.minimum(unsure + 1, n - 1)]
        third = data[np.minimum(unsure + 2, n - 1)]
        solid[unsure] = (
            ((first == 0xC2) & (second != 0x85) & (second != 0xA0))
            | ((first == 0xE1) & (second != 0x9A) & (second != 0xA0))
            | ((first == 0xE2) & (second > 0x81))
            | ((first == 0xE2) & (second == 0x80) & (third >= 0x90) & (third < 0xA8))
            | ((first == 0xE3) & ((second != 0x80) | (third != 0x80)))
        )
        at[: n - 1] = white[:-1] & solid[1:]
        at[offsets[1:] - 1] = False  # the next byte is another text's; an empty first text clears the spare place
        named = _ALNUM[data]
        named[1:] |= _LETTERS[data[:-1]] & (data[1:] != 0x97) & (data[1:] != 0xB7)
        at[1:n] |= (_LINES[data[:-1]] & solid[1:]) | (seen[:-1] & white[1:]) | (named[:-1] & _MARKS[data[1:]])
        at[offsets[:-1]] = True
    return np.flatnonzero(at[:n])


class Encoder:
    """Ids of texts by a tokenizer file.

    With a byte-level pre-tokenizer texts are cut where it always starts a new piece (``cut_starts``), and each
    distinct cut is encoded once. With any other pre-tokenizer whole texts are encoded, and so is a text that holds
    the string of an added token, which the library finds before it looks at pieces.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        self.cuts = (
            spec.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
        )
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.cuts = self.cuts and not any(re.search(r"\s", a) for a in self.added)  # cuts would be joined to one
        size = self.tokenizer.get_vocab_size()
        self.width = np.uint16 if size <= 1 << 16 else np.uint32
        # Ids whose piece starts with a space, in the alphabet of byte-level pieces.
        pieces = map(self.tokenizer.id_to_token, range(size))
        self.spaced = np.fromiter((bool(p) and p[0] == "\u0120" for p in pieces), np.bool_, size)
        self._reset()
        self.older = self.known, self.ids, self.starts

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.new_ids: list[np.ndarray] = []
        self.new_sizes: list[np.ndarray] = []
        self.ids = np.zeros(0, self.width)
        self.starts = np.zeros(1, np.int64)

    def _learn(self, wanted: list[str]) -> None:
        fresh = [w for w in wanted if w not in self.known]
        if self.known and len(self.known) + len(fresh) > REMEMBERED:
            self.older = self.known, self.ids, self.starts
            self._reset()
            fresh = wanted
        older, ids, starts = self.older
        again = [w for w in fresh if w in older]
        if again:
            places = np.fromiter(map(older.__getitem__, again), np.int64, len(again))
            sizes = starts[places + 1] - starts[places]
            self._remember(again, ids[ragged(starts[places], sizes)], sizes)
            fresh = [w for w in fresh if w not in older]
        # A cut that starts with its only space can be encoded among others: each begins with the one id that starts
        # with a space. The others, first cuts of a text among them, are encoded one by one.
        plain, odd = [], []
        for w in fresh:
            (plain if _PLAIN.match(w) else odd).append(w)
        for first in range(0, len(plain), TOGETHER * LINES):
            some = plain[first : first + TOGETHER * LINES]
            lines = [some[i : i + TOGETHER] for i in range(0, len(some), TOGETHER)]
            found = self._ids(["".join(line) for line in lines])
            for line, ids in zip(lines, found):
                begins = np.flatnonzero(self.spaced[ids])
                if len(begins) != len(line) or begins[0]:
                    raise ValueError("the pre-tokenizer does not cut at spaces")
                self._remember(line, ids, np.diff(np.append(begins, len(ids))))
        for first in range(0, len(odd), TOGETHER):
            some = odd[first : first + TOGETHER]
            found = self._ids(some)
            self._remember(some, np.concatenate(found), np.array([len(ids) for ids in found]))
        self._settle()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.width) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _remember(self, cuts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(cuts, range(len(self.known), len(self.known) + len(cuts))))
        self.new_ids.append(ids)
        self.new_sizes.append(sizes)

    def _settle(self) -> None:
        if self.new_ids:
            sizes = np.concatenate(self.new_sizes)
            self.ids = np.concatenate([self.ids, *self.new_ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            self.new_ids, self.new_sizes = [], []

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the n + 1 offsets of the texts; a null is empty."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string())
        if not self.cuts:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts.fill_null("").to_pylist(), add_special_tokens=False)]
            sizes = [len(x) for x in found]
            flat = np.fromiter(chain.from_iterable(found), self.width, sum(sizes))
            return flat, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        holds = np.zeros(len(texts), np.bool_)
        for a in self.added:
            holds |= pc.match_substring(texts, a).fill_null(False).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(holds)
        if len(whole):
            flat, ends = self._encode_cuts(pc.if_else(pa.array(holds), "", texts))
            at = ends[whole]
            found = self._ids(texts.take(pa.array(whole)).to_pylist())
            sizes = np.diff(ends)
            sizes[whole] = [len(ids) for ids in found]
            flat = np.insert(flat, np.repeat(at, sizes[whole]), np.concatenate(found))
            return flat, np.concatenate([[0], np.cumsum(sizes)])
        return self._encode_cuts(texts)

    def _encode_cuts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_buffer(texts)
        cuts = cut_starts(data, offsets)
        buffers = [None, pa.py_buffer(np.append(cuts, len(data))), pa.py_buffer(np.ascontiguousarray(data))]
        coded = pa.Array.from_buffers(pa.large_string(), len(cuts), buffers).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn(distinct)
        places = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        firsts = self.starts[places]
        sizes = self.starts[places + 1] - firsts
        flat = self.ids[ragged(firsts, sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return flat, ends[np.searchsorted(cuts, offsets)]


def kept_encoder(path: str) -> Encoder:
    """The encoder of a file that this Python worker has, for all its tasks. Functions of the package travel by value,
    so a global of this module would be a new one in every task."""
    held = sys.modules.setdefault("_eventloom_held", ModuleType("_eventloom_held"))
    encoders = vars(held).setdefault("encoders", {})
    if path not in encoders:
        encoders.clear()
        encoders[path] = Encoder(path)
    return encoders[path]


def sequence_schema(width: type, length: int = SEQUENCE) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(width), length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Writes ids as they come; holds one batch of sequences."""

    def __init__(self, sink, width: type, length: int = SEQUENCE, batch: int = BATCH_SEQUENCES):
        self.schema = sequence_schema(width, length)
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.width, self.length, self.room = width, length, length * batch
        self.held: list[np.ndarray] = []
        self.count = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        while len(ids):
            part, ids = ids[: self.room - self.count], ids[self.room - self.count :]
            self.held.append(part.astype(self.width, copy=False))
            self.count += len(part)
            if self.count == self.room:
                self._write()

    def _write(self) -> None:
        if not self.count:
            return
        values = np.concatenate(self.held)
        padding = -len(values) % self.length
        mask = np.ones(len(values) + padding, np.bool_)
        mask[len(values) :] = False
        values = np.concatenate([values, np.zeros(padding, self.width)])
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.total += self.count
        self.held, self.count = [], 0

    def close(self) -> int:
        self._write()
        self.writer.close()
        return self.total


class SequenceFile:
    """Random access to the sequences of one file; over a mapped file nothing is copied."""

    def __init__(self, source):
        self.reader = pa.ipc.open_file(source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.sizes = None

    def batches(self):
        """Ids of each batch as one flat view, without the padding of the last."""
        for i in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(i)
            ids = batch.column("ids").flatten().to_numpy()
            if i == self.reader.num_record_batches - 1:
                ids = ids[: int(batch.column("mask").flatten().true_count)]
            yield ids

    def sequence(self, i: int, batch: int = BATCH_SEQUENCES) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of the i-th sequence."""
        rows = self.reader.get_batch(i // batch)
        return (
            rows.column("ids")[i % batch].values.to_numpy(),
            rows.column("mask")[i % batch].values.to_numpy(zero_copy_only=False),
        )


def _open(path: str):
    """A mapped file where the folder is a local one, else the store's own random access."""
    files, inner = pa.fs.FileSystem.from_uri(path)
    return pa.memory_map(inner) if isinstance(files, pa.fs.LocalFileSystem) else files.open_input_file(inner)


def write_files(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    end: int = 2,
    key: str = "doc_id",
    text: str = "text",
    length: int = SEQUENCE,
) -> DataFrame:
    """Encode every text, append ``end`` and write the files in ascending order of the key; returns the manifest.

    The texts are range-partitioned by key (equal keys by a hash of the text), so the files are in global order and
    no task holds more than one batch of ids. Names hold a random part and only the manifest counts: a task
    that runs again leaves an unused file and nothing else. ``folder`` is a URI that all executors reach.
    A null or empty text is the end id alone; null keys come first; an empty table writes no file; other columns
    are not read.
    """
    ordered = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"))
    ordered = ordered.withColumn("_tie", F.xxhash64("_text")).repartitionByRange("_key", "_tie")
    ordered = ordered.sortWithinPartitions("_key", "_tie", "_text").drop("_tie")

    def write(batches):
        encoder = writer = None
        for batch in batches:
            for part in slices(batch, "_text", TEXT_SLICE):
                if writer is None:
                    encoder = kept_encoder(tokenizer_file)
                    files, base = pa.fs.FileSystem.from_uri(folder)
                    files.create_dir(base, recursive=True)
                    number = TaskContext.get().partitionId()
                    name = f"{number:06d}-{uuid.uuid4().hex}"
                    sink = files.open_output_stream(f"{base}/{name}.ids.arrow")
                    writer = SequenceWriter(sink, encoder.width, length)
                    docs_sink = files.open_output_stream(f"{base}/{name}.docs.arrow")
                    index_schema = pa.schema([("key", pa.int64()), ("n_ids", pa.int64())])
                    index = pa.ipc.new_file(docs_sink, index_schema)
                    n_docs = 0
                flat, ends = encoder.encode(part.column("_text"))
                writer.add(np.insert(flat, ends[1:], end))
                sizes = np.diff(ends) + 1
                index.write_batch(pa.RecordBatch.from_arrays([part.column("_key"), pa.array(sizes)], schema=index_schema))
                n_docs += part.num_rows
        if writer is not None:
            total = writer.close()
            index.close()
            sink.close()
            docs_sink.close()
            row = [[number], [f"{folder}/{name}.ids.arrow"], [f"{folder}/{name}.docs.arrow"], [n_docs], [total]]
            types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], MANIFEST.names)

    return settle(ordered.mapInArrow(write, MANIFEST))


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: key, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = manifest.withColumn("_start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    files = files.repartition(max(1, manifest.count()))
    names = ["key", "start", "n_tokens", "ids_crc32"]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["docs_file"]) as source, _open(row["ids_file"]) as data:
                    index = pa.ipc.open_file(source).read_all()
                    sizes = index.column("n_ids").to_numpy()
                    starts = row["_start"] + np.cumsum(sizes) - sizes
                    sums = []
                    todo, crc, at = iter(sizes.tolist()), 0, 0
                    left = next(todo, None)
                    for ids in SequenceFile(data).batches():
                        wide = memoryview(ids.astype("<u4")).cast("B")
                        at = 0
                        while left is not None and at < len(wide):
                            took = min(4 * left, len(wide) - at)
                            crc = zlib.crc32(wide[at : at + took], crc)
                            at += took
                            left -= took // 4
                            if not left:
                                sums.append(crc)
                                crc, left = 0, next(todo, None)
                    for first in range(0, len(sums), 65_536):
                        last = first + 65_536
                        yield pa.RecordBatch.from_arrays(
                            [
                                index.column("key").slice(first, 65_536).combine_chunks(),
                                pa.array(starts[first:last], pa.int64()),
                                pa.array(sizes[first:last], pa.int64()),
                                pa.array(sums[first:last], pa.int64()),
                            ],
                            names,
                        )

    return files.mapInArrow(read, schema)
