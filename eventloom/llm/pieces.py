"""SentencePiece BPE encoding and decoding by vectorised merge rounds over distinct words.

A text is cut where no merge can ever cross, each distinct cut is encoded once a slice, and the merges of all of
them run together: flat symbol arrays, the pair of minimum rank of every word by a segmented minimum (the
leftmost among equals), all those merges at once, compaction, until no word has a pair left.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .flat import ragged, slices

SPACE = "▁"
# Piece types of the model file, fixed values: normal 1, unknown 2, control 3, user-defined 4, unused 5, byte 6.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: A cut of more symbols is merged with a queue of pairs, so that one endless word costs n log n and not n rounds.
ROUND_SYMBOLS = 256
#: Distinct words a task remembers between slices.
REMEMBERED = 300_000


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """Field number and value of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, raw[at : at + size]
            at += size
        else:
            size = {5: 4, 1: 8}[kind]
            yield tag >> 3, raw[at : at + size]
            at += size


class PieceModel:
    """A BPE model file: pieces, scores and the settings that its normaliser needs.

    Only models that leave the text as it is (identity rule, no trimming, one space put in front, byte
    fallback) are taken; any other is refused, since it would be encoded wrongly.
    """

    def __init__(self, raw: bytes):
        pieces, scores, kinds = [], [], []
        trainer: dict[int, object] = {}
        normal: dict[int, object] = {}
        for number, value in _fields(raw):
            if number == 1:
                one = dict(_fields(value))
                pieces.append(one.get(1, b"").decode())
                scores.append(struct.unpack("<f", one[2])[0] if 2 in one else 0.0)
                kinds.append(one.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        if trainer.get(3) != 2:
            raise ValueError("not a BPE model")
        if normal.get(2) or normal.get(4, 1) or not normal.get(3, 1) or not normal.get(5, 1):
            raise ValueError("the model's normaliser changes texts")
        if any(k in (USER, UNUSED) for k in kinds):
            raise ValueError("user-defined and unused pieces are not supported")
        self.pieces = pieces
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == BYTE}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        self.normal = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == NORMAL}
        self.control = {i for i, k in enumerate(kinds) if k in (CONTROL, UNKNOWN)}
        self.plain = [b"" if i in self.control else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        for b, i in self.bytes.items():
            self.plain[i] = bytes([b])
        self.decimal = [str(i).encode() for i in range(len(pieces))]
        # Symbols: the pieces, then the characters that occur only inside pieces.
        spare = sorted({c for p in self.normal for c in p} - set(self.normal))
        self.symbols = {**self.normal, **{c: len(pieces) + k for k, c in enumerate(spare)}}
        order = sorted(self.normal, key=lambda p: (-scores[self.normal[p]], self.normal[p]))
        rank, last = {}, None
        for place, p in enumerate(order):  # equal scores share a rank
            rank[p] = rank[last] if last is not None and scores[self.normal[p]] == scores[self.normal[last]] else place
            last = p
        self.width = len(pieces) + len(spare) + 1
        # Symbol of each code point, the last place for those beyond; unknown ones have the last symbol.
        alphabet = {c: self.symbols[c] for p in self.normal for c in p}
        self.of_point = np.full(max(map(ord, alphabet), default=0) + 2, self.width - 1, np.int32)
        self.of_point[[ord(c) for c in alphabet]] = list(alphabet.values())
        self.of_byte = np.array([self.bytes[b] for b in range(256)], np.int32)
        neighbours = {p[i : i + 2] for p in self.normal for i in range(len(p) - 1)}
        self.near = np.array(sorted(alphabet[a] * self.width + alphabet[b] for a, b in neighbours) or [-1], np.int64)
        rows = []
        for p, i in self.normal.items():
            for cut in range(1, len(p)):
                left, right = self.symbols.get(p[:cut]), self.symbols.get(p[cut:])
                if left is not None and right is not None:
                    rows.append((left * self.width + right, rank[p], i))
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.merged = table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32)
        self.no_rank = len(pieces) + 1
        # Where a cut is sure: a space mark after something else, when no piece has one inside.
        self.inner_space = any(SPACE in p.lstrip(SPACE) for p in self.normal)

    # -- words --------------------------------------------------------------------------------------

    def cuts(self, text: str) -> list[str]:
        """The normal form of a text in parts that no merge crosses."""
        if not text:
            return []
        if self.inner_space:
            return [SPACE + text.replace(" ", SPACE)]
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", SPACE + text.replace(" ", SPACE))
        return [SPACE + part for part in text.split(" ")]

    # -- merging ------------------------------------------------------------------------------------

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair."""
        keys = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return np.where(known, self.ranks[at], self.no_rank), np.where(known, self.merged[at], -1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has; characters that end up in no piece become
        the ids of their bytes."""
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        symbols = self.of_point[np.minimum(points, len(self.of_point) - 1)]
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        # A part begins at a word and between characters that stand side by side in no piece.
        begins = np.ones(len(points) + 1, np.bool_)
        if len(points) > 1:
            pairs = symbols[:-1].astype(np.int64) * self.width + symbols[1:]
            begins[1:-1] = self.near[np.minimum(np.searchsorted(self.near, pairs), len(self.near) - 1)] != pairs
        begins[ends] = True
        starts = np.flatnonzero(begins)
        sizes = np.diff(starts)
        for a, n in zip(starts[:-1][sizes > ROUND_SYMBOLS].tolist(), sizes[sizes > ROUND_SYMBOLS].tolist()):
            symbols[a : a + n] = self._queue(symbols[a : a + n].tolist())
        short = np.flatnonzero((sizes > 1) & (sizes <= ROUND_SYMBOLS))
        self._merge(symbols, starts[short], sizes[short])
        places = np.flatnonzero(symbols >= 0)
        symbols = symbols[places]
        bad = symbols >= len(self.pieces)
        counts = np.ones(len(symbols), np.int64)
        if bad.any():
            odd = points[places[bad]]
            counts[bad] = 1 + (odd >= 0x80).astype(np.int64) + (odd >= 0x800) + (odd >= 0x10000)
            symbols = np.repeat(symbols, counts)
            raw = np.frombuffer("".join(map(chr, odd.tolist())).encode(), np.uint8)
            symbols[np.repeat(bad, counts)] = self.of_byte[raw]
        before = np.concatenate([[0], np.cumsum(counts)])
        return symbols, np.diff(before[np.concatenate([[0], np.searchsorted(places, ends)])])

    def _merge(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        """All merges of the given parts, in place: a merged symbol stands where its first character was, -1 where the
        others were."""
        flat_places = ragged(starts, sizes)
        if not len(flat_places):
            return
        flat, owner = symbols[flat_places], np.repeat(np.arange(len(starts), dtype=np.int32), sizes)
        symbols[flat_places] = -1
        # Pairs of neighbours; the last symbol of a part has none.
        rank, result = np.full(len(flat), self.no_rank, np.int32), np.full(len(flat), -1, np.int32)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inner], result[inner] = self._find(flat[inner], flat[inner + 1])
        while len(flat):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(flat)))
            live = best < self.no_rank
            if not live.all():
                stays = np.repeat(live, size)
                symbols[flat_places[~stays]] = flat[~stays]
                flat, owner, rank, result, flat_places = (x[stays] for x in (flat, owner, rank, result, flat_places))
                best, size = best[live], size[live]
                if not len(flat):
                    break
            # The leftmost pair of minimum rank of every part.
            hits = np.flatnonzero(rank == np.repeat(best, size))
            at = hits[np.append(True, owner[hits][1:] != owner[hits][:-1])]
            flat[at] = result[at]
            keep = np.ones(len(flat), np.bool_)
            keep[at + 1] = False
            rank[at] = self.no_rank
            after = at - np.arange(len(at))
            flat, owner, rank, result, flat_places = (x[keep] for x in (flat, owner, rank, result, flat_places))
            # Only the pairs to both sides of a merged symbol are new.
            fresh = np.concatenate([after, after[after > 0] - 1])
            fresh = fresh[fresh + 1 < len(flat)]
            rank[after] = self.no_rank
            fresh = fresh[owner[fresh] == owner[fresh + 1]]
            rank[fresh], result[fresh] = self._find(flat[fresh], flat[fresh + 1])

    def _queue(self, sym: list[int]) -> np.ndarray:
        """The same merges for one long part: a queue of pairs ordered by rank and place; -1 as in ``_merge``."""
        table = self._pair_table()
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []

        def push(i: int) -> None:
            j = after[i]
            if j < n and (found := table.get(sym[i] * self.width + sym[j])):
                heapq.heappush(queue, (found[0], i, j, sym[i], sym[j], found[1]))

        for i in range(n - 1):
            push(i)
        alive = [True] * n
        while queue:
            _, i, j, a, b, new = heapq.heappop(queue)
            if not alive[i] or after[i] != j or sym[i] != a or sym[j] != b:
                continue
            sym[i], alive[j] = new, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                push(before[i])
            push(i)
        return np.where(alive, sym, -1)

    def _pair_table(self) -> dict[int, tuple[int, int]]:
        if not hasattr(self, "_table"):
            self._table = {k: (r, m) for k, r, m in zip(self.keys.tolist(), self.ranks.tolist(), self.merged.tolist())}
        return self._table

    def decode(self, ids: list[int]) -> str:
        """Text of the pieces without the space put in front; control pieces have none."""
        return b"".join(map(self.plain.__getitem__, ids))[1:].decode("utf-8", "replace")


class Encoder:
    """Encodes lists of texts; remembers the ids of words between calls, ``REMEMBERED`` at most beside those of the call."""

    def __init__(self, model: PieceModel, end: int):
        self.model, self.end = model, end
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def _forget(self, wanted: set[str]) -> None:
        """Only the words that are wanted now stay."""
        kept = [w for w in wanted if w in self.known]
        at = np.fromiter(map(self.known.__getitem__, kept), np.int64, len(kept))
        sizes = self.starts[at + 1] - self.starts[at]
        self.ids = self.ids[ragged(self.starts[at], sizes)]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.known = dict(zip(kept, range(len(kept))))

    def _learn(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self.known]
        if not fresh:
            return
        if len(self.known) + len(fresh) > REMEMBERED and self.known:
            self._forget(words)
        ids, sizes = self.model.encode_words(fresh)
        n = len(self.known)
        self.known.update(zip(fresh, range(n, n + len(fresh))))
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The words of each text as places in the memory."""
        cut = [self.model.cuts(t) for t in texts]
        self._learn(set().union(*cut))
        get = self.known.__getitem__
        return [list(map(get, words)) for words in cut]

    def flat_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, with the end id of each text, and the n + 1 offsets of the texts."""
        cut = [self.model.cuts(t) for t in texts]
        self._learn(set().union(*cut))
        words = [len(c) for c in cut]
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, sum(words))
        sizes = self.starts[at + 1] - self.starts[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(words, dtype=np.int64)])]
        flat = np.insert(self.ids[ragged(self.starts[at], sizes)], ends[1:], self.end)
        return flat, ends + np.arange(len(ends))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        flat, ends = self.flat_ids(texts)
        return np.split(flat, ends[1:-1]) if texts else []

    def decoded(self, places: list[int]) -> str:
        at = np.array(places, np.int64)
        return self.model.decode(self.ids[ragged(self.starts[at], self.starts[at + 1] - self.starts[at])].tolist())

    def digests(self, texts: list[str]) -> tuple[list[int], list[str], list[str]]:
        """Count of ids, digest of the decimal ids and digest of the decoded text."""
        of_ids, of_text, decimal = [], [], self.model.decimal.__getitem__
        end = str(self.end).encode()
        flat, ends = self.flat_ids(texts)
        for a, b in zip(ends.tolist(), ends[1:].tolist()):
            ids = flat[a : b - 1].tolist()
            of_ids.append(hashlib.sha256(b" ".join([*map(decimal, ids), end])).hexdigest())
            of_text.append(hashlib.sha256(self.model.decode(ids).encode()).hexdigest())
        return np.diff(ends).tolist(), of_ids, of_text


def _model(path: str) -> PieceModel:
    with open(path, "rb") as f:
        return PieceModel(f.read())


def _encoders(docs: DataFrame, model_file: str, end: int):
    """What makes an encoder in a task: the model file is read once, and its tables travel by broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(_model(model_file)))

    def encoder() -> Encoder:
        model = PieceModel.__new__(PieceModel)
        vars(model).update(shared.value)
        return Encoder(model, end)

    return encoder


def encode(docs: DataFrame, model_file: str, end: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``ids`` (the end id last) and ``decoded``.

    A null or empty text has the end id alone and decodes to nothing; repeated rows are encoded alike; an empty
    table gives no rows; other columns are not read. ``model_file`` is a path the driver has.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType().add(key, kind).add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())

    new_encoder = _encoders(docs, model_file, end)

    def run(batches):
        encoder = new_encoder()
        for batch in batches:
            for part in slices(batch, text):
                flat, ends = encoder.flat_ids([t or "" for t in part.column(text).to_pylist()])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                bounds = zip(ends.tolist(), ends[1:].tolist())
                plain = pa.array([encoder.model.decode(flat[a : b - 1].tolist()) for a, b in bounds], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(key), ids, plain], [key, "ids", "decoded"])

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def digests(docs: DataFrame, model_file: str, end: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``. Rows as in ``encode``."""
    kind = docs.schema[key].dataType
    schema = (
        T.StructType()
        .add(key, kind)
        .add("n_tokens", T.LongType())
        .add("ids_sha256", T.StringType())
        .add("decoded_sha256", T.StringType())
    )

    new_encoder = _encoders(docs, model_file, end)

    def run(batches):
        encoder = new_encoder()
        for batch in batches:
            for part in slices(batch, text):
                found = encoder.digests([t or "" for t in part.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), pa.array(found[0], pa.int64()), pa.array(found[1]), pa.array(found[2])],
                    schema.names,
                )

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)
