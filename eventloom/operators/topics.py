"""The topics' fit in tasks: cells ``(doc, term, n)`` of a chunk of terms as arrays, and the rounds over them.

A block holds all cells of some terms of one cluster: the texts it sees (by a 64-bit key), a place among them and a count
for each cell, and the number of cells of each term. The shares of a cell follow from the sums of its term and its text,
so no share is ever kept: a round takes a block's sums by term and the texts' factors, and makes both sums anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Cells that are dealt to chunks, hashed, and multiplied at a time.
PACK, HASHED, SLICE = 1 << 18, 1 << 13, 1 << 17
# Cells of a batch of counts.
EMITTED = 100_000
# Shares of weights that round to the same ninth digit differ by less.
ROUNDED = 2e-9

PACKED = "chunk int, cid int, keys binary, docs binary, at binary, n binary, terms binary"
SUMS = "bucket int, cid int, v bigint, docs binary, d binary"
BLOCKS = "chunk int, cid int, docs binary, at binary, n binary, runs binary, terms binary, t binary, d binary"
_PACKED = pa.schema([("chunk", pa.int32()), ("cid", pa.int32()), *[(c, pa.binary()) for c in ("keys", "docs", "at", "n", "terms")]])
_SUMS = pa.schema([("bucket", pa.int32()), ("cid", pa.int32()), ("v", pa.int64()), ("docs", pa.binary()), ("d", pa.binary())])
BLOCK = pa.schema(
    [("chunk", pa.int32()), ("cid", pa.int32()), *[(c, pa.binary()) for c in ("docs", "at", "n", "runs", "terms", "t", "d")]]
)

_SHIFTS = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_SINES = [np.uint32(int(abs(np.sin(i + 1.0)) * 2.0**32)) for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def md5_words(blocks: np.ndarray) -> list[np.ndarray]:
    """The four words of the md5 of padded messages, a row of 16 words a block each, all rows at once."""
    words = np.ascontiguousarray(blocks.T)
    state = [np.full(words.shape[1], s, np.uint32) for s in _START]
    for first in range(0, len(words), 16):
        a, b, c, d = state
        for i in range(64):
            if i < 16:
                f, g = d ^ (b & (c ^ d)), i
            elif i < 32:
                f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
            elif i < 48:
                f, g = b ^ c ^ d, (3 * i + 5) % 16
            else:
                f, g = c ^ (b | ~d), (7 * i) % 16
            f += a
            f += words[first + g]
            f += _SINES[i]
            left = f << np.uint32(_SHIFTS[i])
            f >>= np.uint32(32 - _SHIFTS[i])
            left |= f
            left += b
            a, b, c, d = d, left, b, c
        state = [x + y for x, y in zip(state, (a, b, c, d))]
    return state


def lots(messages: pa.Array, n_topics: int) -> np.ndarray:
    """``(topic, message)``: 1 and the first 48 bits of the md5 of message and topic, as a share of 2 to the 48."""
    out = np.empty((n_topics, len(messages)))
    for begin in range(0, len(messages), HASHED):
        some = messages.slice(begin, HASHED)
        size = pc.binary_length(some).to_numpy(zero_copy_only=False).astype(np.int64)
        for k in range(n_topics):
            tail = str(k).encode()
            full = size + len(tail)
            blocks = (full + 8) // 64 + 1
            for b in np.unique(blocks):
                rows = np.flatnonzero(blocks == b)
                padded = pc.ascii_rpad(some.take(pa.array(rows)), int(b) * 64, "\0")
                data = np.frombuffer(padded.buffers()[2], np.uint8, len(rows) * int(b) * 64, padded.offset * int(b) * 64)
                data, here = data.reshape(len(rows), -1).copy(), np.arange(len(rows))
                for i, byte in enumerate(tail):
                    data[here, size[rows] + i] = byte
                data[here, full[rows]] = 0x80
                data[:, -8:] = (full[rows] * 8).astype("<u8").view(np.uint8).reshape(-1, 8)
                one, two = (x.byteswap().astype(np.int64) for x in md5_words(data.view("<u4"))[:2])
                out[k, begin + rows] = 1 + ((one << 16) | (two >> 16)) / 2.0**48
    return out


def count_words(batches: Iterable[pa.RecordBatch], stop: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """``(cluster, doc, term, n)`` from ``(cluster, doc, copies, words)`` with a row a text."""
    left_out = pa.array(list(stop), pa.string())
    for batch in batches:
        cluster, doc, copies, words = batch.columns
        sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
        flat = words.flatten().dictionary_encode()
        terms, codes = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        kept = ~pc.is_in(terms, left_out).to_numpy(zero_copy_only=False)
        key = np.repeat(np.arange(len(doc), dtype=np.int64), sizes) * max(len(terms), 1) + codes
        key, n = np.unique(key[kept[codes]], return_counts=True)
        row, code = np.divmod(key, max(len(terms), 1))
        n = n * copies.to_numpy(zero_copy_only=False)[row]
        for begin in range(0, len(row), EMITTED):
            some = slice(begin, begin + EMITTED)
            at = pa.array(row[some])
            columns = [cluster.take(at), doc.take(at), terms.take(pa.array(code[some])), pa.array(n[some], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "doc", "term", "n"])


def _to_bytes(strings: pa.Array) -> bytes:
    batch = pa.RecordBatch.from_arrays([strings], ["string"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_bytes(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_next_batch().column(0)


def _string(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(chunk, cid, key, doc, term, n)`` as a row of arrays for each chunk and cluster; a text is named once there."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        chunk, cid, key, n = (table.column(c).to_numpy() for c in ("chunk", "cid", "key", "n"))
        doc, term = (_string(table.column(c)) for c in ("doc", "term"))
        order = np.lexsort((key, cid, chunk))
        chunk, cid, key, n, term = chunk[order], cid[order], key[order], n[order], term.take(pa.array(order))
        new = np.diff(chunk, prepend=-1) != 0
        new[1:] |= np.diff(cid) != 0
        text = new.copy()
        text[1:] |= np.diff(key) != 0
        begins, texts = np.flatnonzero(new), np.flatnonzero(text)
        ends = np.append(begins[1:], len(chunk))
        at = np.cumsum(text)
        own = list(zip(begins, ends, np.searchsorted(texts, begins), np.searchsorted(texts, ends)))
        doc = doc.take(pa.array(order[texts]))
        columns = [
            pa.array(chunk[begins], pa.int32()),
            pa.array(cid[begins], pa.int32()),
            pa.array([key[texts[u:v]].tobytes() for _, _, u, v in own], pa.binary()),
            pa.array([_to_bytes(doc.slice(u, v - u)) for _, _, u, v in own], pa.binary()),
            pa.array([(at[a:b] - at[a]).astype(np.int32).tobytes() for a, b, _, _ in own], pa.binary()),
            pa.array([n[a:b].astype(np.int64).tobytes() for a, b, _, _ in own], pa.binary()),
            pa.array([_to_bytes(term.slice(a, b - a)) for a, b, _, _ in own], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_PACKED)

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= PACK:
            yield packed(held)
            held, size = [], 0
    if held:
        yield packed(held)


def build(batches: Iterable[pa.RecordBatch], n_topics: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a partition's packed rows, with the sums of the first shares."""
    parts: dict[tuple[int, int], list[tuple]] = {}
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            parts.setdefault(row[:2], []).append(row[2:])
    while parts:
        (chunk, cid), rows = parts.popitem()
        held: list[list] = [[], [], [], []]
        while rows:
            keys, docs, at, n, terms = rows.pop()
            at, terms = np.frombuffer(at, np.int32), _from_bytes(terms)
            first = lots(pc.binary_join_element_wise(str(seed), _from_bytes(docs).take(pa.array(at)), terms, "", ":"), n_topics)
            for values, x in zip(held, (np.frombuffer(keys, np.int64)[at], np.frombuffer(n, np.int64).astype(float), first / first.sum(0), terms)):
                values.append(x)
        terms = pa.concat_arrays(held.pop()).dictionary_encode()
        share = np.concatenate(held.pop(), axis=1)
        n = np.concatenate(held.pop())
        key = np.concatenate(held.pop())
        codes = terms.indices.to_numpy(zero_copy_only=False)
        docs, at = np.unique(key, return_inverse=True)
        size = len(terms.dictionary)
        t = np.array([np.bincount(codes, n * x, size) for x in share])
        d = np.array([np.bincount(at, n * x, len(docs)) for x in share])
        order = np.argsort(codes, kind="stable")
        runs = np.bincount(codes, minlength=size)
        at, n = _least(at[order], len(docs), np.uint16, np.int32), _least(n[order], n.max() + 1, np.uint8, np.float64)
        yield _block(
            chunk, cid, docs.tobytes(), at.tobytes(), n.tobytes(), runs.astype(np.int32).tobytes(), _to_bytes(terms.dictionary),
            t.tobytes(), d.tobytes(),
        )


def _least(values: np.ndarray, beyond: float, small: type, large: type) -> np.ndarray:
    return values.astype(small if beyond <= np.iinfo(small).max + 1 else large)


def _read(data: bytes, cells: int, *kinds: type) -> np.ndarray:
    """Values of that kind whose size is theirs."""
    return np.frombuffer(data, next(kind for kind in kinds if np.dtype(kind).itemsize * cells == len(data)))


def _block(*values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, BLOCK)], schema=BLOCK)


def _rows(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def step(
    batches: Iterable[pa.RecordBatch], factors: Callable[[np.ndarray], np.ndarray], n_topics: int
) -> Iterator[pa.RecordBatch]:
    """The blocks after a round; ``factors`` has those of given texts, a row a topic."""
    prior = 1 / n_topics
    for batch in batches:
        for row in _rows(batch):
            docs, runs = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["runs"], np.int32)
            old = np.frombuffer(row["t"]).reshape(n_topics, -1) + prior
            e = factors(docs)
            t, d = np.empty_like(old), np.zeros((n_topics, len(docs)))
            ends = np.cumsum(runs, dtype=np.int64)
            at, n = _read(row["at"], ends[-1], np.uint16, np.int32), _read(row["n"], ends[-1], np.uint8, np.float64)
            cuts = np.unique([0, *np.searchsorted(ends, np.arange(SLICE, len(at), SLICE)), len(runs)])
            for a, b in zip(cuts[:-1], cuts[1:]):  # terms of a slice
                begin, end = ends[a] - runs[a], ends[b - 1]
                here = at[begin:end]
                q = [np.repeat(old[k, a:b], runs[a:b]) * e[k][here] for k in range(n_topics)]
                scale = n[begin:end] / sum(q)
                for k in range(n_topics):
                    q[k] *= scale
                    t[k, a:b] = np.add.reduceat(q[k], ends[a:b] - runs[a:b] - begin)
                    d[k] += np.bincount(here, q[k], len(docs))
            yield _block(*[row[c] for c in BLOCK.names[:-2]], t.tobytes(), d.tobytes())


def sums_by_bucket(batches: Iterable[pa.RecordBatch], n_topics: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The blocks' sums by text, cut into ranges of keys; one of a block's rows has the number of its terms."""
    edges = [(1 << 64) // buckets * i - (1 << 63) for i in range(1, buckets)]
    for batch in batches:
        for row in _rows(batch):
            docs, d = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["d"]).reshape(n_topics, -1)
            cuts = [0, *np.searchsorted(docs, np.array(edges, np.int64)), len(docs)]
            some = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            terms = [len(row["runs"]) // 4, *[0] * (len(some) - 1)]
            columns = [
                [i for i, _, _ in some], [row["cid"]] * len(some), terms,
                [docs[a:b].tobytes() for _, a, b in some], [d[:, a:b].tobytes() for _, a, b in some],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SUMS)], schema=_SUMS)


def sums_of_texts(batches: Iterable[pa.RecordBatch], n_topics: int) -> Iterator[pa.RecordBatch]:
    """``(cid, doc, d0, d1, ..., v)`` with a row a text, from the rows of its bucket."""
    parts: dict[int, list[tuple]] = {}
    for batch in batches:
        for _, cid, v, docs, d in zip(*[c.to_pylist() for c in batch.columns]):
            parts.setdefault(cid, []).append((v, np.frombuffer(docs, np.int64), np.frombuffer(d).reshape(n_topics, -1)))
    names = ["cid", "doc", *[f"d{k}" for k in range(n_topics)], "v"]
    while parts:
        cid, rows = parts.popitem()
        docs, at = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
        d = [np.bincount(at, np.concatenate([r[2][k] for r in rows]), len(docs)) for k in range(n_topics)]
        v = np.zeros(len(docs), np.int64)
        v[0] = sum(r[0] for r in rows)
        for a in range(0, len(docs), EMITTED):
            some = slice(a, a + EMITTED)
            columns = [np.full(len(docs[some]), cid, np.int32), docs[some], *[x[some] for x in d], v[some]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def texts_of_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(chunk, doc)`` of the texts that a chunk's blocks see."""
    for batch in batches:
        for row in _rows(batch):
            docs = np.frombuffer(row["docs"], np.int64)
            for a in range(0, len(docs), EMITTED):
                some = docs[a : a + EMITTED]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), row["chunk"], np.int32)), pa.array(some)], ["chunk", "doc"])


def factors_of(table: pa.Table, n_topics: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and factors of texts from ``(doc, e0, e1, ...)``."""
    docs = table.column("doc").to_numpy()
    order = np.argsort(docs)
    return docs[order], np.array([table.column(f"e{k}").to_numpy()[order] for k in range(n_topics)])


def found(docs: np.ndarray, keys: np.ndarray, e: np.ndarray) -> np.ndarray:
    return e[:, np.searchsorted(keys, docs)]


def weights_of_terms(batches: Iterable[pa.RecordBatch], n_topics: int) -> Iterator[pa.RecordBatch]:
    """``(cid, term, weights)`` of the blocks."""
    for batch in batches:
        for row in _rows(batch):
            terms, t = _from_bytes(row["terms"]), np.frombuffer(row["t"]).reshape(n_topics, -1).T
            for a in range(0, len(terms), EMITTED):
                some = t[a : a + EMITTED]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, some.size + 1, n_topics, dtype=np.int32)), pa.array(some.ravel()))
                columns = [pa.array(np.full(len(some), row["cid"], np.int32)), terms.slice(a, EMITTED), lists]
                yield pa.RecordBatch.from_arrays(columns, ["cid", "term", "weights"])


def foremost(batches: Iterable[pa.RecordBatch], most: int, n_topics: int) -> Iterator[pa.RecordBatch]:
    """``(cluster, topic, term, weight)`` from ``(key, cluster, term, weights)``: of each batch, cluster and topic the ``most``
    heaviest terms and all that could round to the weight of the last of them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key, cluster, term, weights = batch.columns
        _, group = np.unique(key.to_numpy(zero_copy_only=False), return_inverse=True)
        values = weights.flatten().to_numpy(zero_copy_only=False).reshape(-1, n_topics)
        size = np.bincount(group)
        last = np.cumsum(size) - size + np.minimum(size, most) - 1
        for k in range(n_topics):
            w = values[:, k]
            least = w[np.lexsort((-w, group))][last]
            at = np.flatnonzero(w >= least[group] - ROUNDED)
            rows = pa.array(at)
            columns = [cluster.take(rows), pa.array(np.full(len(at), k, np.int32)), term.take(rows), pa.array(w[at])]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "topic", "term", "weight"])
