"""Suffix arrays by induced sorting, a whole bucket at a time, and permuted common prefixes, in numpy."""

from __future__ import annotations

import numpy as np

from .flat import ragged

#: With fewer symbols than this a letter, buckets are too small to be handled as arrays.
SYMBOLS_A_LETTER = 64
#: Symbols compared at once, so that the comparison takes little memory beside the arrays.
COMPARED = 1 << 18


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one that follows it; the last symbol is the smallest."""
    n = len(text)
    up = np.empty(n, np.bool_)
    up[-1] = True
    if n == 1:
        return up
    differs = text[:-1] != text[1:]
    # Inside a run of equal symbols the answer is that of the run's end.
    at = np.where(differs, np.arange(n - 1), n)
    ends = np.minimum.accumulate(at[::-1])[::-1]
    rises = np.append(text[:-1] < text[1:], True)
    up[:-1] = rises[np.minimum(ends, n - 1)]
    return up


def _integers(n: int) -> type:
    """Places in a text of n symbols."""
    return np.int32 if n < 2**31 else np.int64


def _append(places: np.ndarray, letters: np.ndarray, fill: np.ndarray, array: np.ndarray, step: int) -> None:
    """Put ``places`` into the buckets of their letters, in the order given, at the pointers ``fill``."""
    if not len(places):
        return
    order = np.argsort(letters, kind="stable")
    sorted_letters = letters[order]
    starts = np.flatnonzero(np.append(True, sorted_letters[1:] != sorted_letters[:-1]))
    sizes = np.diff(np.append(starts, len(order)))
    names = sorted_letters[starts]
    offset = np.arange(len(order)) - np.repeat(starts, sizes)
    array[np.repeat(fill[names], sizes) + step * offset] = places[order]
    fill[names] += step * sizes


def _induce(text: np.ndarray, up: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order. Linear: every suffix is moved once."""
    n = len(text)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    array = np.full(n, -1, _integers(n))
    # Left to right: the falling suffixes go to the fronts of their buckets.
    front = heads.copy()
    first_letters = text[lms]
    group = np.argsort(first_letters, kind="stable")
    sorted_lms, sorted_letters = lms[group], first_letters[group]
    cut = np.searchsorted(sorted_letters, np.arange(len(sizes) + 1))
    for letter in np.flatnonzero(sizes).tolist():
        done = heads[letter]
        while front[letter] > done:  # a run of the letter extends its own bucket
            now = array[done : front[letter]]
            done = front[letter]
            before = now[now > 0] - 1
            own = before[(text[before] == letter) & ~up[before]]
            array[done : done + len(own)] = own
            front[letter] += len(own)
        scanned = np.concatenate([array[heads[letter] : front[letter]], sorted_lms[cut[letter] : cut[letter + 1]]])
        before = scanned[scanned > 0] - 1
        out = before[(text[before] > letter) & ~up[before]]
        _append(out, text[out], front, array, 1)
    # Right to left: the rising suffixes go to the backs.
    back = ends - 1
    for letter in np.flatnonzero(sizes)[::-1].tolist():
        last = ends[letter] - 1
        done = last
        while back[letter] < done:
            now = array[back[letter] + 1 : done + 1][::-1]
            done = back[letter]
            before = now[now > 0] - 1
            own = before[(text[before] == letter) & up[before]]
            array[done - len(own) + 1 : done + 1] = own[::-1]
            back[letter] -= len(own)
        # In scanning order: the bucket's rising suffixes from the right, then its falling ones, which no
        # rising suffix of the same letter can precede.
        scanned = array[back[letter] + 1 : last + 1][::-1]
        falling = array[heads[letter] : front[letter]][::-1]
        scanned = np.concatenate([scanned, falling])
        before = scanned[scanned > 0] - 1
        out = before[(text[before] < letter) & up[before]]
        _append(out, text[out], back, array, -1)
    array[0] = n - 1
    return array


def _equal_neighbours(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each range but the first: whether it equals the one before."""
    same = sizes[1:] == sizes[:-1]
    look = np.flatnonzero(same)
    done = np.cumsum(sizes[look], dtype=np.int64)
    cuts = np.searchsorted(done, np.arange(0, int(done[-1]) if len(done) else 0, COMPARED))
    for first, last in zip(cuts, np.append(cuts[1:], len(look))):
        part = look[first:last]
        if len(part):
            size = sizes[part].astype(np.int64)
            equal = text[ragged(starts[part], size)] == text[ragged(starts[part + 1], size)]
            same[part] = np.logical_and.reduceat(equal, np.cumsum(size) - size)
    return same


def _doubling(text: np.ndarray) -> np.ndarray:
    """Suffix array by ranks of 1, 2, 4.. symbols: for texts of nearly as many letters as symbols."""
    n = len(text)
    rank = text.astype(np.int64)
    step = 1
    while True:
        following = np.zeros(n, np.int64)
        following[: n - step] = rank[step:] + 1 if step < n else 0
        key = rank * (n + 2 + int(rank.max())) + following
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.append(False, sorted_key[1:] != sorted_key[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """Order of the suffixes of ``text`` (integers below ``letters``; the last one smaller than all others).

    The suffixes are classified, the substrings between leftmost-smaller positions are sorted by one induction
    and named, the string of names is sorted by the same function, and a second induction gives the rest.
    """
    n = len(text)
    if n <= 2 or letters * SYMBOLS_A_LETTER > n:
        return _doubling(text)
    up = suffix_types(text)
    lms = (np.flatnonzero(up[1:] & ~up[:-1]) + 1).astype(_integers(n))
    sizes = np.bincount(text, minlength=letters)
    rough = _induce(text, up, lms, sizes)
    is_lms = np.zeros(n, np.bool_)
    is_lms[lms] = True
    order = rough[is_lms[rough]]
    length = np.zeros(n, _integers(n))
    length[lms] = np.diff(np.append(lms, n - 1)) + 1
    length[n - 1] = 1
    same = _equal_neighbours(text, order, length[order])
    names = np.concatenate([[0], np.cumsum(~same)])
    named = np.empty(n, _integers(n))
    named[order] = names
    count = int(names[-1]) + 1
    if count < len(lms):
        order = lms[suffix_array(named[lms], count)]
    return _induce(text, up, order, sizes)


def permuted_common_prefixes(text: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """By text position: symbols shared with the suffix just before it in the order, ``most`` at the most."""
    n = len(text)
    before = np.full(n, -1, _integers(n))
    before[array[1:]] = array[:-1]
    shared = np.zeros(n, np.int32)
    wide = np.append(text, np.zeros(most + 8, text.dtype))
    step = 8 if text.dtype == np.uint8 else 1
    chunks = np.lib.stride_tricks.sliding_window_view(wide, step) if step > 1 else wide[:, None]
    live = np.flatnonzero(before >= 0)
    for offset in range(0, most, step):
        one, other = chunks[live + offset], chunks[before[live] + offset]
        equal = one == other
        whole = equal.all(axis=1)
        part = ~whole
        shared[live[part]] = offset + np.argmin(equal[part], axis=1)
        live = live[whole]
        room = np.minimum(n - live, n - before[live])
        live = live[room > offset + step]
        if not len(live):
            break
        shared[live] = offset + step
    return np.minimum(shared, most)
