"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def base_counts(text):
    text = text or ""
    words = SPACE_WORDS.findall(text)
    seen, repeated_lines = set(), 0
    for line in text.split("\n"):
        if SPACE_WORDS.search(line):
            repeated_lines += line in seen
            seen.add(line)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, inside = Counter(runs), set()
    for i, run in enumerate(runs):
        if counts[run] > 1:
            inside.update(range(i, i + 8))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeated_lines, len(inside)


def shingles(text, size):
    words = SPACE_WORDS.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(size))))


def near_components(rows, size, percent=80):
    """Smallest reachable key for each row of (key, text); all pairs are compared."""
    sets = [shingles(text, size) for _, text in rows]
    above = list(range(len(rows)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            other = sets[j]
            if one and other and 100 * min(len(one), len(other)) >= percent * max(len(one), len(other)):
                both = len(one & other)
                if 100 * both >= percent * (len(one) + len(other) - both):
                    above[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [(key, len(sets[i]), least.get(root(i))) for i, (key, _) in enumerate(rows)]


def repeats(rows, length=200):
    """Key, bytes, removed, spans and digest of what is left, for each row of (key, text)."""
    seen = Counter()
    raws = [(key, (text or "").encode()) for key, text in rows]
    for _, raw in raws:
        seen.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for key, raw in raws:
        gone, done = bytearray(len(raw)), 0
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                for k in range(max(i, done), i + length):
                    gone[k] = 1
                done = i + length
        spans = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        out.append((key, len(raw), sum(gone), spans, sha(bytes(b for b, g in zip(raw, gone) if not g))))
    return out


def leaks(docs, items, size=10):
    """Key, words, hit words, items and their digest for each row of (key, text)."""
    find = lambda text: ALNUM_WORDS.findall((text or "").translate(LOWER))
    windows = {}
    for ident, text in items:
        words = find(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(ident))
    sizes = {len(w) for w in windows}
    out = []
    for key, text in docs:
        words, hit, owners = find(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if found := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    owners |= found
        out.append((key, len(words), len(hit), len(owners), sha(",".join(sorted(owners)).encode())))
    return out


def unigram_scores(rows):
    """Key, held out, tokens, known, training tokens and base score for each row of (key, text)."""
    import math

    tokens = [(key, [*SPACE_WORDS.findall((text or "").translate(LOWER)), None]) for key, text in rows]
    held = {key: key is not None and zlib.crc32(str(key).encode()) % 5 == 1 for key, _ in rows}
    counts = Counter(t for key, words in tokens if not held[key] for t in words)
    total, distinct = sum(counts.values()), len(counts)
    return [
        (
            key,
            held[key],
            len(words),
            sum(counts[t] > 0 for t in words),
            total,
            sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in words),
        )
        for key, words in tokens
    ]


def damaged(rows):
    """Rows (conv, turn, role, text) after the damage that the contract states, ordered per conversation."""
    found = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        lot = zlib.crc32(name.encode()) % 20
        if lot == 1:
            text = ""
        elif lot == 2:
            text = re.sub("[.!?]", "", text)
        elif lot == 4:
            role = "user"
        found[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(lot, 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in found.items()}


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of ordered rows, state by state."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts, seen, marks = [0, 0, 0], set(), []
    for _, role, text in rows:
        ends = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = 0 if not ends else 1 if (role, text) in seen else 2 if ends[-1] not in ".!?" else None
        seen.add((role, text))
        marks.append(fault)
        if fault is not None:
            counts[fault] += 1
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    def keep_best(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def inserted(ways):
        out = dict(ways)
        for _ in range(3):
            for state, (cost, audit, lines) in list(out.items()):
                role = "assistant" if state == "u" else "user"
                keep_best(out, role[0], (cost + 2, audit + "I", lines + [role + ":"]))
        return out

    ways = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, marks):
        after = {}
        for state, (cost, audit, lines) in inserted(ways).items():
            keep_best(after, state, (cost + 3, audit + "D", lines))
            if fault in (0, 1):
                continue
            more, first = (fault == 2), role[:1]
            if first == "s" and state == "" or first == "u" and state != "u" or first == "a" and state == "u":
                keep_best(after, first, (cost + more, audit + "K", lines + [f"{role}:{text}"]))
            new = "assistant" if state == "u" else "user"
            keep_best(after, new[0], (cost + 2 + more, audit + "R", lines + [f"{new}:{text}"]))
        ways = after
    cost, audit, lines = min(w for s, w in inserted(ways).items() if s in ("", "a"))
    return (gaps, *counts, illegal, cost, audit, sha("\n".join(lines).encode()))


def trie(rows):
    """Rows (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of the prefix trie."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            said = role or "", text or ""
            digest = hashlib.md5(f"{len(said[0])}:{said[0]}{said[1]}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, said[0].encode(), digest), said))
    own = {c: [said for _, said in sorted(r, key=lambda x: x[0])] for c, r in own.items()}
    nodes, ends = {}, {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (abs(conv) % 20 if conv >= 0 else -(abs(conv) % 20))
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(conv)
        ends.setdefault(path, []).append(conv)
    children, leaves, saved = Counter(p[:-1] for p in nodes if p), Counter(), Counter()
    for path, members in nodes.items():
        words = len(SPACE_WORDS.findall(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(members) - 1) * words
    return [
        (min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         sha(",".join(map(str, sorted(ends.get(p, [])))).encode()))
        for p, m in nodes.items()
    ]
