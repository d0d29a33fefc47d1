"""Main text of web pages by tree scoring: paragraphs pass points for length and commas to their ancestors,
link density discounts them, and the best container is kept with the siblings that belong to it."""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .flat import slices

# Element names as the public HTML standard lists them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul option select title head caption search".split()
)
# Never main text, by element.
DROPPED = frozenset(
    "script style noscript template head title nav header footer aside form button select textarea input iframe svg "
    "math canvas object embed dialog menu noembed noframes xmp datalist fieldset label option audio video search".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An open element of the second set ends where one of the first starts.
CLOSES_P = BLOCK - {"body", "html", "head", "option", "select", "title", "tbody", "td", "tfoot", "th", "thead", "tr", "caption"}
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# Names in class, id or role that mark what stands beside an article: whole words, and parts of words.
BESIDE_WORDS = (
    "ad ads adv advert banner nav navbar navigation menu submenu header masthead footer foot bottom sidebar aside side "
    "rail widget promo sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal overlay "
    "subscribe subscription newsletter signup login share sharing social related recommended trending breadcrumb "
    "breadcrumbs pagination pager search toolbar skip copyright legal disclaimer complementary contentinfo "
    "comment comments reply replies respond discussion disqus reactions feedback form tags"
).split()
BESIDE_PARTS = "sidebar advert sponsor cookie newsletter breadcrumb navbar comment disqus footer popup".split()
_BESIDE = re.compile(
    rf"(?:^|[^a-z0-9])(?:{'|'.join(BESIDE_WORDS)})(?:$|[^a-z])|{'|'.join(BESIDE_PARTS)}", re.IGNORECASE
)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:$|[\s=])|display\s*:\s*none|visibility\s*:\s*hidden|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_UNSHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)


def is_hidden(attributes: str) -> bool:
    """Whether an attribute of its own (not a word in some value) hides the element."""
    for found in _ATTRIBUTE.finditer(attributes):
        name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
            return True
        if name == "style" and _UNSHOWN.search(value):
            return True
    return False


_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?>(?:\"[^\"<]*\"|'[^'<]*'|[^\"'<>])*)>|[^<>]*>)"
    r"|<[!?][^<>]*>|</[^a-zA-Z<>][^<>]*>",
    re.DOTALL,
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE) for tag in RAW}
# Elements whose loose text gives points, and whether a container may be chosen.
_NEVER_CHOSEN = frozenset("html p a span b i em strong u small font h1 h2 h3 h4 h5 h6 pre li tr td th tbody".split())
_WHOLE = frozenset(("html", "body", "article", "main"))


_SEEN, _NAMED, _UNSEEN = 0, 1, 2


def _beside(attributes: str, memory: dict[str, int]) -> int:
    """Whether an element is hidden or named like what stands beside an article."""
    known = memory.get(attributes)
    if known is None:
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes))
        known = _UNSEEN if _HIDDEN.search(attributes) and is_hidden(attributes) else _NAMED if names and _BESIDE.search(names) else _SEEN
        if len(memory) < 10_000:
            memory[attributes] = known
    return known


class _Page:
    """Elements as parallel lists; ``blocks`` are (element, text, characters inside links)."""

    def __init__(self, source: str, memory: dict[str, int]):
        self.tag, self.parent = ["#root"], [-1]
        self.named: set[int] = set()  # elements named like what stands beside an article
        self.blocks: list[tuple[int, str, int]] = []
        self.stack = [0]
        self.words: list[str] = []
        self.linked = 0
        self.links = 0
        self.skip = -1  # depth of the outermost element that is left out
        self.open: Counter[str] = Counter()
        self._read(source, memory)

    def _flush(self) -> None:
        if self.words:
            text = "".join(self.words)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                self.blocks.append((self.stack[-1], text, min(self.linked, len(text))))
            self.words = []
        self.linked = 0

    def _text(self, piece: str) -> None:
        if self.skip < 0 and piece:
            self.words.append(piece)
            if self.links:
                self.linked += len(piece.strip())

    def _pop(self, depth: int) -> None:
        """Close all elements above ``depth``."""
        if self.words and not self.named.isdisjoint(self.stack[depth:]):
            self._flush()
        for node in self.stack[depth:]:
            self.open[self.tag[node]] -= 1
        self.links = self.open["a"]
        del self.stack[depth:]
        if self.skip >= depth:
            self.skip = -1

    def _find(self, tags, until=frozenset()) -> int:
        """Depth of the innermost open element of that name, 0 if there is none this side of ``until``."""
        if not any(self.open[tag] for tag in tags):
            return 0
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.tag[self.stack[depth]]
            if name in tags:
                return depth
            if name in until:
                return 0
        return 0

    def _read(self, source: str, memory: dict[str, int]) -> None:
        at, end = 0, len(source)
        match_from = _TOKEN.search
        while at < end:
            found = match_from(source, at)
            if found is None:
                self._text(source[at:])
                break
            start = found.start()
            if start > at:
                self._text(source[at:start])
            at = found.end()
            name = found[2]
            if name is None:
                continue
            name = name.lower()
            if found[1]:
                depth = self._find((name,))
                if depth:
                    if name in BLOCK:
                        self._flush()
                    self._pop(depth)
                continue
            if name == "br" or name == "hr":
                self._text(" ") if name == "br" else self._flush()
                continue
            if name in VOID:
                continue
            if name in BLOCK:
                self._flush()
                depth = 0
                if name in CLOSES_P:
                    depth = self._find(("p",), ("td", "th", "table", "button"))
                if name in ENDS:
                    depth = self._find(*ENDS[name]) or depth
                if depth:
                    self._pop(depth)
            elif name == "a" and self.links:
                depth = self._find(("a",))
                if depth and not any(self.tag[n] in BLOCK for n in self.stack[depth:]):
                    self._pop(depth)
            attributes = found[3]
            if attributes.endswith("/>") and name in ("svg", "math", "path"):
                continue
            if name in RAW:
                closing = _RAW_END[name].search(source, at)
                at = closing.end() if closing else end
                continue
            self.tag.append(name)
            self.parent.append(self.stack[-1])
            self.stack.append(len(self.tag) - 1)
            self.open[name] += 1
            self.links = self.open["a"]
            if self.skip < 0:
                beside = _beside(attributes, memory) if len(attributes) > 4 and name not in _WHOLE else _SEEN
                if name in DROPPED or beside == _UNSEEN:
                    self.stack.pop()
                    self._flush()
                    self.stack.append(len(self.tag) - 1)
                    self.skip = len(self.stack) - 1
                elif beside == _NAMED:
                    self.stack.pop()
                    self._flush()
                    self.stack.append(len(self.tag) - 1)
                    self.named.add(len(self.tag) - 1)
        self._flush()


def _points(text: str) -> float:
    return 1 + text.count(",") + text.count("，") + text.count("、") + min(len(text) // 100, 3)


def _without_beside(page: _Page) -> list[tuple[int, str, int]]:
    """The blocks without those of named elements. Names alone do not decide: an element (less the named ones in it)
    stays that has more text and points than all that stands outside named elements, and at least half of the
    points of the largest such element: it is the wrapper of the article."""
    if not page.named:
        return page.blocks
    home = [0] * len(page.tag)
    for node in range(1, len(home)):
        home[node] = node if node in page.named else home[page.parent[node]]
    length: Counter[int] = Counter()
    points: Counter[int] = Counter()
    for node, text, links in page.blocks:
        length[home[node]] += len(text)
        points[home[node]] += _points(text) * (1 - links / len(text))
    most = max((points[g] for g in points if g), default=0)
    stays = {g for g in points if not g or length[g] > length[0] and points[g] > points[0] and 2 * points[g] >= most}
    return [block for block in page.blocks if home[block[0]] in stays]


def main_text(source: str | None, memory: dict[str, int] | None = None) -> str:
    """Main text of one page: its blocks in page order, one a line. A null, empty or textless page has none."""
    if not source:
        return ""
    page = _Page(source, {} if memory is None else memory)
    tag, parent, blocks = page.tag, page.parent, _without_beside(page)
    if not blocks:
        return ""
    n = len(tag)
    length, linked, score, items = [0] * n, [0] * n, [0.0] * n, [0] * n
    for node, text, links in blocks:
        length[node] += len(text)
        linked[node] += links
        items[node] += 1
        # A paragraph passes its points up; loose text in a container counts for the container itself.
        top = parent[node] if tag[node] in _NEVER_CHOSEN and parent[node] >= 0 else node
        if tag[node] in HEADINGS:
            continue
        share = _points(text) * (1 - links / len(text))
        score[top] += share
        weight = 2.0
        above = parent[top]
        while above > 0 and weight <= 4:
            score[above] += share / weight
            weight += 1
            above = parent[above]
    for node in range(n - 1, 0, -1):  # children come after their parents
        length[parent[node]] += length[node]
        linked[parent[node]] += linked[node]
        items[parent[node]] += items[node]
    best, best_score = 0, 0.0
    for node in range(n):
        if score[node] and tag[node] not in _NEVER_CHOSEN:
            discounted = score[node] * (1 - linked[node] / length[node])
            if discounted > best_score:
                best, best_score = node, discounted
    # A container that is a part of an article or of the main element stands for the whole of it.
    above = best
    while above > 0:
        if tag[above] in ("article", "main"):
            best = above
            if tag[above] == "article":
                break
        above = parent[above]
    keep = {best}
    home = parent[best]
    if home > 0 and tag[best] not in ("article", "main", "body"):
        for node in range(1, n):
            if parent[node] != home or node == best or not length[node]:
                continue
            density = linked[node] / length[node]
            if tag[node] in HEADINGS and density < 0.5:
                keep.add(node)
            elif tag[node] in ("p", "pre", "blockquote") and density < 0.25:
                keep.add(node)
            elif score[node] * (1 - density) >= max(3.0, 0.2 * best_score):
                keep.add(node)
    elif tag[best] == "article":
        for node in range(1, n):
            if parent[node] != home or node == best or not length[node]:
                continue
            if tag[node] in HEADINGS and tag[home] == "main" and linked[node] < 0.5 * length[node]:
                keep.add(node)  # the title above its article
            elif tag[node] == "article":
                if score[node] * (1 - linked[node] / length[node]) >= 0.2 * best_score:
                    keep.add(node)
    inside = [False] * n
    for node in range(n):
        inside[node] = node in keep or (parent[node] >= 0 and inside[parent[node]])
    for node in range(1, n):  # lists of links are menus wherever they stand
        if inside[node] and tag[node] in ("ul", "ol") and items[node] >= 3 and linked[node] > 0.8 * length[node]:
            inside[node] = None
        elif inside[node] and inside[parent[node]] is None:
            inside[node] = None
    return "\n".join(text for node, text, _ in blocks if inside[node])


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` without the markup column and with ``text`` and ``n_chars`` (code points).

    Every row is judged alone where it lies, nothing is shuffled. A null, empty or textless page has an empty text;
    unclosed, misnested or endless markup is read as browsers read it; repeated rows get the same text; an empty
    table gives no rows. Columns that are called ``text`` or ``n_chars`` already are replaced.
    """
    kept = [c for c in pages.columns if c not in (html_column, "text", "n_chars")]
    fields = [pages.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    narrow = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(html_column).alias("_html"))

    def run(batches):
        memory: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, "_html"):
                texts = [main_text(page, memory) for page in part.column("_html").to_pylist()]
                columns = [part.column(c) for c in kept]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), sizes], schema.names)

    return narrow.mapInArrow(run, schema)
