"""Paragraph text of HTML pages.

``paragraph_text`` gives what a lenient tag-tree parser gives for "all <p> elements, their texts
joined by one blank": an element stays open until its own end tag or that of an element around it,
so an unclosed ``<p>`` encloses the paragraphs after it and their words show up in both. With
``nested=False`` a new ``<p>`` closes the open one, as browsers do, and no word repeats.

``closed_paragraph_text`` stays in the JVM: paragraphs that are closed, tags removed, entities left.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that never have content, elements whose inner text is not page text,
# elements that keep blanks as written.
VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
SILENT = frozenset("script style template rt rp".split())
VERBATIM = frozenset("pre textarea".split())
BLANKS = " \n\t\x0c\r"


class _Paragraphs(HTMLParser):
    def __init__(self, nested: bool) -> None:
        super().__init__(convert_charrefs=True)
        self.nested = nested
        self.open: list[str] = []
        self.slots: list[int] = []
        self.texts: list[list[str]] = []
        self.pending: list[str] = []

    def _flush(self) -> None:
        if not self.pending:
            return
        text = "".join(self.pending)
        self.pending.clear()
        if self.open and self.open[-1] in SILENT:
            return
        if not text.strip(BLANKS) and VERBATIM.isdisjoint(self.open):
            text = "\n" if "\n" in text else " "
        for slot in self.slots:
            self.texts[slot].append(text)

    def _close(self, tag: str) -> None:
        if tag not in self.open:
            return
        closed = None
        while closed != tag:
            closed = self.open.pop()
            if closed == "p":
                self.slots.pop()

    def handle_starttag(self, tag: str, attrs) -> None:
        self._flush()
        if tag == "p" and not self.nested:
            self._close("p")
        if tag == "p":
            self.slots.append(len(self.texts))
            self.texts.append([])
        if tag not in VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(tag)

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        self._close(tag)

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data: str) -> None:
        self._flush()
        if data.upper().startswith("CDATA["):
            self.pending.append(data[6:])
            self._flush()

    def result(self) -> str:
        self.close()
        self._flush()
        return " ".join("".join(parts) for parts in self.texts)


def paragraph_text_of(html: str, nested: bool = True) -> str:
    parser = _Paragraphs(nested)
    parser.feed(html)
    return parser.result()


def paragraph_text(html: Column | str, nested: bool = True) -> Column:
    """Arrow-batched: only the HTML column crosses to Python and only the text comes back."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda page: paragraph_text_of(page, nested), na_action="ignore")

    return extract(html)


def closed_paragraph_text(html: Column | str) -> Column:
    html = F.col(html) if isinstance(html, str) else html
    visible = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)\s*>", "")
    inner = F.regexp_extract_all(visible, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p\s*>"), F.lit(1))
    return F.array_join(F.transform(inner, lambda p: F.regexp_replace(p, "<[^>]+>", "")), " ")
