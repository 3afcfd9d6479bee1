"""Main text of web pages, by the standard library's parser in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements and classes that are never article text (one list, kept apart as the parser tests tags and classes apart), and where article text is
# looked for, in this order.
NOISE_TAGS = ("nav", "header", "footer", "aside", "script", "style", "noscript")
NOISE_CLASSES = ("ad", "advertisement", "related", "sidebar", "newsletter", "subscribe", "paywall")
PLACES = ("article", "[role=main]", ".article-body", ".article-content", ".story-body", ".post-content", ".entry-content", ".content-body", "#article-body", "#main-content", "main")
LEAST = 200
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BREAKS = {"p", "div", "br", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "main", "tr", "table", "blockquote", "pre", "body", "title"}


class _Page(HTMLParser):
    """Collects the text of the first element that each place names, and of the body."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, tuple[str, ...]]] = []  # tag, whether it is noise, places that it opened
        self.noise = 0
        self.open: dict[str, list[str]] = {}
        self.texts: dict[str, list[str]] = {}

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _BREAKS:
            self._add("\n")
        if tag in _VOID:
            return
        a = {k: v or "" for k, v in attrs}
        classes = set(a.get("class", "").split())
        names = [tag, *(f".{c}" for c in classes), f"#{a.get('id', '')}", f"[role={a.get('role', '')}]"]
        noise = tag in NOISE_TAGS or bool(classes & set(NOISE_CLASSES))
        places = tuple(p for p in (*PLACES, "body") if p in names and p not in self.texts and not self.noise and not noise)
        for p in places:
            self.open[p] = self.texts[p] = []
        self.stack.append((tag, noise, places))
        self.noise += noise

    def handle_endtag(self, tag: str) -> None:
        if tag in _BREAKS:
            self._add("\n")
        if all(t != tag for t, _, _ in self.stack):
            return
        while self.stack:
            t, noise, places = self.stack.pop()
            self.noise -= noise
            for p in places:
                self.open.pop(p, None)
            if t == tag:
                return

    def handle_data(self, data: str) -> None:
        self._add(data)

    def _add(self, data: str) -> None:
        if not self.noise:
            for x in self.open.values():
                x.append(data)


def main_text(html: str | None) -> str:
    """Text of the first place that has 200 characters or more, else of the body, else nothing."""
    page = _Page()
    page.feed(html or "")
    page.close()
    for place in (*PLACES, "body"):
        lines = ["".join(page.texts.get(place, []))]
        text = "\n".join(x for x in (" ".join(line.split()) for line in "".join(lines).split("\n")) if x)
        if len(text) >= LEAST:
            return text
    return ""


@F.arrow_udf(T.StringType())
def page_text(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """``main_text`` of a column; to be followed by ``body_lines``. One page at a time is a Python string; of a batch only the short results are held beside it."""
    for batch in html:
        yield pa.array((main_text(page.as_py()) for page in batch), pa.string())
