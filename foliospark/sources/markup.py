"""Text items out of HTML, in reading order, with the path of tags that each stands in.

A tokeniser that takes a page piece by piece and holds no tree: a stack of the open block tags and the text since the
last border of a block. Inline tags join texts, `br` ends a line; tags that HTML lets one leave open (p, li, tr, ...) are
closed by what can't stand in them; scripts, styles and comments are no text. Any string gives some items and none is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

#: Fixed values of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header html legend li main nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
HIDDEN = frozenset("script style template".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"}, "thead": {"tr", "td", "th"}, "option": {"option"}, "body": {"head"},
}
#: What keeps an open tag from being closed from inside.
SCOPES = frozenset("table ul ol dl select".split())
KINDS = {"title": "section_header", "li": "list_item", "dt": "list_item", "dd": "list_item", "td": "table_cell", "th": "table_cell", "caption": "caption", "figcaption": "caption", "pre": "code"} | {f"h{i}": "section_header" for i in range(1, 7)}
PIECE = 1 << 16
KIND = "item_no int, path string, tag string, layout_type string, text string"


class Tokeniser(HTMLParser):
    """feed() pieces of a page and take() the items that are complete."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str]] = []  # tag, its step of the path
        self.seen: list[dict[str, int]] = [{}]  # how many of each tag the open ones hold
        self.text: list[str] = []
        self.items: list[tuple[str, str, str, str]] = []
        self.hidden = 0

    def border(self) -> None:
        whole = "".join(self.text)
        self.text.clear()
        tag = self.stack[-1][0] if self.stack else ""
        if any(t == "pre" for t, _ in self.stack):
            body = whole.strip("\n")
        else:
            lines = (re.sub(r"[ \t\r\n\f]+", " ", x).strip(" ") for x in whole.split("\v"))
            body = "\n".join(lines).strip("\n")
        if body.strip():
            kind = next((KINDS[t] for t, _ in reversed(self.stack) if t in KINDS), "text")
            self.items.append(("/".join(s for _, s in self.stack), tag, kind, body))

    def close_to(self, n: int) -> None:
        self.border()
        del self.stack[n:]
        del self.seen[n + 1 :]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in HIDDEN:
            self.hidden += 1
        elif tag == "br":
            self.text.append("\v")
        elif tag == "hr":
            self.border()
        elif tag == "img":
            self.border()
            n = self.seen[-1]["img"] = self.seen[-1].get("img", 0) + 1
            alt = next((v for k, v in attrs if k == "alt" and v), "")
            self.items.append(("/".join([*(s for _, s in self.stack), f"img[{n}]"]), "img", "picture", alt.strip()))
        elif tag in BLOCK_TAGS:
            self.border()
            ends = CLOSES.get(tag, set()) | {"p"}
            for i in range(len(self.stack) - 1, -1, -1):
                open_tag = self.stack[i][0]
                if open_tag in ends:
                    self.close_to(i)
                elif open_tag in SCOPES or open_tag in ("div", "body", "html", "article", "section"):
                    break
            n = self.seen[-1][tag] = self.seen[-1].get(tag, 0) + 1
            self.stack.append((tag, f"{tag}[{n}]"))
            self.seen.append({})

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # <p/> opens a paragraph, as browsers have it; <script/> hides nothing that a later end tag would show again.
        if tag not in HIDDEN:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag in BLOCK_TAGS:
            at = max((i for i, (t, _) in enumerate(self.stack) if t == tag), default=None)
            if at is not None:
                self.close_to(at)

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.text.append(data.replace("\v", " "))

    def take(self) -> list[tuple[str, str, str, str]]:
        out, self.items = self.items, []
        return out


def html_items(html: str | None, piece: int = PIECE) -> Iterator[tuple[int, str, str, str, str]]:
    """item_no, path, tag, layout_type, text of a page; a null page has none."""
    reader = Tokeniser()
    n = 0
    for at in range(0, len(html or ""), piece):
        reader.feed(html[at : at + piece])
        for x in reader.take():
            yield n, *x
            n += 1
    reader.close()
    reader.border()
    for x in reader.take():
        yield n, *x
        n += 1


@udtf(returnType=KIND)
class HtmlItems:
    def eval(self, html: str):
        yield from html_items(html)


def tokenised(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """doc_id (string) and the items of each page."""
    rows = pages.select(F.col(f"`{id_col}`").cast("string").alias("doc_id"), F.col(f"`{html_col}`").cast("string").alias("html"))
    return rows.lateralJoin(HtmlItems(F.col("html").outer())).select("doc_id", "item_no", "path", "tag", "layout_type", "text")


def as_layout(items: DataFrame, page: Column | None = None) -> DataFrame:
    """The items as operators.build.build_blocks takes them, in their order, each page of markup being one page."""
    return items.select("doc_id", (F.lit(1) if page is None else page).cast("int").alias("page_no"), F.format_string("%09d:%s", "item_no", "path").alias("layout_ref"), "layout_type", "text", F.lit(None).cast("double").alias("ocr_confidence"))


def page_texts(items: DataFrame) -> DataFrame:
    """doc_id, text: a page's items in order, one a line; pages without any are left out."""
    lines = F.array_sort(F.collect_list(F.struct("item_no", "text")))
    return items.where("text <> ''").groupBy("doc_id").agg(lines.alias("x")).select("doc_id", F.array_join(F.transform("x", lambda i: i["text"]), "\n").alias("text"))
