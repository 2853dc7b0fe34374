"""HTML pages: text, title, links and label tables by the standard parser, in Arrow batches (HTM)."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F

_BLOCK = frozenset("p div br li ul ol tr table td th h1 h2 h3 h4 h5 h6 article section header footer pre dd dt".split())
_SILENT = frozenset("script style noscript template title".split())
_KNOWN = _BLOCK | _SILENT | frozenset("html head body a span b i u em strong img font small sup sub title meta link tbody thead tfoot nav aside main input form label button center blockquote hr col colgroup iframe object".split())


class Page(HTMLParser):
    """Text with a line per block, title, links and two-column label rows of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts, self.title, self.links, self.pairs = [], [], [], {}
        self._silent, self._in_title, self._href, self._text, self._row, self._cell = 0, False, None, [], None, None

    def handle_starttag(self, tag, attrs):
        got = dict(attrs)
        if tag not in _KNOWN:  # angle brackets around words are text
            self.handle_data(self.get_starttag_text() or "")
            return
        if tag in _SILENT:
            self._silent += 1
        if tag == "title":
            self._in_title = True
        if tag in _BLOCK:
            self.parts.append("\n")
        if tag == "a":
            self._href, self._text = got.get("href"), []
        if tag == "img" and got.get("alt"):
            self.handle_data(got["alt"])
        if tag == "tr":
            self._row = []
        if tag in ("td", "th") and self._row is not None:
            self._cell = []

    def handle_endtag(self, tag):
        if tag not in _KNOWN:
            self.handle_data(f"</{tag}>")
            return
        if tag in _SILENT and self._silent:
            self._silent -= 1
        if tag == "title":
            self._in_title = False
        if tag in _BLOCK:
            self.parts.append("\n")
        if tag == "a" and self._href:
            self.links.append((self._href, "".join(self._text).strip()))
            self._href = None
        if tag in ("td", "th") and self._cell is not None:
            self._row.append("".join(self._cell).strip())
            self._cell = None
        if tag == "tr" and self._row is not None:
            for label, value in zip(self._row[::2], self._row[1::2]):
                if label and label.rstrip("：:") not in self.pairs:  # the first of a label wins
                    self.pairs[label.rstrip("：:")] = value
            self._row = None

    def handle_data(self, data):
        if self._in_title:
            self.title.append(data)
        if self._silent:
            return
        self.parts.append(data)
        if self._href is not None:
            self._text.append(data)
        if self._cell is not None:
            self._cell.append(data)

    def text(self) -> str:
        lines = (" ".join(x.split()) for x in "".join(self.parts).split("\n"))
        return "\n".join(x for x in lines if x)


def parse(html: str) -> dict:
    """What ``html_page`` gives for one page; broken markup gives what was read so far."""
    page = Page()
    try:
        page.feed(html)
        page.close()
    except (AssertionError, ValueError):
        pass
    return {"title": "".join(page.title).strip() or None, "text": page.text(), "links": [{"href": h, "text": t} for h, t in page.links], "labels": page.pairs}


_SCHEMA = "title string, text string, links array<struct<href: string, text: string>>, labels map<string, string>"


def html_page(html):
    """Struct of title, text, links and labels of an HTML column; null for null."""

    @F.pandas_udf(_SCHEMA)
    def read(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse(p) if p is not None else {"title": None, "text": None, "links": None, "labels": None} for p in pages], columns=["title", "text", "links", "labels"])

    return read(html)


_HEADS = {f"h{i}": "#" * i + " " for i in range(1, 7)}
#: Elements that act or load, and endings of addresses of files.
_ACTIVE = frozenset("script style iframe object embed form input button link meta base applet noscript template".split())
_FILE = ("pdf", "doc", "docx", "xls", "xlsx", "zip", "rar", "wps", "rtf", "png", "jpg", "jpeg", "gif", "csv")


class Fragment(HTMLParser):
    """Markdown, tables and assets of a fragment; unknown tags are text (HTM-03)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks, self.tables, self.assets = [""], [], {}
        self._silent, self._rows, self._row, self._cell, self._link = 0, None, None, None, None

    def _add(self, text: str) -> None:
        if self._cell is not None:
            self._cell.append(text)
        elif self._rows is None:
            self.blocks[-1] += text

    def _break(self, start: str = "") -> None:
        if self._rows is None:
            if self.blocks[-1].strip():
                self.blocks.append("")
            self.blocks[-1] = start

    def _asset(self, kind: str, ref: str, label: str) -> None:
        self.assets.setdefault((kind, ref), label.strip())

    def handle_starttag(self, tag, attrs):
        got = dict(attrs)
        if tag in _SILENT:
            self._silent += 1
        elif tag not in _KNOWN:
            self.handle_data(self.get_starttag_text() or "")
        elif tag == "table":
            self._break()
            self._rows = []
        elif tag == "tr" and self._rows is not None:
            self._row = []
        elif tag in ("td", "th") and self._row is not None:
            self._cell = []
        elif tag in _BLOCK:
            self._break(_HEADS.get(tag, "- " if tag == "li" else "")) if self._cell is None else self._cell.append(" ")
        elif tag == "img" and got.get("src"):
            self._asset("image", got["src"], got.get("alt") or "")
            self._add(f"![{got.get('alt') or ''}]({got['src']})")
        elif tag == "a":
            self._link = (got.get("href") or "", [])

    def handle_endtag(self, tag):
        if tag in _SILENT:
            self._silent = max(0, self._silent - 1)
        elif tag not in _KNOWN:
            self.handle_data(f"</{tag}>")
        elif tag in ("td", "th") and self._cell is not None:
            self._row.append(" ".join("".join(self._cell).split()))
            self._cell = None
        elif tag == "tr" and self._row is not None:
            if self._row:
                self._rows.append(self._row)
            self._row = None
        elif tag == "table" and self._rows is not None:
            rows, self._rows = self._rows, None
            if rows:
                self.tables.append(rows)
                self._break(self._table(rows))
                self._break()
        elif tag == "a" and self._link is not None:
            href, text = self._link
            self._link = None
            if href.split("?")[0].rpartition(".")[2].lower() in _FILE:
                self._asset("file", href, "".join(text))
        elif tag in _BLOCK and self._cell is None:
            self._break()

    def handle_data(self, data):
        if self._silent:
            return
        if self._link is not None:
            self._link[1].append(data)
        self._add(data)

    @staticmethod
    def _table(rows: list[list[str]]) -> str:
        width = max(map(len, rows))
        line = lambda r: "| " + " | ".join(c.replace("|", "\\|") for c in [*r, *[""] * (width - len(r))]) + " |"
        return "\n".join([line(rows[0]), line(["---"] * width), *map(line, rows[1:])])

    def markdown(self) -> str:
        kept = (b if b.startswith("| ") else " ".join(b.split()) for b in self.blocks)
        return "\n\n".join(b for b in kept if b and b not in ("-", *("#" * i for i in range(1, 7))))


class Clean(HTMLParser):
    """A fragment without elements and attributes that act, cut at a comment (HTM-06)."""

    def __init__(self, cut_at: str | None) -> None:
        super().__init__(convert_charrefs=False)
        self.out, self.links, self._off, self._done, self._cut = [], {}, 0, False, cut_at

    def handle_starttag(self, tag, attrs):
        if tag in _ACTIVE:
            self._off += tag not in ("input", "embed", "link", "meta", "base")
            return
        if self._off or self._done:
            return
        kept = [(k, v or "") for k, v in attrs if not k.startswith("on") and not (v or "").strip().lower().startswith(("javascript:", "data:"))]
        if tag == "a" and (href := dict(kept).get("href", "")).startswith(("http://", "https://")):
            self.links.setdefault(href)
        self.out.append("<" + tag + "".join(' {}="{}"'.format(k, v.replace("&", "&amp;").replace('"', "&quot;")) for k, v in kept) + ">")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in _ACTIVE and tag not in ("input", "embed", "link", "meta", "base"):
            self._off = max(0, self._off - 1)

    def handle_endtag(self, tag):
        if tag in _ACTIVE:
            self._off = max(0, self._off - 1)
        elif not self._off and not self._done:
            self.out.append(f"</{tag}>")

    def handle_comment(self, data):
        self._done = self._done or (self._cut is not None and self._cut in data)

    def handle_data(self, data):
        if not self._off and not self._done:
            self.out.append(data)

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


class Listing(HTMLParser):
    """Items of a list page: what is linked in each list item, and its date (HTM-05)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items, self._item = [], None

    def handle_starttag(self, tag, attrs):
        got = dict(attrs)
        if tag == "li":
            self._item = {"links": [], "text": []}
        elif tag == "a" and self._item is not None and got.get("href"):
            self._item["links"].append([got["href"], got.get("title") or "", []])

    def handle_endtag(self, tag):
        if tag == "li" and self._item is not None:
            self.items.append(self._item)
            self._item = None

    def handle_data(self, data):
        if self._item is not None:
            self._item["text"].append(data)
            if self._item["links"]:
                self._item["links"][-1][2].append(data)


def _fed(parser: HTMLParser, html: str) -> HTMLParser:
    try:
        parser.feed(html)
        parser.close()
    except (AssertionError, ValueError):
        pass
    return parser


def fragment(html: str) -> dict:
    """What ``html_fragment`` gives for one fragment."""
    f = _fed(Fragment(), html)
    return {
        "markdown": f.markdown(), "tables": [{"table_id": f"table_{i:04d}", "rows": t} for i, t in enumerate(f.tables, 1)],
        "assets": [{"kind": k, "ref": r, "label": x} for (k, r), x in f.assets.items()],
    }


def listing(html: str) -> list[dict]:
    """Items with exactly one link; the day is null where the item has none."""
    out = []
    for item in _fed(Listing(), html).items:
        if len(item["links"]) == 1:
            href, title, text = item["links"][0]
            day = re.search(r"(\d{4})[-/.年](\d{1,2})[-/.月](\d{1,2})", "".join(item["text"]))
            out.append({"href": href, "title": title or " ".join("".join(text).split()), "day": "{}-{:0>2}-{:0>2}".format(*day.groups()) if day else None})
    return out


def _mapped(html, schema: str, columns: list[str], of_page):
    @F.pandas_udf(schema)
    def read(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([of_page(p) if p is not None else dict.fromkeys(columns) for p in pages], columns=columns)

    return read(html)


def html_fragment(html):
    """Struct of markdown, tables (numbered ids and rows of cells) and assets (kind, address,
    label, each once) of a column of fragments; null fields for null (HTM-03)."""
    return _mapped(html, "markdown string, tables array<struct<table_id: string, rows: array<array<string>>>>, assets array<struct<kind: string, ref: string, label: string>>", ["markdown", "tables", "assets"], fragment)


def html_listing(html):
    """Struct of items (href, title, day) of a column of list pages (HTM-05)."""
    return _mapped(html, "items array<struct<href: string, title: string, day: string>>", ["items"], lambda p: {"items": listing(p)})


def html_clean(html, cut_at: str | None = None):
    """Struct of html and links of a column of articles, without what acts, up to a comment that
    holds ``cut_at`` (HTM-06)."""

    def clean(p: str) -> dict:
        c = _fed(Clean(cut_at), p)
        return {"html": "".join(c.out), "links": list(c.links)}

    return _mapped(html, "html string, links array<string>", ["html", "links"], clean)
