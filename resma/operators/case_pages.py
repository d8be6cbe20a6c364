"""Case pages of HTML read into rows: decoding, cells after labels, links."""

from __future__ import annotations

import codecs
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import parse_qs, urlsplit

import pandas as pd
from pyspark.sql import DataFrame

BOMS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
DECLARED = re.compile(rb"<meta[^>]{0,200}?charset\s*=\s*[\"']?\s*([A-Za-z0-9_-]+)", re.I)
HEADER = re.compile(r"charset\s*=\s*\"?([A-Za-z0-9_-]+)", re.I)
SCHEMA = "key string, title string, links array<string>, label string, value string, error string"


def decoded(content: bytes, content_type: str | None = None) -> str:
    """Text of a page: a byte order mark comes first, then the header's charset, the page's own
    declaration, UTF-8 and Windows-1252; unknown charsets are passed over."""
    for mark, charset in BOMS:
        if content.startswith(mark):
            return content[len(mark) :].decode(charset, "replace")
    header = HEADER.search(content_type or "")
    meta = DECLARED.search(content[:4096])
    for charset in (header and header[1], meta and meta[1].decode("ascii"), "utf-8", "cp1252"):
        if not charset:
            continue
        try:
            return content.decode(charset)
        except (LookupError, UnicodeDecodeError):
            continue
    return content.decode("latin-1")


def plain(text: str) -> str:
    text = "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))
    return " ".join(text.split()).rstrip(": ")


class Page(HTMLParser):
    """Title, links and table cells of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.links, self.rows = "", [], []
        #: links with their text
        self.anchors: list[tuple[str, str]] = []
        self.open_anchor: tuple[str, list[str]] | None = None
        self.inside: list[str] | None = None
        self.in_title = self.skip = False

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "title":
            self.in_title = True
        elif tag in ("script", "style"):
            self.skip = True
        elif tag == "a" and attrs.get("href"):
            self.links.append(attrs["href"])
            self.open_anchor = (attrs["href"], [])
        elif tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self.inside = []

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        elif tag in ("script", "style"):
            self.skip = False
        elif tag == "a" and self.open_anchor:
            self.anchors.append((self.open_anchor[0], " ".join("".join(self.open_anchor[1]).split())))
            self.open_anchor = None
        elif tag in ("td", "th") and self.inside is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append(" ".join("".join(self.inside).split()))
            self.inside = None

    def handle_data(self, data):
        if self.skip:
            return
        if self.in_title:
            self.title += data
        if self.open_anchor:
            self.open_anchor[1].append(data)
        if self.inside is not None:
            self.inside.append(data)


def read_page(content: bytes | None, content_type: str | None = None) -> Page | None:
    if not content:
        return None
    page = Page()
    page.feed(decoded(content, content_type))
    page.close()
    return page


def after_label(page: Page, label: str) -> str | None:
    """The cell after the first cell that reads as ``label``, marks and case aside."""
    want = plain(label)
    for row in page.rows:
        for i, cell in enumerate(row[:-1]):
            if plain(cell) == want:
                return row[i + 1]
    return None


def only_parameter(url: str, path: str, name: str) -> str | None:
    """The value of the parameter ``name`` if ``url`` has this path and no other parameter."""
    parts = urlsplit(url)
    query = parse_qs(parts.query, keep_blank_values=True)
    return query[name][0] if parts.path == path and list(query) == [name] and len(query[name]) == 1 else None


def labelled_cells(pages: DataFrame, key: str, content: str, labels: list[str], content_type: str | None = None) -> DataFrame:
    """(key, title, links, one column per label, error): null columns where a label is missing;
    error ``empty`` for null or empty pages."""
    columns = {f"label_{i}": x for i, x in enumerate(labels)}
    schema = f"`{key}` {pages.schema[key].dataType.simpleString()}, title string, links array<string>, " + ", ".join(f"{c} string" for c in columns) + ", error string"
    asked = [key, content, *([content_type] if content_type else [])]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                raw = row[1].encode() if isinstance(row[1], str) else row[1]
                page = read_page(bytes(raw) if raw is not None else None, row[2] if content_type else None)
                if page is None:
                    out.append((row[0], None, None, *[None] * len(columns), "empty"))
                else:
                    out.append((row[0], " ".join(page.title.split()) or None, page.links, *[after_label(page, x) for x in labels], None))
            yield pd.DataFrame(out, columns=[key, "title", "links", *columns, "error"])

    return pages.select(*asked).mapInPandas(run, schema)


#: Longest page, in characters, that is taken for a challenge by a phrase of its text alone.
SHORT_PAGE = 500_000


def special_page(
    page: Page, content: str = "", expired: tuple[str, ...] = ("sessao expirada", "sessao encerrada", "sessao expirou"), challenge: tuple[str, ...] = ("captcha", "verificacao de seguranca", "confirme que voce e humano"), markers: tuple[str, ...] = ("recaptcha",), phrases: tuple[str, ...] = ("nao sou um robo",)
) -> str | None:
    """``expired`` or ``challenge`` if the title or the cells of a page say so, or its markup
    ``content`` holds a marker, or it is short and holds a phrase; expiry comes first."""
    title, body = plain(page.title), " ".join(plain(c) for row in page.rows for c in row)
    for name, marks in (("expired", expired), ("challenge", challenge)):
        if any(m in title or m in body for m in marks):
            return name
    low = content.lower()
    if any(m in low for m in markers) or (len(content) < SHORT_PAGE and any(p in plain(content) for p in phrases)):
        return "challenge"
    return None


def tri_state(text: str | None, yes: tuple[str, ...] = ("sim",), no: tuple[str, ...] = ("nao",)) -> bool | None:
    """True or False if a text says yes or no, None if it says neither or is missing."""
    said = plain(text) if text is not None else None
    return True if said in yes else False if said in no else None


@dataclass
class Labels:
    """How a site's case page names what is read of it; ``link``: path and parameter of the links that bear the identity."""

    secrecy: str
    distribution: str
    subject: str
    link: tuple[str, str]


CASE = "number string, internal_id string, is_secret boolean, distribution string, subject string, error string"


def read_case(content: bytes | None, content_type: str | None, labels: Labels, number: str | None = None, internal_id: str | None = None) -> tuple:
    """The cells of CASE. The first link of the right path with one parameter and digits bears the
    internal id, its text the number. error: ``empty``, ``expired``, ``challenge``, ``identity`` (another
    case, or no link, where one is expected), ``distribution`` (missing). A case that is secret, or not
    clearly public, has its identity only."""
    page = read_page(content, content_type)
    if page is None:
        return (None,) * 5 + ("empty",)
    if kind := special_page(page, decoded(content, content_type)):
        return (None,) * 5 + (kind,)
    found = next(((t, v) for u, t in page.anchors if (v := only_parameter(u, *labels.link)) and v.isdigit()), None)
    if (number or internal_id) and (found is None or (number and found[0] != number) or (internal_id and found[1] != internal_id)):
        return (None,) * 5 + ("identity",)
    own, ident = found or (number, None)
    secret = tri_state(after_label(page, labels.secrecy))
    if secret is not False:
        return own, ident, secret, None, None, None
    when = after_label(page, labels.distribution)
    return own, ident, False, when, after_label(page, labels.subject), None if when else "distribution"


def case_rows(pages: DataFrame, key: str, content: str, labels: Labels, content_type: str | None = None, number: str | None = None, internal_id: str | None = None) -> DataFrame:
    """(key, CASE) of case pages, as ``read_case`` tells it; ``number`` and ``internal_id``: columns of what is expected."""
    asked = [c for c in (content_type, number, internal_id) if c]
    schema = f"`{key}` {pages.schema[key].dataType.simpleString()}, {CASE}"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                more = dict(zip(asked, (v if isinstance(v, str) else None for v in row[2:])))
                raw = row[1].encode() if isinstance(row[1], str) else row[1]
                out.append((row[0], *read_case(bytes(raw) if raw is not None else None, more.get(content_type), labels, more.get(number), more.get(internal_id))))
            yield pd.DataFrame(out, columns=[key, *(x.split()[0] for x in CASE.split(", "))])

    return pages.select(key, content, *asked).mapInPandas(run, schema)
