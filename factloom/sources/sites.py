"""Main content of known sites: a table of rules says in which element title, author, date and body stand."""

from __future__ import annotations

from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


@dataclass(frozen=True)
class Site:
    """Elements as 'tag' or 'tag.class'; an element of ``skip`` and what is in it is left out of the body."""

    title: str = "h1"
    body: str = "article"
    skip: tuple[str, ...] = ("nav", "footer", "aside", "script", "style")


class _Reader(HTMLParser):
    def __init__(self, site: Site):
        super().__init__(convert_charrefs=True)
        self.site, self.stack, self.meta = site, [], {}
        self.title: list[str] = []
        self.body: list[str] = []

    def _is(self, open_: tuple[str, set], what: str) -> bool:
        tag, _, name = what.partition(".")
        return open_[0] == tag and (not name or name in open_[1])

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "meta":
            key = a.get("name") or a.get("property")
            if key:
                self.meta[key.lower()] = a.get("content") or ""
        if tag in ("p", "br", "div", "li"):
            self.body.append("\n")
        if tag not in VOID:
            self.stack.append((tag, set((a.get("class") or "").split())))

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                break

    def handle_data(self, data):
        if any(self._is(x, s) for x in self.stack for s in self.site.skip):
            return
        if any(self._is(x, self.site.title) for x in self.stack):
            self.title.append(data)
        elif any(self._is(x, self.site.body) for x in self.stack):
            self.body.append(data)


def read_page(html: str | None, site: Site) -> dict[str, str]:
    reader = _Reader(site)
    reader.feed(html or "")
    lines = (" ".join(x.split()) for x in "".join(reader.body).split("\n"))
    return {
        "title": " ".join("".join(reader.title).split()), "text": "\n".join(x for x in lines if x),
        "author": reader.meta.get("author", ""), "published": reader.meta.get("article:published_time", reader.meta.get("date", "")),
    }


def extract(pages: DataFrame, sites: dict[str, Site], default: Site | None = None) -> DataFrame:
    """pages (url, html) with host, title, text, author, published. A host is looked up by its last two labels; pages of
    unknown hosts are skipped unless there is a default."""
    kind = pa.struct([("title", pa.string()), ("text", pa.string()), ("author", pa.string()), ("published", pa.string())])

    @F.arrow_udf("struct<title:string,text:string,author:string,published:string>")
    def read(html: pa.Array, host: pa.Array) -> pa.Array:
        return pa.array([read_page(h, sites.get(name, default)) for h, name in zip(html.to_pylist(), host.to_pylist())], kind)

    host = F.regexp_extract("url", r"^[a-z]+://(?:[^/?#]*\.)?([^/?#.]+\.[^/?#.:]+)", 1)
    known = pages.withColumn("host", host)
    if default is None:
        known = known.where(F.col("host").isin(list(sites)))
    return known.withColumn("_r", read(F.col("html"), F.col("host"))).drop("html").select("*", "_r.*").drop("_r")
