"""Listing pages as rows.

Pages stay bytes until they are parsed: the encoding comes from a byte order
mark or the page's own meta tag, never from a transport's guess. A page without
the container is not a page without rows: ``listing_status`` tells the two apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeflow.functions.text import is_result_announcement, method_text

_META = re.compile(rb"<meta[^>]{0,200}?charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]{1,40})", re.I)
_MARKS = ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def decode(content: bytes) -> str:
    """Text of a page by byte order mark, meta tag, or what decodes strictly."""
    for mark, name in _MARKS:
        if content.startswith(mark):
            return content.decode(name, "replace")
    m = _META.search(content[:4096])
    tried = [m[1].decode("ascii")] if m else []
    for name in (*tried, "utf-8", "cp932", "euc_jp"):
        try:
            return content.decode({"shift_jis": "cp932", "x-sjis": "cp932"}.get(name.lower(), name))
        except (UnicodeDecodeError, LookupError):
            continue
    return content.decode("utf-8", "replace")


@dataclass(frozen=True)
class Layout:
    """Where a source keeps its rows: links inside ``item`` elements inside containers of a tag and class."""

    container: str = "ul"
    css_class: str = "news_list"
    item: str = "li"


class _Listing(HTMLParser):
    def __init__(self, layout: Layout):
        super().__init__(convert_charrefs=True)
        self.layout, self.containers, self.links = layout, 0, []
        self.stack: list[tuple[str, bool]] = []
        self.href: str | None = None
        self.text: list[str] = []

    def _inside(self) -> bool:
        at = next((i for i, (_, c) in enumerate(self.stack) if c), None)
        return at is not None and any(t == self.layout.item for t, _ in self.stack[at + 1 :])

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = dict(attrs)
        is_container = tag == self.layout.container and self.layout.css_class in (given.get("class") or "").split()
        self.containers += is_container
        if tag not in _VOID:
            self.stack.append((tag, is_container))
        if tag == "a" and given.get("href") is not None and self._inside():
            self.href, self.text = given["href"], []

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self.href is not None:
            self.links.append((self.href.strip(), " ".join("".join(self.text).split())))
            self.href = None
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break

    def handle_data(self, data: str) -> None:
        if self.href is not None:
            self.text.append(data)


def parse(content: bytes | None, layout: Layout) -> tuple[int, list[tuple[str, str]]]:
    """(containers found, (href, text) in page order)."""
    if content is None:
        return 0, []
    p = _Listing(layout)
    p.feed(decode(bytes(content)))
    p.close()
    return p.containers, p.links


def parse_pages(pages: DataFrame, layout: Layout | None = None) -> DataFrame:
    """pages (page_id, base_url, content binary) -> one row per link, and one without link per page.

    (page_id, containers, ordinal, url, title, href); ordinal null marks the
    page's own row. The first link to an address wins, across containers.
    """
    layout = layout or Layout()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for page, base, content in zip(pdf["page_id"], pdf["base_url"], pdf["content"], strict=True):
                n, links = parse(content, layout)
                rows.append((page, n, None, None, None, None))
                rows += [(page, n, i, urljoin(base or "", h), t, h) for i, (h, t) in enumerate(links) if h and t]
            out = pd.DataFrame(rows, columns=["page_id", "containers", "ordinal", "url", "title", "href"])
            out["ordinal"] = out["ordinal"].astype("Int32")
            yield out

    kind = dict(pages.dtypes)["page_id"]
    links = pages.select("page_id", "base_url", "content").mapInPandas(run, f"page_id {kind}, containers int, ordinal int, url string, title string, href string")
    once = Window.partitionBy("page_id", "url").orderBy(F.col("ordinal").asc_nulls_first())
    return links.withColumn("_n", F.row_number().over(once)).where("url is null or _n = 1").drop("_n")


def listing_status(parsed: DataFrame) -> DataFrame:
    """(page_id, rows, status): no container is failed, a container without rows ok_empty."""
    by = parsed.groupBy("page_id").agg(F.max("containers").alias("containers"), F.count("url").alias("rows"))
    return by.select("page_id", "rows", F.when(F.col("containers") == 0, "failed").when(F.col("rows") > 0, "ok").otherwise("ok_empty").alias("status"))


def raw_tenders(parsed: DataFrame, organization_id: str, captured_at: Column) -> DataFrame:
    """Raw notices of the links; nothing is interpreted but the tag at the head of the title."""
    none = F.lit(None).cast("string")
    result = is_result_announcement(F.col("title"))
    payload = F.create_map(F.lit("listing_title"), F.col("title"), F.lit("href"), F.col("href"), F.lit("is_result_announcement"), result.cast("string"))
    return parsed.where("url is not null").select(
        F.lit(organization_id).alias("organization_id"), F.col("url").alias("source_url"), captured_at.alias("captured_at"), "title", none.alias("external_ref"),
        method_text(F.col("title")).alias("method_text"), none.alias("announced_text"), none.alias("qa_deadline_text"), none.alias("application_deadline_text"),
        none.alias("bid_deadline_text"), none.alias("price_text"), none.alias("place_text"), none.alias("qualification_text"),
        F.expr("cast(array() as array<string>)").alias("attachment_urls"), payload.alias("raw_payload"),
    )


def read_pages(spark: SparkSession, path: str, base_url: str, largest: int) -> DataFrame:
    """Stored pages; files above the size limit are dropped by their length before their content is read."""
    files = spark.read.format("binaryFile").load(path).where(F.col("length") <= largest)
    return files.select(F.col("path").alias("page_id"), F.lit(base_url).alias("base_url"), "content")
