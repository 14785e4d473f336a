"""News pages -> headline records.

Only the walk over the HTML runs in Python, one Arrow batch of pages at a time; times, ids,
links and fallbacks are Spark expressions on what the walk returns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourseloom.functions.text import (
    MIN_FALLBACK_CHARS, NEWS_HOST, first_external_link, headline_id, longest_text, strip_source,
)
from bourseloom.functions.times import iso_market, parse_news_time
from bourseloom.session import MARKET_ZONE

VOID_TAGS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
    "track", "wbr",
}
SILENT_TAGS = {"script", "style", "template"}
#: Pages whose texts and cards are Python objects at one time.
PAGES_AT_ONCE = 64


@dataclass(frozen=True)
class Selectors:
    """Where a card and its parts are: a tag name and a pattern searched in its class."""

    # Tags and class patterns of the news site's cards.
    card: tuple[str, str] = ("div", "stockNews_newsRow")
    title: tuple[str, str] = ("div", "BoxItemTitle")
    header: tuple[str, str] = ("div", "BoxHeaderText")
    block: str = "div"


CARD_SCHEMA = T.StructType([
    T.StructField("page_key", T.StringType()),
    T.StructField("card", T.IntegerType()),
    T.StructField("time_attribute", T.StringType()),
    T.StructField("time_title", T.StringType()),
    T.StructField("has_time", T.BooleanType()),
    T.StructField("title", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("blocks", T.ArrayType(T.StringType())),
    T.StructField("block_chars", T.ArrayType(T.IntegerType())),
    T.StructField("links", T.ArrayType(T.StringType())),
])


class _CardWalk(HTMLParser):
    """Collects the parts of every card while tags stream by."""

    def __init__(self, selectors: Selectors):
        super().__init__(convert_charrefs=True)
        self.want = selectors
        self.open: list[dict] = []
        self.cards: list[dict] = []
        self.run: list[str] = []

    def _fits(self, rule: tuple[str, str], tag: str, classes: str) -> bool:
        return tag == rule[0] and re.search(rule[1], classes) is not None

    def _inside(self, role: str) -> list[dict]:
        return [n for n in self.open if role in n["roles"]]

    def handle_starttag(self, tag, attrs):
        self._end_run()
        given = {k: v or "" for k, v in attrs}
        classes = given.get("class", "")
        node = {"tag": tag, "roles": set(), "texts": []}
        if self._fits(self.want.card, tag, classes):
            node["roles"].add("card")
            card = {"time": None, "title": None, "source": "", "blocks": [], "links": [],
                    "header_open": None, "header_done": False}
            node["card"] = card
            self.cards.append(card)
        for holder in self._inside("card"):
            card = holder["card"]
            if tag == "time":
                if card["time"] is None:
                    card["time"] = (given.get("datetime", ""), given.get("title", ""))
                if card["header_open"] is not None and self.open[-1] is card["header_open"]:
                    card["header_done"] = True
            if tag == "a" and "href" in given:
                card["links"].append(given["href"])
            if tag == self.want.block:
                node["roles"].add("block")
                card["blocks"].append(node["texts"])
            if card["title"] is None and self._fits(self.want.title, tag, classes):
                card["title"] = node["texts"]
                node["roles"].add("title")
            if card["header_open"] is None and self._fits(self.want.header, tag, classes):
                card["header_open"] = node
        if tag not in VOID_TAGS:
            self.open.append(node)

    def handle_endtag(self, tag):
        self._end_run()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth]["tag"] == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        self.run.append(data)

    def handle_comment(self, data):
        self._end_run()

    def close(self):
        super().close()
        self._end_run()

    def _end_run(self):
        """One text between two tags, however many pieces the parser gave it in."""
        text = "".join(self.run).strip()
        self.run.clear()
        if not text or any(node["tag"] in SILENT_TAGS for node in self.open):
            return
        for node in self.open:
            if node["roles"] & {"block", "title"}:
                node["texts"].append(text)
        for holder in self._inside("card"):
            card = holder["card"]
            direct = card["header_open"] is not None and self.open[-1] is card["header_open"]
            if direct and not card["header_done"]:
                card["source"] = text


def walk_cards(html: str | None, selectors: Selectors) -> list[dict]:
    walk = _CardWalk(selectors)
    walk.feed(html or "")
    walk.close()
    return walk.cards


def _parse_batches(selectors: Selectors):
    """Pages are walked and their cards handed on a few at a time, whatever the size of an Arrow batch."""
    target = pa.schema([
        ("page_key", pa.string()), ("card", pa.int32()), ("time_attribute", pa.string()),
        ("time_title", pa.string()), ("has_time", pa.bool_()), ("title", pa.string()), ("source", pa.string()),
        ("blocks", pa.list_(pa.string())), ("block_chars", pa.list_(pa.int32())), ("links", pa.list_(pa.string())),
    ])

    def cards_of(pages: pa.RecordBatch) -> Iterator[dict]:
        for key, html in zip(*(column.to_pylist() for column in pages.columns), strict=True):
            for i, card in enumerate(walk_cards(html, selectors)):
                when = card["time"] or (None, None)
                yield dict(zip(CARD_SCHEMA.names, (
                    key, i, when[0], when[1], card["time"] is not None,
                    " ".join(card["title"] or []), card["source"],
                    [" ".join(b) for b in card["blocks"]],
                    [len("".join(b)) for b in card["blocks"]], card["links"],
                ), strict=True))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pages in batches:
            for at in range(0, pages.num_rows, PAGES_AT_ONCE):
                yield pa.RecordBatch.from_pylist(list(cards_of(pages.slice(at, PAGES_AT_ONCE))), schema=target)

    return parse


def news_cards(
    pages: DataFrame, page_key: str, html: str, selectors: Selectors = Selectors()
) -> DataFrame:
    """Raw parts of every card of every page, in page order."""
    narrow = pages.select(F.col(page_key).cast("string").alias("page_key"), F.col(html).alias("html"))
    return narrow.mapInArrow(_parse_batches(selectors), CARD_SCHEMA)


def card_headlines(
    cards: DataFrame, scraped_at: Column, host: str = NEWS_HOST, need_time: bool = True,
    zone: str = MARKET_ZONE,
) -> DataFrame:
    """Card parts -> headline records.

    A card without text is left out, and with ``need_time`` one without a readable time too.
    The text falls back to the first longest block; the id comes from the article link, or
    from text and time.
    """
    long_blocks = F.filter(
        F.col("blocks"), lambda b, i: F.get(F.col("block_chars"), i) > MIN_FALLBACK_CHARS
    )
    timed = cards.select(
        "page_key", "card",
        parse_news_time(F.col("time_attribute"), F.col("time_title"), zone).alias("_at"),
        F.when(F.col("title") != "", F.col("title"))
        .otherwise(longest_text(long_blocks, 0)).alias("headline"),
        strip_source(F.col("source")).alias("source"),
        first_external_link(F.col("links"), host).alias("_link"),
    ).filter(F.col("headline") != "")
    if need_time:
        timed = timed.filter(F.col("_at").isNotNull())
    published = F.coalesce(iso_market(F.col("_at"), zone), F.lit(""))
    return timed.select(
        headline_id(F.col("_link"), F.col("headline"), published).alias("headline_id"),
        F.col("page_key").alias("symbol"), published.alias("published_at"), "source",
        "headline", F.coalesce("_link", F.lit("")).alias("article_url"),
        scraped_at.alias("scraped_at"),
    )
