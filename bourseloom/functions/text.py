"""Text clean-up, field choice and symbol text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide what clean text looks like.
TAG_PATTERN = "<[^>]+>"
ENTITY_PATTERN = "&[a-z]+;"
SPACE_PATTERN = r"[\p{IsWhite_Space}\x1c-\x1f]+"
SOURCE_TAIL_PATTERN = "[ •·]+$"
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
MIN_FALLBACK_CHARS = 20
DEFAULT_EXCHANGE = "NSE"
NEWS_PAGE_TEMPLATE = "https://groww.in/stocks/%s/market-news"
NEWS_HOST = "groww.in"


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, TAG_PATTERN, "")


def strip_entities(c: Column) -> Column:
    return F.regexp_replace(c, ENTITY_PATTERN, " ")


def collapse_spaces(c: Column) -> Column:
    """One blank per run of white space, none at the ends; covers what Unicode calls white space."""
    return F.trim(F.regexp_replace(c, SPACE_PATTERN, " "))


def clean_text(c: Column) -> Column:
    """Lower-case, drop tags, blank out named entities, collapse white space. Null stays null."""
    return collapse_spaces(strip_entities(strip_tags(F.lower(c))))


def na_to_null(c: Column) -> Column:
    """Texts that a CSV reader takes for a missing value."""
    return F.when(~c.isin(NA_TEXTS), c)


def strip_source(c: Column) -> Column:
    """A news source label without the separator bullets that follow it."""
    return F.regexp_replace(F.trim(c), SOURCE_TAIL_PATTERN, "")


def longest_text(texts: Column, min_chars: int = MIN_FALLBACK_CHARS) -> Column:
    """The first longest of the texts with more than ``min_chars`` characters, else ``''``."""
    ranked = F.transform(
        F.filter(texts, lambda t: F.length(t) > min_chars),
        lambda t, i: F.struct(F.length(t).alias("n"), (-i).alias("pos"), t.alias("t")),
    )
    return F.coalesce(F.array_max(ranked)["t"], F.lit(""))


def first_external_link(links: Column, host: str = NEWS_HOST) -> Column:
    """The first absolute link that leaves ``host``; null when there is none."""
    return F.get(
        F.filter(links, lambda x: x.startswith("http") & ~x.contains(host)), F.lit(0)
    )


def content_id(c: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the text."""
    return F.substring(F.sha2(c, 256), 1, 16)


def headline_id(url: Column, headline: Column, published_iso: Column) -> Column:
    """Id from the article link, or from headline and time where there is no link."""
    has_link = url.isNotNull() & (url != "")
    return content_id(F.when(has_link, url).otherwise(F.concat(headline, published_iso)))


def exchange_ticker(name: Column) -> tuple[Column, Column]:
    """``EXCHANGE:TICKER`` -> (ticker, exchange); any other shape -> (input, default exchange)."""
    parts = F.split(F.trim(name), ":")
    paired = F.size(parts) == 2
    ticker = F.when(paired, F.get(parts, F.lit(1))).otherwise(name)
    exchange = F.when(paired, F.get(parts, F.lit(0))).otherwise(F.lit(DEFAULT_EXCHANGE))
    return ticker, exchange


def safe_name(c: Column) -> Column:
    """A name usable as a partition value."""
    return F.translate(c, " /", "__")


def news_page_url(site_name: Column) -> Column:
    return F.format_string(NEWS_PAGE_TEMPLATE, F.trim(site_name))
