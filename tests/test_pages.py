import hashlib

from pyspark.sql import functions as F

import pyarrow as pa

from bourseloom.operators import pages
from bourseloom.operators.pages import card_headlines, news_cards

CARD = """
<html><body><div class="wrap">
 <div class="stockNews_newsRow__x1">
   <div class="a BoxHeaderText b">Mint • <time datetime="2026-06-07T07:25:51.000Z" title="t">2h</time> later</div>
   <div class="BoxItemTitle">Shares <b>rise</b> &amp; shine</div>
   <a href="/stocks/x">in</a><a href="https://groww.in/y">in</a><a href="https://paper.example/1">out</a>
 </div>
 <div class="stockNews_newsRow__x2">
   <div class="BoxHeaderText"><time title="28 May 2026, 05:42 PM IST">x</time></div>
   <div>tiny</div><div>a much longer text block without a title</div><br>
 </div>
 <div class="stockNews_newsRow__x3"><div class="BoxItemTitle">No time tag</div></div>
 <div class="stockNews_newsRow__x4"><time datetime="nope" title="2 days ago"></time><div class="BoxItemTitle">Bad time</div></div>
 <div class="stockNews_newsRow__x5"><time datetime="2026-06-07T07:25:51Z"></time><div>tiny</div></div>
</div></body></html>
"""


def parse(spark, html, **options):
    df = spark.createDataFrame([("Stock A", html)], "stock string, html string")
    cards = news_cards(df, "stock", "html")
    return card_headlines(cards, F.lit("now"), **options).orderBy("published_at").collect()


def test_cards(spark):
    second, first = parse(spark, CARD)
    assert (first["headline"], first["source"], first["article_url"]) == (
        "Shares rise & shine", "Mint", "https://paper.example/1")
    assert first["published_at"] == "2026-06-07T12:55:51+05:30"
    assert first["headline_id"] == hashlib.sha256(b"https://paper.example/1").hexdigest()[:16]
    assert second["headline"] == "a much longer text block without a title"
    assert second["published_at"] == "2026-05-28T17:42:00+05:30" and second["article_url"] == ""
    text = second["headline"] + second["published_at"]
    assert second["headline_id"] == hashlib.sha256(text.encode()).hexdigest()[:16]
    assert {first["symbol"], second["symbol"]} == {"Stock A"}


def test_time_may_be_optional(spark):
    assert len(parse(spark, CARD, need_time=False)) == 4


def test_pages_without_cards(spark):
    assert parse(spark, None) == [] and parse(spark, "<p>x") == []


def test_text_pieces(spark):
    html = ('<div class="stockNews_newsRow"><time datetime="2026-06-07T07:25:51Z"></time>'
            '<div class="BoxItemTitle">P<5 &lt; A&amp;B<script>var x = "no";</script><!-- no --> up</div></div>')
    assert parse(spark, html)[0]["headline"] == "P<5 < A&B up"


def test_last_label_before_the_time_is_the_source(spark):
    html = ('<div class="stockNews_newsRow"><div class="BoxHeaderText">One<b>skip</b> Two ·<time '
            'datetime="2026-06-07T07:25:51Z"></time>after</div><div class="BoxItemTitle">t</div></div>')
    assert parse(spark, html)[0]["source"] == "Two"


def test_cards_are_handed_on_a_few_pages_at_a_time():
    n = 1000
    batch = pa.RecordBatch.from_pydict({"page_key": [str(i) for i in range(n)], "html": [CARD] * (n - 1) + [None]})
    got = list(pages._parse_batches(pages.Selectors())(iter([batch])))
    whole = pa.Table.from_batches(got).to_pydict()
    assert max(b.num_rows for b in got) <= 5 * pages.PAGES_AT_ONCE
    assert whole["page_key"] == [str(i) for i in range(n - 1) for _ in range(5)]
    assert whole["card"] == list(range(5)) * (n - 1)
