"""Classifier, extraction and search: held-out accuracy, literal pages, recall against brute force."""

import math
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bourseloom.llm import extraction, hashing_search, quality

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, n=1500, seed=3):
    """Clean, junk and toxic documents, a third of the labels held back."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    rows, truth = [], {}
    for i in range(n):
        own = list(rng.choice(words, size=int(rng.integers(40, 200))))
        kind = rng.choice(["clean", "junk", "toxic"], p=[0.8, 0.1, 0.1])
        if kind == "junk":
            own = [w.upper() + "!!" for w in own]
        elif kind == "toxic":
            own[::25] = ["nasty"] * len(own[::25])
        rows.append((i, " ".join(own)))
        truth[i] = kind
    labels = [(i, int(k != "junk"), int(k == "toxic")) for i, k in truth.items() if i % 3]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS), truth


def test_held_out_documents(spark):
    docs, labels, truth = corpus(spark)
    kept = {r["doc_id"] for r in quality.resample(docs, labels).collect()}
    out = [i for i in truth if i % 3 == 0]
    clean = [i for i in out if truth[i] == "clean"]
    bad = [i for i in out if truth[i] != "clean"]
    assert np.mean([i in kept for i in clean]) > 0.93
    assert np.mean([i in kept for i in bad]) < 0.1


def test_model_is_the_ratio_of_counts(spark):
    docs, labels, truth = corpus(spark, 200)
    ratios, share = quality.fit(docs, labels)
    known = [k for i, k in truth.items() if i % 3]
    assert share == pytest.approx(known.count("clean") / len(known))
    rows = {r["doc_id"]: r["text"].split() for r in docs.collect()}
    target = [w for i, t in rows.items() if i % 3 and truth[i] == "clean" for w in t]
    raw = [w for t in rows.values() for w in t]
    expected = raw.count("nasty") * len(target) / len(raw)
    import pyarrow as pa

    (_, _, data, offs), = quality.text_slices(pa.array(["nasty"]))
    bucket = quality._grams(data, offs, 1)[0][0]
    assert ratios[1][bucket] == pytest.approx(math.log(0.5 / (expected + 0.5)), rel=1e-5)


def test_kept_documents_against_brute_force(spark):
    docs, labels, truth = corpus(spark, 600, seed=4)
    rows = {r["doc_id"]: r["text"].split() for r in docs.collect()}
    known = {r["doc_id"]: r["quality"] == 1 and r["toxic"] == 0 for r in labels.collect()}
    held = {r[0] for r in labels.filter(quality.is_held_out(F.col("doc_id"))).select("doc_id").collect()}
    fitted = {i for i, clean in known.items() if clean and i not in held}
    weight = dict.fromkeys(rows, 0.0)
    for order in (1, 2):
        grams = {i: list(zip(*(w[k:] for k in range(order)), strict=False)) for i, w in rows.items()}
        raw = Counter(g for own in grams.values() for g in own)
        target = Counter(g for i in fitted for g in grams[i])
        share = sum(target.values()) / sum(raw.values())
        for i, own in grams.items():
            for g in own:
                e = raw[g] * share
                if abs(target[g] - e) >= quality.EVIDENCE[order] * math.sqrt(e + 1):
                    weight[i] += math.log((target[g] + 0.5) / (e + 0.5))
    noise = dict(zip(rows, quality._noise(np.array(list(rows)), quality.SEED), strict=True))
    low = np.quantile([weight[i] for i in held if known[i]], quality.LOSS)
    high = np.quantile([weight[i] for i in held if not known[i]], 1 - quality.LOSS)
    if low > high:
        want = {i for i in rows if weight[i] >= (low + high) / 2}
    else:
        zone = [i for i in rows if low <= weight[i] <= high]
        inside = [known[i] for i in held if low <= weight[i] <= high]
        k = round(np.mean(inside) * len(zone))
        best = sorted(zone, key=lambda i: (-weight[i] - noise[i], i))[:k]
        want = {i for i in rows if weight[i] > high} | set(best)
    got = {r["doc_id"]: r["__quality_weight"] for r in quality.resample(docs, labels).collect()}
    assert set(got) == want and len(want) < len(rows)
    # few of the test's word pairs share one of the 2^20 buckets
    assert np.mean([abs(got[i] - weight[i]) < 0.5 for i in got]) > 0.9


def test_a_table_of_clean_documents_stays_whole(spark):
    """Nothing goes by quota: the labels' share of bad documents says nothing about other documents."""
    docs, labels, truth = corpus(spark)
    clean = [i for i, kind in truth.items() if kind == "clean"]
    more = docs.filter(F.col("doc_id").isin(clean)).withColumn("doc_id", F.col("doc_id") + 100_000)
    kept = {r["doc_id"] for r in quality.resample(docs.union(more).union(
        more.withColumn("doc_id", F.col("doc_id") + 100_000)), labels).collect()}
    assert np.mean([i + d in kept for i in clean for d in (100_000, 200_000)]) > 0.97


def test_the_kth_score_is_exact(spark):
    rng = np.random.default_rng(5)
    scores = np.concatenate([rng.normal(size=30_000), np.full(8_000, 0.25)])
    rows = spark.createDataFrame([(i, float(s)) for i, s in enumerate(scores)], "id long, score double").repartition(4)
    order = sorted(range(len(scores)), key=lambda i: (-scores[i], i))
    for k in (1, 777, 15_000, 20_000, len(scores) - 1):
        assert quality.threshold(rows, k) == (scores[order[k - 1]], order[k - 1])
    assert quality.threshold(rows, len(scores)) is None
    assert quality.threshold(rows, 0)[0] == math.inf


def test_noise_is_gumbel():
    noise = quality._noise(np.arange(100_000), 1)
    assert abs(noise.mean() - 0.5772) < 0.02 and abs(noise.var() - math.pi**2 / 6) < 0.05


def test_classifier_on_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], LABELS)
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (3, None, None), (7, 1, None), (8, 1, 0), (2, 0, 1)], LABELS)
    assert quality.kept_documents(odd_docs, none).count() == odd_docs.count()
    kept = quality.kept_documents(odd_docs.withColumn("score", F.lit("x")), odd)
    assert kept.columns == [*odd_docs.columns, "score"] and 0 < kept.count() < odd_docs.count()
    assert {r["doc_id"]: r["clean"] for r in quality.clean_share(odd)[0].collect()} == {1: False, 2: False, 7: True, 8: True}
    assert quality.kept_documents(no_docs, odd).count() == 0


def test_every_label_counts(spark):
    """Far more labels than the 50,000 that were once the most: all of them make the model and the zone."""
    n = 220_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("plain").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    ratios, _ = quality.fit(docs, labels)
    assert all(not r.any() for r in ratios.values())
    counts = quality._counts(docs)
    assert {order: own.sum() for order, own in counts.items()} == {1: n, 2: 0}
    held = docs.select("doc_id", (F.col("doc_id") % 2 == 0).alias("clean"))
    scores = docs.select(F.col("doc_id").alias("id"), F.col("doc_id").cast("double").alias("weight"))
    low, high, share = quality.doubtful(scores, held, 0.001)
    assert low == pytest.approx(0.001 * (n - 2)) and high == pytest.approx(n - 1 - 0.001 * (n - 2))
    assert share == pytest.approx(0.5, abs=1e-4)


def test_the_driver_gets_ratios_only(spark, monkeypatch):
    """Counts stay in the shared folder: the driver collects the compressed ratios, a quarter of their size at most."""
    docs, labels, _ = corpus(spark, 200)
    seen = []
    kept = quality._gathered
    monkeypatch.setattr(quality, "_gathered", lambda rows, names, kind: seen.append(
        sum(len(x) for r in rows.select(*names).collect() for x in r)) or kept(rows, names, kind))
    ratios, _ = quality.fit(docs, labels)
    assert len(seen) == 1 and seen[0] < 2 * quality.BUCKETS
    assert all(own.dtype == np.float32 for own in ratios.values()) and ratios[1].any()


def test_only_labelled_texts_reach_the_join(spark):
    """Labels too many to broadcast must not send every text through a shuffle."""
    docs = spark.range(20_000).select(F.when(F.col("id") > 9, F.col("id")).alias("doc_id"), F.lit("plain").alias("text"))
    ids = spark.range(0, 20_000, 20).toDF("__quality_id")
    got = [r[0] for r in quality.maybe_of(docs, ids).select("__quality_id").collect()]
    assert {r[0] for r in ids.collect()} - {0} <= set(got) and len(got) < 1_300


# --- pages -------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href=/a>One</a></li></ul></nav><div class="ad">Buy</div>
<article><h1>Title &amp; more</h1><p>First <b>bold</b>\n\t text.<br>line<p>Second &eacute;&#233; &lt;x&gt;
<form><input value=q><label>Mail</label></form><div class="share-buttons social">Share</div>
<ul><li>item<li>item two</ul></article><aside>Side</aside><section id=comments><p>I think so</p></section>
<div class="cookie-notice"><p>Cookies</p></div><footer>&copy; x</footer>"""


def test_literal_page():
    flat = np.zeros(extraction.SHAPES), 0.0
    assert extraction.main_text(PAGE, flat) == (
        "Title & more\nFirst bold text. line\nSecond éé <x>\nitem\nitem two")


@pytest.mark.parametrize("html", [None, "", "   ", "<", "<p", "</div></p>", "<script>x", "<!-- a", "<nav>x</nav>"])
def test_pages_without_text(html):
    assert extraction.main_text(html, (np.zeros(extraction.SHAPES), 0.0)) == "" or html in ("<", "<p")


def test_page_without_landmarks(spark, sf_dir):
    model = extraction.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    prose = "The quick words of a long sentence, told again and again, run on and on until they end. " * 4
    menu = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(8))
    page = f"<div><ul>{menu}</ul></div><div><p>{prose}</p><p>Short one.</p><p>{prose}</p></div><div><ul>{menu}</ul></div>"
    assert extraction.main_text(page, model).split("\n") == [prose.strip(), "Short one.", prose.strip()]


def test_cut_is_the_cheapest_labelling():
    rng = np.random.default_rng(6)
    for _ in range(60):
        n = int(rng.integers(1, 9))
        odds = rng.normal(size=n) * 3
        edges = [(i, j, float(rng.random() * 2)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(side):
            return sum(abs(o) for o, s in zip(odds, side, strict=True) if (o > 0) != s) + sum(
                c for i, j, c in edges if side[i] != side[j])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(extraction.minimum_cut(odds, edges).tolist()) == pytest.approx(best)


def test_articles_of_the_table(spark, sf_dir):
    import html as entities
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    odd = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", "plain &amp; words")], pages.select("page_id", "url", "html").schema)
    both = pages.select("page_id", "url", "html").union(odd)
    texts = {(r["page_id"], r["url"]): r["text"] for r in extraction.extract(both.withColumn("text", F.lit(1))).collect()}
    for r in pages.collect():
        inner = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        parts = re.split("</?(?:p|h1)>", re.sub("</?b>", "", inner.replace("<br>", " ")))
        want = [re.sub(r"\s+", " ", entities.unescape(p)).strip() for p in parts]
        assert texts[r["page_id"], r["url"]] == "\n".join(w for w in want if w)
    assert texts[None, None] == ""
    assert extraction.extract(pages.limit(0)).count() == 0


# --- search --------------------------------------------------------------------------------------------


def exact(ids, x, query_id, query, k):
    score = (x * query).sum(axis=1)
    order = [j for j in np.lexsort((ids, -score)) if ids[j] != query_id][:k]
    return [(int(ids[j]), float(score[j])) for j in order]


def test_recall_on_the_table(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(hashing_search, "INDEX_BLOCK", 200)
    monkeypatch.setattr(hashing_search, "QUERY_BLOCK", 10)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = vectors.collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = hashing_search.nearest(vectors, vectors.filter("vec_id % 20 = 0")).collect()
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == ids[i])
        want = exact(ids, x, ids[i], x[i], 20)
        assert [r for r, _, _ in own] == list(range(1, 21))
        at = {int(v): k for k, v in enumerate(ids)}
        assert all(s == (x[at[v]] * x[i]).sum() for _, v, s in own)
        hits += len({v for _, v, _ in own} & {v for v, _ in want})
        total += 20
    assert hits / total >= 0.95


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20, [1.0, 0.0]), (1, [2.0, 1.0]), (2, [2.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [-1.0, 5.0]), (9, [-1.0, 5.0]), (40, [0.0, 3.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = hashing_search.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=3).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [
        (20, 1, 1, 2.0), (20, 2, 2, 2.0), (20, 3, 40, 0.0), (40, 1, 9, 15.0), (40, 2, 1, 3.0), (40, 3, 2, 3.0)]
    none = vectors.limit(0)
    assert hashing_search.nearest(none, none).count() == 0


def test_probing_finds_every_code_in_the_radius():
    rng = np.random.default_rng(8)
    a, b = (np.ascontiguousarray(rng.integers(0, 1 << 16, (n, 16)).astype(np.uint16)) for n in (40, 500))
    b[:40] = a ^ np.uint16(5)
    far = hashing_search.distances(a, b)
    for radius in (0, 20, 40, 110):
        reached = hashing_search.SubstringIndex(b).within(a, np.full(len(a), radius))
        assert (reached | (far > radius)).all()
    assert hashing_search.SubstringIndex(b).within(a, np.full(len(a), 32)).mean() < 0.5


def clusters(n: int, dim: int = 32, seed: int = 6) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.normal(size=(20, dim))[rng.integers(0, 20, n)] + rng.normal(scale=0.05, size=(n, dim))


def test_many_probes_cost_no_more_than_a_column(monkeypatch):
    """Probes that reach nearly all codes: the same rows as from the lists, in far less time."""
    own = np.random.default_rng(4).integers(0, 1 << 16, (20_000, hashing_search.PARTS), dtype=np.uint16)
    index, seconds, found = hashing_search.SubstringIndex(own), {}, {}
    for cost in (0, hashing_search.PROBE_COST):
        monkeypatch.setattr(hashing_search, "PROBE_COST", cost)
        start = time.process_time()
        found[cost] = [index.inside(q, 108) for q in own[:30]]
        seconds[cost] = time.process_time() - start
    (few, lists), (_, columns) = found.items()
    assert all((a == b).all() and n == m for (a, n), (b, m) in zip(lists, columns, strict=True))
    assert columns[0][1] > 0.9 * len(own) and seconds.pop(few) > 2 * max(seconds.values())


def test_clusters_leave_most_codes_out():
    x = clusters(2000)
    norm = float(np.sqrt((x * x).sum(1).max())) * (1 + 1e-12)
    turn = hashing_search.learn(hashing_search._lift(x, norm) / norm)
    own = hashing_search.codes(hashing_search._lift(x, norm), turn)
    asked = hashing_search.codes(np.concatenate([x[:100], np.zeros((100, 1))], axis=1), turn)
    index, far = hashing_search.SubstringIndex(own), hashing_search.distances(asked, own)
    radius = int(np.quantile(np.sort(far, axis=1)[:, 20], 0.9))
    compared = 0
    for i, code in enumerate(asked):
        rows, n = index.inside(code, radius)
        assert rows.tolist() == np.flatnonzero(far[i] <= radius).tolist()
        compared += n
    assert compared < 0.7 * far.size


def test_recall_in_clusters(spark, monkeypatch):
    monkeypatch.setattr(hashing_search, "INDEX_BLOCK", 700)
    x = clusters(2000)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = hashing_search.nearest(rows, rows.filter("vec_id % 20 = 0")).collect()
    ids = np.arange(len(x))
    want = {(i, v) for i in range(0, len(x), 20) for v, _ in exact(ids, x, i, x[i], 20)}
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(found) == len(want) and len(found & want) / len(want) >= 0.95


SAID = "Prices rose on Monday, and traders said that more would follow in the week to come."


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><body><article><p>{SAID}</article>",
    f"<html><head><meta charset=utf-8><title>T</title><p>{SAID}",
    *(f"<body><div><{t}>Go</div><article><p>{SAID}</article>" for t in ("button", "object", "select", "noscript", "canvas")),
    *(f"<body><{t}>Go<article><p>{SAID}</p></article></body>" for t in ("button", "object", "select", "canvas", "svg")),
    f"<body><form action=x><nav>Home, News</nav><article><p>{SAID}</p></article><footer>Terms</footer></form>",
    f"<body><div class='layout has-sidebar'><article><p>{SAID}</p></article><aside>See also</aside></div>",
    f"<body><div class='layout has-sidebar'><div><p>{SAID}</p></div></div>",
    f"<body><nav>{SAID} {SAID}</nav><form><article><p>{SAID}</p></article></form>",
    f"<body><article><p>{SAID}</p></article><div class=related><article>Other</article></div><button><div>Buy</div></button>",
    f"<body><article><p>{SAID}</p></article><div class=comments><article class=comment>{SAID} {SAID}</article></div>",
])
def test_main_text_of_unclosed_and_wrapped_pages(page):
    assert extraction.main_text(page, (np.zeros(extraction.SHAPES), 0.1)) == SAID
