"""Quality classifier by importance resampling: target against raw n-gram models, Gumbel top-k.

Two generative models of hashed word n-grams are counted: the target's, over clean labelled
documents, and the raw text's, over all documents. A bucket's log ratio is
``log((c + SMOOTH) / (e + SMOOTH))`` with ``c`` its count in the target and ``e`` the count that
the raw model expects there. Ratios that differ from 0 by less than ``EVIDENCE`` standard errors
are taken as 0, so words too rare to tell say nothing. A document's log weight is the sum over its
n-grams. With Gumbel noise from its id added, the ``k`` largest are a sample without replacement,
in proportion to the weights.

A quarter of the labelled documents is held out of the target. Their log weights tell where the
classes overlap: from ``LOSS`` of the clean ones below up to ``LOSS`` of the others above. Documents
under this zone go and those over it stay, however many there are; inside it, ``k`` is the zone's
documents times the share of clean ones among the held-out documents there. Where the held-out
documents lack one of the classes, the zone is everything and the share that of all labels.

The target is fitted on all clean labelled documents that are not held out, the zone on all that
are; the raw model, the scores and the choice cover all documents. Counts travel as
compressed blocks of a fixed number of buckets: a bucket's background is the same part of all n-grams
at every size of the corpus, so a word's weight does not fade as it grows. The k-th score is found by counting, in narrowing
ranges; scores are not sorted or collected.

Defined cases: a null or empty text has log weight 0 and stays with those in doubt; rows with one id get the same noise; a null
id has noise of its own; a document with contradicting labels is not clean, null labels are
ignored; equal scores are kept by the smaller id, and rows equal in score and id stand or fall
together, so ties may keep more than k; without labels all documents stay; an empty table gives
an empty table; helper columns start with ``__quality_``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourseloom.llm.arrays import mix, span_hashes, text_slices, word_spans
from bourseloom.llm.bloom import contains, filter_bits, seen_twice
from bourseloom.llm.store import settle, settle_texts
from bourseloom.operators.quantiles import exact_quantiles

BUCKETS, ORDERS = 1 << 20, (1, 2)
SMOOTH, EVIDENCE = 0.5, {1: 2.0, 2: 4.0}
SEED = 11
HELD_OUT, LOSS = 4, 0.001
#: Labelled ids up to this number are broadcast.
FEW_IDS = 50_000
_BLOCK = 1 << 14


def _grams(data: np.ndarray, offs: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram, and n-grams per row."""
    starts, ends, counts = word_spans(data, offs)
    h = span_hashes(data, starts, ends)
    row = np.repeat(np.arange(len(counts)), counts)
    got = h.copy()
    for k in range(1, order):
        got[:-k] = mix(got[:-k] * np.uint64(3) + h[k:])
    whole = np.ones(len(h), bool)
    if order > 1:
        whole[-(order - 1):] = False
        whole[:-(order - 1)] &= row[order - 1:] == row[:-(order - 1)]
    buckets = (got[whole] >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    return buckets, np.bincount(row[whole], minlength=len(counts))


def clean_share(labels: DataFrame) -> tuple[DataFrame, float | None]:
    """(doc_id, clean) per labelled document, and the share of clean ones."""
    known = labels.filter("doc_id is not null and (quality is not null or toxic is not null)")
    judged = known.groupBy("doc_id").agg(
        F.min((F.coalesce("quality", F.lit(1)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("clean"))
    return judged, judged.agg(F.avg(F.col("clean").cast("double"))).first()[0]


def _names(kind: str) -> list[str]:
    return [f"{kind}{order}" for order in ORDERS]


def _partial(docs: DataFrame, kind: str) -> DataFrame:
    """(kind, block, n..): bucket counts of each task's texts, in compressed blocks for each order."""
    def count(batches):
        sums = {order: np.zeros(BUCKETS, np.int64) for order in ORDERS}
        for batch in batches:
            for _, _, data, offs in text_slices(batch.column(0)):
                for order, own in sums.items():
                    own += np.bincount(_grams(data, offs, order)[0], minlength=BUCKETS)
        blocks = range(BUCKETS // _BLOCK)
        packed = [pa.array([zlib.compress(own[b * _BLOCK:(b + 1) * _BLOCK].tobytes(), 1) for b in blocks], pa.binary())
                  for own in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(blocks)), pa.array(blocks, pa.int32()), *packed], names=["kind", "block", *_names("n")])

    schema = ", ".join(["kind string, block int", *(f"{n} binary" for n in _names("n"))])
    return docs.select("text").mapInArrow(count, schema)


def _merged(parts: DataFrame) -> DataFrame:
    """(block, raw.., target.., and the sums of each): the counts of a block, compressed, in one row."""
    kinds = [*_names("raw"), *_names("target")]

    def fold(batches):
        sums: dict[int, dict[str, np.ndarray]] = {}
        for batch in batches:
            for kind, b, *own in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                block = sums.setdefault(b, {k: np.zeros(_BLOCK, np.int64) for k in kinds})
                for name, x in zip(_names(kind), own, strict=True):
                    block[name] += np.frombuffer(zlib.decompress(x), np.int64)
        keys = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int32()),
             *(pa.array([zlib.compress(sums[b][k].tobytes(), 1) for b in keys], pa.binary()) for k in kinds),
             *(pa.array([int(sums[b][k].sum()) for b in keys], pa.int64()) for k in kinds)],
            names=["block", *kinds, *(f"{k}_sum" for k in kinds)])

    schema = ", ".join(["block int", *(f"{k} binary" for k in kinds), *(f"{k}_sum long" for k in kinds)])
    return settle_texts(parts.repartition(BUCKETS // _BLOCK, "block").mapInArrow(fold, schema), "counts")


def _gathered(rows: DataFrame, names: list[str], kind: type) -> dict[int, np.ndarray]:
    """Blocks of each order put together on the driver."""
    out = {order: np.zeros(BUCKETS, kind) for order in ORDERS}
    for r in rows.select("block", *names).collect():
        for order, name in zip(ORDERS, names, strict=True):
            out[order][r["block"] * _BLOCK:(r["block"] + 1) * _BLOCK] = np.frombuffer(zlib.decompress(r[name]), kind)
    return out


def _counts(docs: DataFrame) -> dict[int, np.ndarray]:
    """Bucket counts of the n-grams of all texts, for each order."""
    return _gathered(_merged(_partial(docs, "raw")), _names("raw"), np.int64)


def maybe_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(__quality_id, text) of the documents whose id may be one of ``ids``, by a bounded Bloom filter.

    It misses none of them and lets few others through, whose texts an exact join need not shuffle.
    """
    keys = lambda column: mix(column.to_numpy().view(np.uint64))
    held = docs.sparkSession.sparkContext.broadcast(
        seen_twice(ids, lambda batch: keys(batch.column(0)), filter_bits(ids.count() or 1), least=1))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(contains(held.value, keys(batch.column(0)))))

    return docs.select(F.col("doc_id").cast("long").alias("__quality_id"), "text").filter(
        "__quality_id is not null").mapInArrow(run, "__quality_id long, text string")


def labelled_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(__quality_id, text) of the documents whose id is one of ``ids``.

    Few ids are broadcast, without a filter. With many, the filter and what comes after the join are parted
    by a shuffle: in no plan does a task hold two Python workers.
    """
    if ids.count() <= FEW_IDS:
        keyed = docs.select(F.col("doc_id").cast("long").alias("__quality_id"), "text")
        return keyed.join(F.broadcast(ids), "__quality_id", "left_semi")
    return maybe_of(docs, ids).join(ids.hint("merge"), "__quality_id", "left_semi")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[int, np.ndarray], float | None]:
    """Log ratio per bucket for each n-gram order, and the share of clean documents."""
    judged, share = clean_share(labels)
    if share is None:
        return {}, None
    clean = settle(judged.filter("clean").select(F.col("doc_id").cast("long").alias("__quality_id")).filter(
        "__quality_id is not null"), "clean")
    labelled = labelled_texts(docs, clean)
    counts = _merged(_partial(docs, "raw").union(_partial(labelled, "target")))
    totals = counts.agg(*(F.coalesce(F.sum(f"{k}_sum"), F.lit(0)).alias(k)
                          for k in (*_names("raw"), *_names("target")))).first().asDict()

    def ratio(batches):
        for batch in batches:
            out = []
            for order in ORDERS:
                of, own = f"raw{order}", f"target{order}"
                packed = []
                for a, b in zip(batch.column(of).to_pylist(), batch.column(own).to_pylist(), strict=True):
                    raw, target = (np.frombuffer(zlib.decompress(x), np.int64) for x in (a, b))
                    expected = raw * (totals[own] / max(1, totals[of]))
                    found = np.log((target + SMOOTH) / (expected + SMOOTH))
                    found[np.abs(target - expected) < EVIDENCE[order] * np.sqrt(expected + 1)] = 0
                    packed.append(zlib.compress(found.astype(np.float32).tobytes(), 1))
                out.append(pa.array(packed, pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("block"), *out], names=["block", *_names("ratio")])

    schema = ", ".join(["block int", *(f"{n} binary" for n in _names("ratio"))])
    return _gathered(counts.mapInArrow(ratio, schema), _names("ratio"), np.float32), share


def _noise(ids: np.ndarray, seed: int) -> np.ndarray:
    h = mix(ids.astype(np.int64).view(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    return -np.log(-np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53))


def _score(ratios: dict[int, np.ndarray], ids: np.ndarray, texts: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Log weight, and the same with Gumbel noise, per row."""
    weight = np.zeros(len(ids))
    for lo, hi, data, offs in text_slices(texts):
        for order, ratio in ratios.items():
            buckets, per_row = _grams(data, offs, order)
            weight[lo:hi] += np.bincount(np.repeat(np.arange(hi - lo), per_row),
                                         ratio[buckets], minlength=hi - lo)
    return weight, weight + _noise(ids, seed)


def threshold(scores: DataFrame, k: int) -> tuple[float, int] | None:
    """(score, id) of the k-th row by falling score and rising id; None if all are kept.

    Counts over 1,024 ranges narrow it down; only when few rows are left are these sorted.
    """
    n, low, high = scores.agg(F.count(F.lit(1)), F.min("score"), F.max("score")).first()
    if k >= n:
        return None
    while n > 10_000 and low < high:
        width = (high - low) / 1024
        place = F.least(F.floor((F.col("score") - low) / width), F.lit(1023))
        inside = scores.filter(F.col("score").between(low, high))
        bins = inside.groupBy(place.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
        for r in sorted(bins.collect(), key=lambda r: -r["bin"]):
            if k <= r["n"]:
                n, low, high = r["n"], r["low"], r["high"]
                break
            k -= r["n"]
    inside = scores.filter(F.col("score").between(low, high))
    last = inside.orderBy(F.col("score").desc(), "id").limit(max(k, 1)).orderBy("score", F.col("id").desc()).first()
    return (last["score"], last["id"]) if k > 0 else (float("inf"), -(1 << 63))


def is_held_out(doc_id: Column) -> Column:
    """Whether a labelled document judges the cut instead of fitting the target."""
    return F.pmod(F.xxhash64(doc_id.cast("long"), F.lit("held out")), F.lit(HELD_OUT)) == 0


def doubtful(scores: DataFrame, held: DataFrame, loss: float = LOSS) -> tuple[float, float, float] | None:
    """(low, high, share): the log weights where classes overlap, and the clean share of held-out rows there.

    ``scores`` has (id, weight), ``held`` (doc_id, clean). None if a class is missing. All held-out
    documents are used; the ends are exact quantiles, for which no task sorts a whole class.
    """
    rows = settle(scores.join(held, F.col("id") == F.col("doc_id")).groupBy("id").agg(
        F.min("weight").alias("weight"), F.min("clean").alias("clean")), "held-out")
    ends = {(r["clean"], r["prob"]): r["quantile"]
            for r in exact_quantiles(rows, ["clean"], "weight", [loss, 1 - loss]).collect()}
    if len({clean for clean, _ in ends}) < 2:
        return None
    low, high = ends[True, loss], ends[False, 1 - loss]
    if low > high:  # nothing overlaps: the middle parts them
        return (low + high) / 2, (low + high) / 2, 1.0
    share = rows.filter(F.col("weight").between(low, high)).agg(F.avg(F.col("clean").cast("double"))).first()[0]
    return low, high, 1.0 if share is None else share


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = SEED) -> DataFrame:
    """The kept documents with ``__quality_weight`` (log) and ``__quality_score`` (with noise).

    With ``share`` given, that share of all documents is sampled, whatever held-out labels say.
    """
    ratios, prior = fit(docs, labels if share is not None else labels.filter(
        ~F.coalesce(is_held_out(F.col("doc_id")), F.lit(False))))
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(ratios)
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))

    def narrow(batches):
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, _score(model.value, own, batch.column(1), seed))],
                names=["id", "weight", "score"])

    scores = settle_texts(docs.select(ids.alias("id"), "text").mapInArrow(
        narrow, "id long, weight double, score double"), "scores")
    low, high, zone = float("-inf"), float("inf"), scores
    if share is None:
        judged, prior = clean_share(labels)
        found = doubtful(scores, judged.filter(is_held_out(F.col("doc_id")))) if prior is not None else None
        if found:
            low, high, share = found
            zone = scores.filter(F.col("weight").between(low, high))
        else:
            share = 1.0 if prior is None else prior
    cut = threshold(zone, round(share * zone.count()))
    own = [c for c in docs.columns if c not in ("__quality_weight", "__quality_score")]
    keyed = docs.select(*own, ids.alias("__quality_id"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(own).schema)

    def keep(batches):
        for batch in batches:
            key = batch.column("__quality_id").to_numpy(zero_copy_only=False)
            weight, score = _score(model.value, key, batch.column("text"), seed)
            kept = weight >= low
            if cut is not None:
                kept &= (weight > high) | (score > cut[0]) | ((score == cut[0]) & (key <= cut[1]))
            out = pa.RecordBatch.from_arrays(
                [batch.column(c) for c in own] + [pa.array(weight), pa.array(score)],
                names=[*own, "__quality_weight", "__quality_score"])
            yield out.filter(pa.array(kept))

    return keyed.mapInArrow(keep, f"{schema}, __quality_weight double, __quality_score double")


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The kept documents in the columns of ``docs``."""
    return resample(docs, labels, **options).select(docs.columns)
