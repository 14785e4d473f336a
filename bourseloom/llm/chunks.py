"""Substring dedup by content-defined chunks: exact to the byte once chunks have met.

Texts are cut where a gear hash of the last ``GRAM`` bytes is the smallest (the rightmost of equals)
of some ``WINDOW`` hashes in a row. Cuts depend on nearby bytes only, so they fall back into step behind an
insertion, and a passage of ``GRAM - 1 + 3 * WINDOW`` bytes (99) has three cuts of its own whatever stands
around it. A chunk and the next one have one digest, kept if two documents have it, by a
bounded Bloom filter. Kept chunks that follow each other make a stretch; stretches that are too
short for a span are left out before anything is shuffled.

Each digest names its smallest document, the holder, by a partial aggregate. Where a later document has it,
the stretch and the holder's bytes at the same distance are compared: the run of equal bytes
around the chunk, cut to whole words, is a span if it has ``min_span`` bytes or ``MIN_WORDS`` words. So
the holder has the whole span, and no document of a smaller id has it, as none has that chunk.
A passage is missed only if each pair of its neighbouring chunks (57 bytes at most) stands in some still
smaller document that does not have the passage. Spans of different holders may overlap; one that lies
inside others is left out.

A word of more than ``LONG_WORD`` bytes (text without blanks) may be cut at each code point. A document
posts a digest once, with all its places; the n-th place meets the holder's n-th (counted round, where it has
fewer), so repeated phrases stay linear.

Defined cases: a null or empty text has no chunks; rows with one id are one document, whose own
repeats don't count; a null id counts as the smallest and is reported as null; an empty table
gives an empty table; helper columns start with ``__chunk_``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourseloom.llm.arrays import mix, span_hashes, text_slices, word_spans
from bourseloom.llm.bloom import contains, filter_bits, seen_twice
from bourseloom.llm.store import settle

GRAM, WINDOW, MIN_SPAN, MIN_WORDS = 16, 28, 140, 50
LONG_WORD = 32
#: How far a span may reach beyond its outermost cuts, and one byte more to see a word's end.
BEFORE, BEHIND = GRAM + WINDOW, WINDOW + 1
_GEAR = np.random.default_rng(3).integers(0, 1 << 32, 256, dtype=np.uint32)
_NULL_ID = -(1 << 63)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash h = 2 h + g(byte) of the last ``GRAM`` bytes, after each byte."""
    h = _GEAR[data]
    reach = 1
    while reach < min(GRAM, len(h)):
        h[reach:] += h[:-reach] << np.uint32(reach)
        reach *= 2
    return h


def cuts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of all rows of a slice; they cover the rows."""
    n = len(data)
    # A hash in the upper half and the place, counted down, in the lower one: the least is the rightmost of equals.
    low = (mix(gear(data).astype(np.uint64)) | np.uint64(0xFFFFFFFF)) - np.arange(n, dtype=np.uint64)
    size = 1
    while size < WINDOW and len(low):
        step = min(size, WINDOW - size)
        low = np.minimum(low[:-step], low[step:])
        size += step
    inside = np.zeros(n + 1, np.int32)
    has = np.diff(offs) >= GRAM - 1 + WINDOW
    inside[offs[:-1][has] + GRAM - 1] += 1
    inside[offs[1:][has] - WINDOW + 1] -= 1
    low = low[np.cumsum(inside[:-1])[:len(low)] > 0]
    at = (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64) + 1
    bounds = np.unique(np.concatenate([at, offs]))
    return bounds[:-1], bounds[1:]


def _units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and word numbers of the units: words, and the code points of long words."""
    words = np.arange(len(starts))
    long = ends - starts > LONG_WORD
    if not long.any():
        return starts, ends, words
    depth = np.zeros(len(data) + 1, np.int32)
    depth[starts[long]] += 1
    depth[ends[long]] -= 1
    mark = (np.cumsum(depth[:-1]) > 0) & ((data & 0xC0) != 0x80)
    mark[starts] = True
    begin = np.flatnonzero(mark)
    word = np.searchsorted(starts, begin, "right") - 1
    return begin, np.minimum(np.append(begin[1:], len(data)), ends[word]), word


def _pairs(texts: pa.Array):
    """Per slice: first row, bytes, offsets, then row, start, end and digest of each chunk with the next one."""
    for lo, _, data, offs in text_slices(texts):
        starts, ends = cuts(data, offs)
        row = np.searchsorted(offs, starts, "right") - 1
        same = row[1:] == row[:-1]
        begin, end = starts[:-1][same], ends[1:][same]
        if len(begin):
            yield lo, data, offs, row[:-1][same], begin, end, span_hashes(data, begin, end)


def _digests(texts: pa.Array) -> np.ndarray:
    """The digests, each once per row."""
    found = [np.zeros(0, np.uint64)]
    for _, _, _, row, _, _, digest in _pairs(texts):
        order = np.lexsort((digest, row))
        row, digest = row[order], digest[order]
        found.append(digest[np.append(True, (digest[1:] != digest[:-1]) | (row[1:] != row[:-1]))])
    return np.concatenate(found)


def _stretches(offs, row, begin, end, least: int):
    """Bytes (from, to) of its row that a span around each pair may have, and which pairs' are long enough."""
    new = np.append(True, (row[1:] != row[:-1]) | (begin[1:] > end[:-1]))
    at = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    lo = np.maximum(begin[first] - BEFORE - offs[row[first]], 0)
    hi = np.minimum(end[last] + BEHIND, offs[row[first] + 1]) - offs[row[first]]
    return lo[at], hi[at], (hi - lo >= least)[at]


def _sides(data: np.ndarray, offs, row, begin, end, least: int) -> np.ndarray:
    """Two hashes of 8 bits of the bytes before and behind each pair, in one number; 0 where the row ends earlier.

    A run of ``least`` equal bytes around a pair reaches half of what it has besides it on one side at least.
    """
    reach = np.maximum(1, -(-(least - (end - begin)) // 2))
    out = np.zeros(len(row), np.uint64)
    before, behind = begin - reach >= offs[row], end + reach <= offs[row + 1]
    for has, lo, hi, shift in ((before, begin - reach, begin, 0), (behind, end, end + reach, 8)):
        found = span_hashes(data, lo[has], hi[has]) >> np.uint64(56)
        out[has] |= np.maximum(found, np.uint64(1)) << np.uint64(shift)
    return out.astype(np.int32)


def _same_side(a: Column, b: Column) -> Column:
    """False only where the bytes on neither side can be equal."""
    both = lambda mask: (a.bitwiseAND(mask) != 0) & (a.bitwiseAND(mask) == b.bitwiseAND(mask))
    return both(F.lit(0xFF)) | both(F.lit(0xFF00))


def _postings(docs: DataFrame, least: int) -> DataFrame:
    """(digest, id, doc, at, lo, hi, by, more): repeated pairs of chunks, one row per document."""
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 1
    bitmap = seen_twice(docs.select("text"), lambda batch: _digests(batch.column(0)),
                        filter_bits(total // (WINDOW // 2), 8))
    held = docs.sparkSession.sparkContext.broadcast(bitmap)
    place = pa.struct([(c, pa.int32()) for c in ("at", "lo", "hi", "by")])

    def run(batches):
        for batch in batches:
            ids, names = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for base, data, offs, row, begin, end, digest in _pairs(batch.column(2)):
                keep = contains(held.value, digest)
                if not keep.any():
                    continue
                row, begin, end, digest = row[keep], begin[keep], end[keep], digest[keep]
                lo, hi, enough = _stretches(offs, row, begin, end, least)
                at = begin - offs[row]
                order = np.flatnonzero(enough)
                order = order[np.lexsort((digest[order], row[order]))]
                if not len(order):
                    continue
                by = _sides(data, offs, row[order], begin[order], end[order], least)
                row, digest = row[order], digest[order]
                at, lo, hi = (x[order].astype(np.int32) for x in (at, lo, hi))
                further = np.append(False, (digest[1:] == digest[:-1]) & (row[1:] == row[:-1]))
                first = np.flatnonzero(~further)
                n = np.diff(np.append(first, len(row)))
                more = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(n - 1)).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(x[further]) for x in (at, lo, hi, by)], fields=list(place)),
                    mask=pa.array(n == 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest[first].view(np.int64)), pa.array(ids[base + row[first]]),
                     pa.array(names[base + row[first]]), *(pa.array(x[first]) for x in (at, lo, hi, by)), more],
                    names=["digest", "id", "doc", "at", "lo", "hi", "by", "more"])

    rows = docs.select("id", "doc", "text").mapInArrow(
        run, "digest long, id long, doc long, at int, lo int, hi int, by int, more array<struct<at:int,lo:int,hi:int,by:int>>")
    rows = settle(rows, "chunks")
    held.destroy()
    return rows


def _meetings(docs: DataFrame, least: int) -> DataFrame:
    """(id, doc, lo, hi, first, first_doc, shift, ats): stretches and where their chunks' holders have them."""
    seen = _postings(docs, least)
    first = seen.groupBy("digest").agg(
        F.min(F.struct("id", "doc", "at", "by", F.transform("more", lambda p: F.struct(p["at"], p["by"])).alias("more"))).alias("h"),
        F.max("id").alias("last"))
    met = seen.join(first.filter("h.id < last").select("digest", "h"), "digest").filter("id > h.id")
    one = met.select("id", "doc", "h", F.posexplode(F.concat(
        F.array(F.struct("at", "lo", "hi", "by")),
        F.coalesce("more", F.array().cast("array<struct<at:int,lo:int,hi:int,by:int>>")))).alias("k", "p"))
    turn = F.col("k") % (F.coalesce(F.size("h.more"), F.lit(0)) + 1)
    there = F.when(F.col("h.more").isNull() | (turn == 0), F.struct(F.col("h.at").alias("at"), F.col("h.by").alias("by"))
                   ).otherwise(F.get("h.more", turn - 1))
    one = one.select("id", "doc", "h", "p", there.alias("t")).filter(_same_side(F.col("p.by"), F.col("t.by")))
    there = F.col("t.at")
    return one.select(
        "id", "doc", "p.lo", "p.hi", F.col("h.id").alias("first"), F.col("h.doc").alias("first_doc"),
        (F.col("p.at") - there).alias("shift"), "p.at").groupBy(
        "id", "doc", "lo", "hi", "first", "first_doc", "shift").agg(F.array_sort(F.collect_set("at")).alias("ats"))


def _equal_runs(own: bytes, there: bytes, lo: int, shift: int, stop: int, ats: list[int], min_span: int):
    """Spans (start, stop) of whole words around ``ats`` that both sides have; ``own`` starts at ``lo``."""
    skip = max(0, shift - lo)
    mine, other = np.frombuffer(own, np.uint8), np.frombuffer(there, np.uint8)
    n = max(0, min(len(mine) - skip, len(other)))
    same = np.zeros(n + 2, np.int8)
    same[1:-1] = mine[skip:skip + n] == other[:n]
    edges = np.flatnonzero(np.diff(same)) + skip
    places = np.array(ats) - lo
    runs = [(s, e) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
            if e - s >= min(min_span, 2 * MIN_WORDS - 1) and np.searchsorted(places, s) < np.searchsorted(places, e)]
    if not runs:
        return
    begin, end, word = _units(mine, *word_spans(mine, np.array([0, len(mine)]))[:2])
    if lo > 0 and len(begin) and begin[0] == 0:
        begin, end, word = begin[1:], end[1:], word[1:]
    if lo + len(mine) > stop and len(end) and end[-1] == len(mine):
        begin, end, word = begin[:-1], end[:-1], word[:-1]
    for s, e in runs:
        a, b = np.searchsorted(begin, s), np.searchsorted(end, e, "right") - 1
        if b >= a and (end[b] - begin[a] >= min_span or word[b] - word[a] + 1 >= MIN_WORDS):
            yield lo + int(begin[a]), lo + int(end[b])


def _cover(spans: list[dict]) -> list[dict]:
    """The fewest spans that hold all bytes of spans sorted by their start."""
    kept, done, i = [], -1, 0
    while i < len(spans):
        if spans[i]["stop"] <= done:
            i += 1
            continue
        best, limit = spans[i], max(done, spans[i]["start"])
        while i < len(spans) and spans[i]["start"] <= limit:
            if spans[i]["stop"] > best["stop"]:
                best = spans[i]
            i += 1
        kept.append(best)
        done = best["stop"]
    return kept


def _keyed(docs: DataFrame) -> DataFrame:
    """(id, doc, text); ``doc`` is the text's hash: rows of one id with different texts have places of their own.

    Where no id is repeated it is 0, which costs a shuffle next to nothing.
    """
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"),
                       (F.xxhash64("text") if _repeats(docs) else F.lit(0).cast("long")).alias("doc"), "text")


def _repeats(docs: DataFrame) -> bool:
    ids = docs.groupBy(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id")).count()
    return not ids.filter("count > 1").isEmpty()


def _once(texts: DataFrame) -> DataFrame:
    """Each (id, doc) once. Only where some row is repeated do the texts need an aggregate for it."""
    keys = texts.groupBy("id", "doc").count()
    return texts if keys.filter("count > 1").isEmpty() else texts.dropDuplicates(["id", "doc"])


def _spans(docs: DataFrame, min_span: int) -> DataFrame:
    """(id, doc, start, length, first): repeated spans; none lies inside others."""
    texts = _keyed(docs)
    asked = settle(_meetings(texts, min(min_span, 2 * MIN_WORDS - 1)), "meetings")
    raw = _once(texts).withColumn("text", F.col("text").cast("binary"))
    there = asked.join(raw.toDF("first", "first_doc", "text"), ["first", "first_doc"]).select(
        *asked.columns, F.expr("substring(text, greatest(lo - shift, 0) + 1, hi - greatest(lo, shift))").alias("there"))
    both = there.join(raw, ["id", "doc"]).select(
        "id", "doc", "first", "lo", "hi", "shift", "ats", "there", F.expr("substring(text, lo + 1, hi - lo + 1)").alias("own"))

    def compare(batches):
        for batch in batches:
            out = [(r["id"], r["doc"], start, stop, r["first"]) for r in batch.to_pylist()
                   for start, stop in _equal_runs(r["own"], r["there"], r["lo"], r["shift"], r["hi"], r["ats"], min_span)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [()] * 5)],
                names=["id", "doc", "start", "stop", "first"])

    spans = both.mapInArrow(compare, "id long, doc long, start long, stop long, first long").distinct()
    lists = spans.groupBy("id", "doc").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "first"))).alias("l"))

    def run(batches):
        for batch in batches:
            ids, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = [(i, d, s["start"], s["stop"] - s["start"], s["first"])
                   for i, d, l in zip(ids, names, batch.column(2).to_pylist(), strict=True) for s in _cover(l)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [()] * 5)],
                names=["id", "doc", "start", "length", "first"])

    return lists.mapInArrow(run, "id long, doc long, start long, length long, first long")


def repeated_spans(docs: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """(doc_id, start, length, first_doc_id): repeated spans in bytes of the UTF-8 text."""
    named = lambda c: F.when(F.col(c) != _NULL_ID, F.col(c))
    return _spans(docs, min_span).select(
        named("id").alias("doc_id"), "start", "length", named("first").alias("first_doc_id"))


def without_repeats(docs: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """Documents whose repeated spans are cut out of the text."""
    spans = _spans(docs, min_span).groupBy(F.col("id").alias("__chunk_id"), F.col("doc").alias("__chunk_doc")).agg(
        F.array_sort(F.collect_list(F.struct("start", "length"))).alias("__chunk_spans"))
    keyed = docs.withColumns({"__chunk_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)),
                              "__chunk_doc": F.xxhash64("text") if _repeats(docs) else F.lit(0).cast("long")})
    joined = keyed.join(settle(spans, "spans").hint("shuffle_hash"), ["__chunk_id", "__chunk_doc"], "left").drop(
        "__chunk_id", "__chunk_doc")
    names = docs.columns

    def run(batches):
        for batch in batches:
            texts = []
            for text, drop in zip(batch.column("text").to_pylist(),
                                  batch.column("__chunk_spans").to_pylist(), strict=True):
                if drop:
                    raw, at, kept = text.encode(), 0, []
                    for d in drop:
                        kept.append(raw[at:max(at, d["start"])])
                        at = d["start"] + d["length"]
                    text = b"".join([*kept, raw[at:]]).decode(errors="ignore")
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, batch.schema.field("text").type) if n == "text" else batch.column(n)
                 for n in names], names=names)

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    return joined.mapInArrow(run, schema)
