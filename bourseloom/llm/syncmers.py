"""Document fingerprints from closed syncmers, matched by position.

A k-mer of ``K`` code points is an anchor if the smallest hash among its ``S``-mers stands at its
first or last place. That depends on the k-mer alone, so an anchor is chosen wherever its text
occurs, whatever surrounds it; about 2 / (K - S + 1) of all places are anchors. A fingerprint is
the list of the anchors' 32-bit hashes in the order of their places, in base64. A text without
any has one anchor, its whole self; an empty text has none.

Two fingerprints are alike by the longest chain of equal anchors in the same order, against the
mean number of anchors: 0 to 1, and 1 for equal ones.

``edited_neighbours`` gives every document the one next to it by falling id. Rows are dealt into
ranges of ids; the first row of a range is also sent to the range before it (that of the first
range to the last one), and each range is streamed in order, one pair at a time.

Defined cases: a null text is empty, two empty texts are alike by 1; a null id is the smallest;
rows with one id follow each other by text; a single row follows itself; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseloom.llm.arrays import _BASE, _INVERSE, _powers, mix

K, S = 32, 8
#: Characters in a range of ids, and the most ranges.
RANGE_CHARS, MOST_RANGES = 8_000_000, 20_000
_NULL_ID = -(1 << 63)
Anchors = tuple[np.ndarray, np.ndarray]


def _slide_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    span, low = 1, h
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def anchors(texts: list[str]) -> list[Anchors]:
    """(positions, 32-bit hashes) of each text's anchors."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(points)
    value = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(value * _powers("up", _BASE, n), out=total[1:])
    down = _powers("down", _INVERSE, n + 1)
    chosen = np.zeros(0, np.int64)
    if n >= K:
        small = mix((total[S:] - total[:-S]) * down[:n + 1 - S])
        width = K - S + 1
        low = _slide_min(small, width)
        at_edge = (low == small[:len(low)]) | (low == small[width - 1:width - 1 + len(low)])
        place = np.flatnonzero(at_edge)
        owner = np.searchsorted(ends, place, "right")
        chosen = place[place + K <= ends[owner]]
    h = mix((total[chosen + K] - total[chosen]) * down[chosen]) if len(chosen) else np.zeros(0, np.uint64)
    h = (h >> np.uint64(32)).astype(np.uint32)
    cut = np.searchsorted(chosen, np.concatenate([[0], ends]))
    out: list[Anchors] = []
    for i, size in enumerate(sizes):
        start = ends[i] - size
        if size and cut[i] == cut[i + 1]:
            whole = (total[ends[i]:ends[i] + 1] - total[start]) * down[start] + np.uint64(size)
            out.append((np.zeros(1, np.int64), (mix(whole) >> np.uint64(32)).astype(np.uint32)))
        else:
            out.append((chosen[cut[i]:cut[i + 1]] - start, h[cut[i]:cut[i + 1]]))
    return out


def text_anchors(texts: list[str], limit: int = 400_000) -> list[Anchors]:
    """``anchors`` in runs of about ``limit`` code points; a longer text comes alone and whole."""
    out, run, held = [], [], 0
    for text in texts:
        if run and held + len(text) > limit:
            out.extend(anchors(run))
            run, held = [], 0
        run.append(text)
        held += len(text)
    return out + (anchors(run) if run else [])


def encode(found: Anchors) -> str:
    return base64.b64encode(found[1].astype("<u4").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def _numbered(h: np.ndarray) -> np.ndarray:
    """Hashes with the number of their occurrence, so that repeated anchors pair up in turn."""
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]])) if len(h) else order
    turn = np.arange(len(h)) - np.repeat(same, np.diff(np.append(same, len(h))))
    out = np.empty(len(h), np.uint64)
    out[order] = (h[order].astype(np.uint64) << np.uint64(32)) | turn.astype(np.uint64)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Of two fingerprints' hashes, in order."""
    if len(a) == len(b) and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    _, at_a, at_b = np.intersect1d(_numbered(a), _numbered(b), assume_unique=True, return_indices=True)
    follow = at_b[np.argsort(at_a)]
    chain = len(follow)
    if chain > 1 and (np.diff(follow) < 0).any():
        tails: list[int] = []
        for x in follow.tolist():
            k = bisect_left(tails, x)
            tails[k:k + 1] = [x]
        chain = len(tails)
    return 2.0 * chain / (len(a) + len(b))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row."""

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([encode(a) for a in text_anchors(texts)], pa.string())],
                names=["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_chars long, fingerprint string")


def in_ranges(docs: DataFrame) -> DataFrame:
    """(g, border, id, text): rows in ranges of falling ids, each range with the row that follows it."""
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"), "text")
    chars = ids.agg(F.sum(F.length("text"))).first()[0] or 0
    n = min(MOST_RANGES, max(1, -(-chars // RANGE_CHARS)))
    cuts = np.zeros(0, np.int64)
    if n > 1:
        shares = [i / n for i in range(1, n)]
        cuts = np.unique(np.array(ids.agg(F.percentile_approx("id", shares, 20 * n)).first()[0], np.int64))

    @F.pandas_udf("int")
    def range_of(column: pd.Series) -> pd.Series:
        """Number of the range, 0 for the largest ids."""
        return pd.Series(len(cuts) - np.searchsorted(cuts, column.to_numpy(), "left"))

    heads = sorted((r["g"], r["head"]) for r in ids.groupBy(range_of("id").alias("g")).agg(
        F.max("id").alias("head")).collect())
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}
    head_ids = np.array(sorted(before), np.int64)
    to = np.array([before[int(h)] for h in head_ids], np.int64)

    @F.pandas_udf("array<int>")
    def places(column: pd.Series) -> pd.Series:
        """Twice the range; for the first id of a range also the range before it, as a border."""
        own = column.to_numpy()
        main = 2 * (len(cuts) - np.searchsorted(cuts, own, "left"))
        k = np.minimum(np.searchsorted(head_ids, own), len(head_ids) - 1)
        first = head_ids[k] == own
        return pd.Series([[m, 2 * t + 1] if f else [m] for m, f, t in zip(main, first, to[k], strict=True)])

    dealt = ids.select("id", "text", F.explode(places("id")).alias("p"))
    dealt = dealt.select((F.col("p") / 2).cast("int").alias("g"), (F.col("p") % 2).alias("border"), "id", "text")
    return dealt.repartition(n, "g").sortWithinPartitions("g", "border", F.col("id").desc(), "text")


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness to each other and the next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of
    the next document's text.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]

    def pairs(rows: list[tuple], found: list[Anchors]) -> Iterator[tuple]:
        for (g, border, id_, text), (h, _, _, following), a, b in zip(
                rows, rows[1:], found, found[1:], strict=False):
            if g == h and not border:
                half = len(text) // 2
                yield id_, text, text[:len(text) - half] + following[:half], a, b

    def run(batches):
        last: list[tuple] = []
        last_found: list[Anchors] = []
        for batch in batches:
            for lo in range(0, len(batch), 500):
                part = batch.slice(lo, 500)
                rows = list(zip(*(part.column(i).to_pylist() for i in range(3)),
                                [t or "" for t in part.column(3).to_pylist()], strict=True))
                found = last_found + text_anchors([r[3] for r in rows])
                rows = last + rows
                made = list(pairs(rows, found))
                edited = text_anchors([m[2] for m in made])
                yield pa.RecordBatch.from_arrays([
                    pa.array([None if m[0] == _NULL_ID else m[0] for m in made], pa.int64()),
                    pa.array([len(m[1]) for m in made], pa.int64()),
                    pa.array([hashlib.sha256(m[2].encode()).hexdigest() for m in made], pa.string()),
                    pa.array([encode(m[3]) for m in made], pa.string()),
                    pa.array([encode(e) for e in edited], pa.string()),
                    pa.array([likeness(m[3][1], e[1]) for m, e in zip(made, edited, strict=True)], pa.float64()),
                    pa.array([likeness(m[3][1], m[4][1]) for m in made], pa.float64())], names=names)
                last, last_found = rows[-1:], found[-1:]

    return in_ranges(docs).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
