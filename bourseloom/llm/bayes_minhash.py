"""Near-duplicate documents by banded MinHash, verified sequentially by posterior bounds, then exactly.

1. A document's set is its distinct 4-word shingles. Equal sets are one node, named by a digest. A node
   has ``BANDS`` x ``ROWS`` MinHash values of 8 bits; bands are keys over ``ROWS`` of them. Two sets that
   link share no band with probability (1 - 0.8 ** ROWS) ** BANDS at most, 6e-7 as set.
2. Candidates: nodes of one band. Each node is first paired with its band's smallest node, so pairs grow
   with the bands and not with the square of a group.
3. Sequential Bayesian verification: signatures are compared in batches of ``BATCH`` values. After each
   batch, a pair goes if the posterior probability that its similarity is 0.8 or more (uniform prior, so
   far m of n values equal) is below ``MISS``. Chance equality of 8 bits can only add matches, so a pair
   that links is not lost more often.
4. Survivors are verified exactly, by their whole sets: 100 * intersection >= 80 * union.
5. Bands whose nodes are in different components after that are compared again, all pairs across
   components, in blocks of ``TILE`` x ``TILE`` nodes inside the tasks by the same batches. Only the nodes
   with surviving pairs leave a task; they meet again with their whole sets, each pair in the first band
   of both, and the links that span a block's components are what is passed on. So no pairs are rows.

Defined cases: a text without words (or null) has an empty set and links with nothing; fewer than four
words are one shingle; rows of one id are separate rows, each classed by its own text; a null id names a
component only if it has no other id; an empty table gives an empty table; other columns are not read.
Digests have 64 bits: among a billion different texts the odds that any two share one are about 3 in 100.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseloom.llm.arrays import LOWER, mix, shingle_hashes, span_hashes, text_slices, word_spans
from bourseloom.llm.bloom import contains, filter_bits, seen_twice
from bourseloom.llm.components import components
from bourseloom.llm.store import settle

WORDS, PERCENT = 4, 80
ROWS, BANDS, BATCH = 5, 36, 36
VALUES = ROWS * BANDS
#: Probability, after each batch, that a dropped pair links all the same.
MISS = 1e-5
#: Nodes on a side of a block, and pairs of one comparison. A node counts once more per ``LONG`` shingles,
#: so the sets of a block's side take about 8 * TILE * LONG bytes at most, however long its texts are.
TILE, LONG, AT_ONCE = 2048, 2000, 1 << 18

_rng = np.random.default_rng(13)
_XOR = _rng.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_TIMES = _rng.integers(0, 1 << 63, VALUES, dtype=np.uint64) | np.uint64(1)
_BAND = _rng.integers(0, 1 << 63, BANDS, dtype=np.uint64) | np.uint64(1)


def least_matches(miss: float = MISS) -> list[int]:
    """For each batch's end, the least matches that keep a pair.

    With a uniform prior, P(similarity >= t | m of n equal) is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(BATCH, VALUES + 1, BATCH):
        t, total, m = PERCENT / 100, 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def shingles(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first row, end row, shingle hashes, offsets of the rows in them)."""
    for lo, hi, data, offs in text_slices(column):
        low = LOWER[data]
        starts, ends, counts = word_spans(low, offs)
        hashes, made = shingle_hashes(span_hashes(low, starts, ends), counts, WORDS)
        yield lo, hi, hashes, np.concatenate([[0], np.cumsum(made)])


def distinct(hashes: np.ndarray) -> np.ndarray:
    own = np.sort(hashes)
    return own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def name_of(own: np.ndarray) -> int:
    """64-bit digest of a set of hashes; 0 for the empty one."""
    if not len(own):
        return 0
    with np.errstate(over="ignore"):
        total = np.sum(mix(own + np.uint64(len(own))), dtype=np.uint64)
        return int(mix(np.array([total])).view(np.int64)[0]) or 1


def signatures_of(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(rows, VALUES) MinHash values of 32 bits of runs of hashes, none of them empty."""
    out = np.empty((len(starts), VALUES), np.uint32)
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat(((hashes ^ _XOR[k]) * _TIMES[k]) >> np.uint64(32), starts)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """(rows, BANDS) keys: equal where a band's values are equal."""
    cut = values.reshape(len(values), BANDS, ROWS).astype(np.uint64)
    h = np.repeat(_BAND[None, :], len(values), 0)
    for r in range(ROWS):
        h = mix(h ^ cut[:, :, r])
    return h.view(np.int64)


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, n, node, sig, bands) per row, written; sig and bands only once per node and task."""

    def run(batches):
        done: set[int] = set()
        for batch in batches:
            for lo, hi, hashes, at in shingles(batch.column(1)):
                n, node, fresh = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64), []
                for i in range(hi - lo):
                    own = distinct(hashes[at[i]:at[i + 1]])
                    n[i], node[i] = len(own), name_of(own)
                    if len(own) and node[i] not in done:
                        done.add(node[i])
                        fresh.append(i)
                sig, bands = [None] * (hi - lo), [None] * (hi - lo)
                if fresh:
                    some = np.concatenate([hashes[at[i]:at[i + 1]] for i in fresh])
                    sizes = (at[1:] - at[:-1])[fresh]
                    values = signatures_of(some, np.cumsum(sizes) - sizes)
                    short = values.astype(np.uint8)
                    keys = band_keys(short)
                    for k, i in enumerate(fresh):
                        sig[i], bands[i] = short[k].tobytes(), keys[k]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(n), pa.array(node), pa.array(sig, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n", "node", "sig", "bands"])

    return settle(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, node long, sig binary, bands array<long>"), "signatures")


def shared_bands(rows: DataFrame) -> DataFrame:
    """(key, band, node, n, first): nodes of the bands that two nodes or more have, and the band's smallest node."""
    lists = rows.filter(F.col("bands").isNotNull()).select("node", "n", F.posexplode("bands").alias("band", "key"))
    ends = lists.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    ends = settle(ends.filter(F.col("first") < F.col("last")).select("key", "first"), "bands")
    return settle(lists.join(ends, "key"), "band-lists")


def node_signatures(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, sig) of the given nodes, one row each, written."""
    found = rows.filter(F.col("sig").isNotNull()).select("node", "n", "sig").join(nodes, "node", "left_semi")
    return settle(found.groupBy("node").agg(F.first("n").alias("n"), F.first("sig").alias("sig")), "node-signatures")


def _matrix(sigs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sigs.to_pylist()), np.uint8).reshape(-1, VALUES)


def _sized(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """False only where the sizes alone rule a link out."""
    return 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)


def survivors(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """Places of the pairs (rows ``left`` of ``a``, ``right`` of ``b``) that no batch drops."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for k, need in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (a[left[alive], part] == b[right[alive], part]).sum(axis=1)
        stay = matches >= need
        alive, matches = alive[stay], matches[stay]
    return alive


def likely(pairs: DataFrame, sigs: DataFrame, miss: float) -> DataFrame:
    """(x, y): the pairs that sequential verification keeps."""
    least = least_matches(miss)
    left = sigs.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("sig").alias("sx"))
    right = sigs.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("sig").alias("sy"))
    both = pairs.join(left, "x").filter(F.col("nx") > 0).join(right, "y")

    def run(batches):
        for batch in batches:
            if len(batch):
                x, y, nx, ny = (batch.column(i).to_numpy() for i in range(4))
                rows = np.flatnonzero(_sized(nx, ny))
                stay = rows[survivors(_matrix(batch.column(4)), _matrix(batch.column(5)), rows, rows, least)]
                yield pa.RecordBatch.from_arrays([pa.array(x[stay]), pa.array(y[stay])], names=["x", "y"])

    return both.select("x", "y", "nx", "ny", "sx", "sy").mapInArrow(run, "x long, y long")


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, hashes) of the wanted nodes: sorted distinct hashes as bytes.

    A bounded Bloom filter keeps other texts from leaving the task; the join is exact.
    """
    held = docs.sparkSession.sparkContext.broadcast(
        seen_twice(wanted, lambda b: b.column(0).to_numpy(), filter_bits(wanted.count() or 1), least=1))

    def run(batches):
        done: set[int] = set()
        for batch in batches:
            for lo, hi, hashes, at in shingles(batch.column(0)):
                node, sets = [], []
                for i in range(hi - lo):
                    own = distinct(hashes[at[i]:at[i + 1]])
                    name = name_of(own)
                    if name not in done and contains(held.value, np.array([name], np.int64))[0]:
                        done.add(name)
                        node.append(name)
                        sets.append(own.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int64()), pa.array(sets, pa.binary())], names=["node", "hashes"])

    made = docs.select("text").mapInArrow(run, "node long, hashes binary")
    out = settle(made.join(wanted, "node", "left_semi").groupBy("node").agg(
        F.first("hashes").alias("hashes")), "whole-sets")
    held.destroy()
    return out


def exact(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(x, y): the pairs that link, by their whole sets."""
    wanted = settle(pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct(), "wanted")
    sets = whole_sets(docs, wanted)
    left = sets.select(F.col("node").alias("x"), F.col("hashes").alias("hx"))
    right = sets.select(F.col("node").alias("y"), F.col("hashes").alias("hy"))

    def run(batches):
        for batch in batches:
            stay = []
            for i, (p, q) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if overlap_links(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)):
                    stay.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(stay, pa.int64())) for i in (0, 1)],
                                             names=["x", "y"])

    return settle(pairs.join(left, "x").join(right, "y").select("x", "y", "hx", "hy").mapInArrow(
        run, "x long, y long"), "links")


def open_bands(lists: DataFrame, found: DataFrame) -> DataFrame:
    """(key, band, node, c, k) of bands with nodes in different components ``c``; ``k`` is their weight in nodes."""
    rows = settle(lists.join(found, "node", "left").select(
        "key", "band", "node", "n", F.coalesce("component", "node").alias("c")).distinct(), "classed-bands")
    weight = F.sum(1 + F.col("n") / LONG)
    ends = rows.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), weight.alias("k"))
    return rows.join(settle(ends.filter("lo < hi").select("key", "k"), "open-bands"), "key").drop("n")


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that are equal in the first ``keys`` columns, from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        cols = [batch.column(i).to_numpy() for i in range(keys)]
        new = np.flatnonzero(reduce(np.logical_or, [c[1:] != c[:-1] for c in cols])) + 1
        if held and any(held[-1].column(i)[-1] != batch.column(i)[0] for i in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *new.tolist(), len(batch)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if lo:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of ``open_bands`` for every block (key, i, j) that their tile ``t`` is a side of."""
    tiles = F.ceil(F.col("k") / TILE)
    own = F.pmod(F.xxhash64("node"), tiles).cast("int")
    each = rows.withColumn("t", own).withColumn("o", F.explode(F.sequence(F.lit(0), tiles.cast("int") - 1)))
    return each.select("key", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"),
                       "t", "band", "node", "c")


def block_pairs(group: pa.Table, values: np.ndarray, least: list[int]) -> Iterator[tuple[np.ndarray, ...]]:
    """(left, right) rows of a block that sequential verification keeps, of different components.

    A pair is taken in the first band that both nodes have in common, and in no other one.
    """
    band, i, j, t, node, c, n = (group[x].to_numpy() for x in ("band", "i", "j", "t", "node", "c", "n"))
    left, right = np.flatnonzero(t == i), np.flatnonzero(t == j)
    step = max(1, AT_ONCE // max(1, len(right)))
    for lo in range(0, len(left), step):
        part = left[lo:lo + step]
        fit = (c[part][:, None] != c[right][None, :]) & _sized(n[part][:, None], n[right][None, :])
        if i[0] == j[0]:
            fit &= node[part][:, None] < node[right][None, :]
        p, q = np.nonzero(fit)
        p, q = part[p], right[q]
        stay = survivors(values, values, p, q, least)
        p, q = p[stay], q[stay]
        common = (values[p] == values[q]).reshape(-1, BANDS, ROWS).all(axis=2)
        first = common.argmax(axis=1) == band[0]
        yield p[first], q[first]


def meeting_nodes(rows: DataFrame, sigs: DataFrame, miss: float) -> DataFrame:
    """The rows of each block that are in a pair of it that sequential verification keeps."""
    least = least_matches(miss)
    keep = ["key", "i", "j", "t", "band", "node", "c"]

    def run(batches):
        for group in groups(batches, 3):
            found = [np.concatenate(x) for x in block_pairs(group, _matrix(group["sig"]), least)]
            if found and len(met := np.unique(np.concatenate(found))):
                yield from group.select(keep).take(pa.array(met)).combine_chunks().to_batches()

    blocks = dealt(rows).join(sigs, "node").select(*keep, "n", "sig")
    return settle(blocks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(
        run, "key long, i int, j int, t int, band int, node long, c long"), "meeting-nodes")


def overlap_links(p: np.ndarray, q: np.ndarray) -> bool:
    """Whether two sorted sets of hashes link."""
    at = np.minimum(np.searchsorted(q, p), len(q) - 1)
    same = int((q[at] == p).sum())
    return 100 * same >= PERCENT * (len(p) + len(q) - same)


def across(docs: DataFrame, met: DataFrame, sigs: DataFrame, miss: float) -> DataFrame:
    """(x, y): exactly verified links that span, in each block, what its pairs link."""
    least = least_matches(miss)
    sets = whole_sets(docs, settle(met.select("node").distinct(), "wanted"))

    def run(batches):
        for group in groups(batches, 3):
            values, node, c = _matrix(group["sig"]), group["node"].to_numpy(), group["c"].to_numpy()
            hashes = [np.frombuffer(x, np.uint64) for x in group["hashes"].to_pylist()]
            root = {x: x for x in c.tolist()}

            def top(x):
                while root[x] != x:
                    root[x] = x = root[root[x]]
                return x

            links = []
            for left, right in block_pairs(group, values, least):
                order = np.argsort(-(values[left] == values[right]).sum(axis=1), kind="stable")
                for p, q in zip(left[order].tolist(), right[order].tolist(), strict=True):
                    a, b = top(int(c[p])), top(int(c[q]))
                    if a != b and overlap_links(hashes[p], hashes[q]):
                        root[a] = b
                        links.append((int(node[p]), int(node[q])))
            if links:
                x, y = np.array(links, np.int64).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["x", "y"])

    blocks = met.join(sigs, "node").join(sets, "node").select(
        "key", "i", "j", "t", "band", "node", "c", "n", "sig", "hashes")
    return settle(blocks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(
        run, "x long, y long"), "across")


def linked(docs: DataFrame, rows: DataFrame, miss: float) -> DataFrame:
    """(node, component) of all nodes that link with another one."""
    lists = shared_bands(rows)
    sigs = node_signatures(rows, settle(lists.select("node").distinct(), "band-nodes"))
    star = settle(lists.filter(F.col("node") != F.col("first")).select(
        F.col("first").alias("x"), F.col("node").alias("y")).distinct(), "star-pairs")
    links = exact(docs, settle(likely(star, sigs, miss), "likely"))
    found = components(links, "x", "y")
    met = meeting_nodes(settle(open_bands(lists, found), "open"), sigs, miss)
    if met.isEmpty():
        return found
    return components(links.union(across(docs, met, sigs, miss)), "x", "y")


def near_duplicates(docs: DataFrame, miss: float = MISS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row.

    ``component_id`` is the smallest doc_id reachable by links, the row's own included; ``kept`` says
    that it is the row's own.
    """
    rows = described(docs)
    named = rows.select("doc_id", F.col("n").alias("n_shingles"), "node").join(
        linked(docs, rows, miss), "node", "left").select(
        "doc_id", "n_shingles", "node", F.coalesce("component", "node").alias("class"))
    full = settle(named.filter(F.col("node") != 0), "classed")
    least = settle(full.groupBy("class").agg(F.min("doc_id").alias("component_id")), "classes")
    empty = rows.filter(F.col("node") == 0).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.join(least, "class").select("doc_id", "n_shingles", "component_id").union(empty).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
