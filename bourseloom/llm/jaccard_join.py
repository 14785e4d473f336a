"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

A document's set is its distinct 5-word shingles, as 64-bit hashes. Equal sets are one node, the
digest of the set, so copies never meet as pairs. The global order of shingles is cut into
fragments by hash. The first fragments (``ORDER_SHARE`` of the hash range) choose the candidates:

* Their postings (shingle, node) are counted exactly. Inside these fragments the order is by that
  count, rarest first. A node keeps the first ``n - ceil(0.75 n) + 1`` shingles of this order:
  two sets that link share one of them. A passage in many documents stands late in the order, so
  its long list is used by hardly any of them. A node with fewer shingles than that in the first
  fragments takes its smallest hashes beyond them, last in the order.
* In each kept list every node is paired with the list's smallest node, then with a node drawn
  for the list: pairs grow with the postings, not with the square of a list. Lists hold ids only;
  distinct pairs meet their sizes and bitmaps once, which rule most of them out.
* What long lists still have in different components is compared in blocks inside tasks: nodes
  that lists connect, in classes of like size, cut into tiles by their shingles. A set travels once
  per block, not once per pair, and no pair becomes a row unless it links.
* Only on request, for the number of links, all pairs of the long lists are made, in tiles of ``TILE``
  nodes by the list, so that no task has a long list's square to itself.

Only shingles that two rows have are posted. They are counted exactly, in buckets of the hash range whose
number grows with the table; a bounded Bloom filter of them keeps most others in their task, the join is exact.

Pairs are verified by partial overlaps: all fragments of both sets are intersected separately and
the counts are summed per pair. A pair links when 100 * overlap >= 75 * union.

Defined cases: a text without words (or null) has an empty set and links with nothing; fewer than
five words are one shingle; rows with one id are separate rows, each classed by its own text; a
null id is never a component's name unless the component has no other; an empty table gives an
empty table; other input columns are not read. The digest has 64 bits: among a billion different
texts the odds that any two share one are about 3 in 100.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bourseloom.llm.arrays import mix, row_sets
from bourseloom.llm.bloom import contains, filter_bits, seen_twice
from bourseloom.llm.components import components
from bourseloom.llm.store import settle, settle_texts, text_batches

#: Share of the hash range whose fragments choose candidates.
ORDER_SHARE = 0.375
#: Keys that a task counts at a time, and keys of a bucket, on average.
KEY_RUN = 1 << 20
#: Fragments for the partial overlaps.
FRAGMENTS = 8
WORD_NAMES = [f"w{k}" for k in range(FRAGMENTS)]
#: Lists up to this length give all their pairs at once.
SMALL_LIST = 8
#: A node's first lists that are looked at to make a pair once.
FIRST_LISTS = 8
#: Nodes of a tile, on average, and shingles of a tile whose whole sets travel.
TILE = 1000
TILE_SHINGLES = 2_000_000
#: Nodes up to this number are broadcast to pick their sets before these are shuffled.
FEW_NODES = 300_000
WORDS, PERCENT = 5, 75
_EMPTY = 0


def _digest(own: np.ndarray) -> int:
    """64-bit name of a set; 0 for the empty one."""
    if not len(own):
        return _EMPTY
    with np.errstate(over="ignore"):
        return int(mix(np.array([np.sum(mix(own ^ np.uint64(len(own))), dtype=np.uint64)]))
                   .view(np.int64)[0]) or 1


def _prefix(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node) of every row."""

    def run(batches):
        for batch in batches:
            n, node = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for i, own in row_sets(batch.column(1), WORDS):
                n[i], node[i] = len(own), _digest(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(node)],
                                             names=["doc_id", "n_shingles", "node"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, node long")


def _posted(own: np.ndarray) -> np.ndarray:
    """A set's shingles in the first fragments, or its smallest hashes where these are too few."""
    k = max(int(np.searchsorted(own, np.uint64(int(ORDER_SHARE * 2**64)))),
            min(len(own), _prefix(len(own))))
    return own[:k]


def _keys(own: np.ndarray) -> np.ndarray:
    """Posted shingles by a second hash: posted ones lie in the first part of the range, their keys in all of it."""
    return mix(_posted(own))


def repeated_shingles(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(s, k): keys of the posted shingles that k > 1 rows have, exactly.

    Tasks sort and count their keys, ``KEY_RUN`` at a time, and send each bucket the steps between
    its keys, by byte planes (the upper ones are empty), with their counts. There are as many
    buckets as keep one at about ``KEY_RUN`` keys, so the cost is in proportion at any size.
    """
    total = members.agg(F.sum("n_shingles")).first()[0] or 1
    bits = int(total * ORDER_SHARE / KEY_RUN).bit_length()

    def cut(keys: list[np.ndarray]) -> pa.RecordBatch:
        own, counts = np.unique(np.concatenate(keys), return_counts=True)
        edges = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
        at = [0, *np.searchsorted(own, edges).tolist(), len(own)]
        some = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(at, at[1:], strict=False)) if lo < hi]
        steps = [np.diff(own[lo:hi], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes() for _, lo, hi in some]
        held = [counts[lo:hi].astype(np.uint32).tobytes() for _, lo, hi in some]
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _, _ in some], pa.int32()), pa.array(steps, pa.binary()), pa.array(held, pa.binary())],
            names=["bucket", "steps", "counts"])

    def count(batches):
        keys, size = [], 0
        for batch in batches:
            for _, own in row_sets(batch.column(0), WORDS):
                keys.append(_keys(own))
                size += len(keys[-1])
                if size >= KEY_RUN:
                    yield cut(keys)
                    keys, size = [], 0
        if size:
            yield cut(keys)

    def fold(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for b, steps, counts in zip(*(batch.column(i) for i in range(3)), strict=True):
                planes = np.frombuffer(steps.as_buffer(), np.uint8).reshape(8, -1)
                own = np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)
                held.setdefault(b.as_py(), []).append((own, np.frombuffer(counts.as_buffer(), np.uint32).copy()))
        while held:
            own, counts = (np.concatenate(x) for x in zip(*held.popitem()[1], strict=True))
            order = np.argsort(own, kind="stable")
            own, counts = own[order], counts[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            k = np.add.reduceat(counts, first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[first][k > 1].view(np.int64)), pa.array(k[k > 1])], names=["s", "k"])

    counted = docs.select("text").mapInArrow(count, "bucket int, steps binary, counts binary")
    with text_batches(docs.sparkSession):
        return settle(counted.repartition(1 << bits, "bucket").mapInArrow(fold, "s long, k long"), "repeated-shingles")


def postings(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """(s, node, n, r): posted shingles that may repeat; r is how many the node posts in all.

    A task posts equal sets once, so a group of copies sends a row per task, not per copy.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        seen_twice(repeated.select("s"), lambda b: b.column(0).to_numpy(), filter_bits(repeated.count() or 1), least=1))

    def run(batches):
        done: set[int] = set()
        for batch in batches:
            s, node, n, r, sizes = [], [], [], [], []
            for _, own in row_sets(batch.column(0), WORDS):
                name = _digest(own)
                if name == _EMPTY or name in done:
                    continue
                done.add(name)
                posted = _keys(own)
                again = posted[contains(shared.value, posted)]
                s.append(again)
                sizes.append(len(again))
                node.append(name)
                n.append(len(own))
                r.append(len(posted))
            counts = np.array(sizes, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((np.concatenate(s) if s else np.zeros(0, np.uint64)).view(np.int64)),
                 pa.array(np.repeat(np.array(node, np.int64), counts)),
                 pa.array(np.repeat(np.array(n, np.int32), counts)),
                 pa.array(np.repeat(np.array(r, np.int32), counts))], names=["s", "node", "n", "r"])

    made = settle_texts(docs.select("text").mapInArrow(run, "s long, node long, n int, r int"), "postings")
    shared.destroy()
    return made


def kept_postings(posted: DataFrame, repeated: DataFrame) -> DataFrame:
    """(s, node, k): the first shingles of each node in the order, where k > 1 nodes meet."""
    shared = settle(posted.join(repeated, "s").distinct(), "shared-postings")
    per_node = W.partitionBy("node")
    alone = F.col("r") - F.count(F.lit(1)).over(per_node)
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(PERCENT) / 100) + 1
    at = F.row_number().over(per_node.orderBy("k", "s"))
    first = settle(shared.select("s", "node", (prefix - alone).alias("room"), at.alias("at"))
                   .filter("at <= room").select("s", "node"), "first-postings")
    meet = first.groupBy("s").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    return settle(first.join(meet, "s"), "kept-postings")


def fragments(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, w0.., parts) of the wanted nodes: the whole set, cut into its fragments.

    ``w<k>`` has a bit for each hash of fragment k: a bitmap of one word per fragment. A bounded
    Bloom filter keeps other nodes from leaving the task; the join is exact.
    """
    bits = filter_bits(wanted.count() or 1)
    held = docs.sparkSession.sparkContext.broadcast(
        seen_twice(wanted, lambda b: b.column(0).to_numpy(), bits, least=1))
    cuts = np.array([k * (2**64 // FRAGMENTS) for k in range(1, FRAGMENTS)], np.uint64)

    def run(batches):
        done: set[int] = set()
        for batch in batches:
            node, n, words, sizes, hashes = [], [], [], [0], []
            for _, own in row_sets(batch.column(0), WORDS):
                name = _digest(own)
                if name in done or not contains(held.value, np.array([name], np.int64))[0]:
                    continue
                done.add(name)
                node.append(name)
                n.append(len(own))
                hashes.append(own.view(np.int64))
                at = [0, *np.searchsorted(own, cuts).tolist(), len(own)]
                bit = np.uint64(1) << (own & np.uint64(63))
                for lo, hi in zip(at, at[1:], strict=False):
                    sizes.append(hi - lo)
                    words.append(np.bitwise_or.reduce(bit[lo:hi], initial=np.uint64(0)))
            flat = np.concatenate(hashes) if hashes else np.zeros(0, np.int64)
            inner = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(flat))
            outer = pa.ListArray.from_arrays(
                pa.array(np.arange(len(node) + 1) * FRAGMENTS, pa.int32()), inner)
            bitmap = np.array(words, np.uint64).view(np.int64).reshape(-1, FRAGMENTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array(n, pa.int64()),
                 *(pa.array(np.ascontiguousarray(bitmap[:, k])) for k in range(FRAGMENTS)), outer],
                names=["node", "n", *WORD_NAMES, "parts"])

    schema = ", ".join(["node long, n long", *(f"{w} long" for w in WORD_NAMES), "parts array<array<long>>"])
    made = docs.select("text").mapInArrow(run, schema)
    out = settle_texts(made.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "fragments")
    held.destroy()
    return out


def may_link(a: str, b: str):
    """False only for pairs that can't link, by the sizes and the bits that one side has alone."""
    def at_most(x: str, y: str):
        alone = [F.bit_count(F.col(f"{x}.{w}").bitwiseAND(F.bitwise_not(f"{y}.{w}"))) for w in WORD_NAMES]
        return F.col(f"{x}.n") - sum(alone[1:], alone[0])

    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    return F.least(at_most(a, b), at_most(b, a)) * (100 + PERCENT) >= both * PERCENT


def first_pairs(lists: DataFrame) -> DataFrame:
    """(x, y): every pair of a short list; in a long one, each node with the smallest."""
    long = lists.filter(F.col("k") > SMALL_LIST)
    centre = long.groupBy("s").agg(F.min("node").alias("x"))
    star = long.join(centre, "s").filter("node <> x").select("x", F.col("node").alias("y"))
    short = lists.filter(F.col("k") <= SMALL_LIST).groupBy("s").agg(
        F.array_sort(F.collect_list("node")).alias("l"))
    short = short.select(F.posexplode("l").alias("i", "x"), "l").select(
        "x", F.explode(F.slice("l", F.col("i") + 2, F.lit(SMALL_LIST))).alias("y"))
    return star.union(short).distinct()


def able(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """(x, nx, y, ny) of the pairs that may link by their nodes' sizes and bitmaps."""
    whole = F.struct("n", *WORD_NAMES)
    met = pairs.join(parts.select(F.col("node").alias("x"), whole.alias("a")), "x").join(
        parts.select(F.col("node").alias("y"), whole.alias("b")), "y")
    return met.filter(may_link("a", "b")).select(
        "x", F.col("a.n").alias("nx"), "y", F.col("b.n").alias("ny"))


def open_lists(lists: DataFrame, found: DataFrame) -> DataFrame:
    """(s, node, c) of the long lists whose nodes are in different components ``c`` so far."""
    rows = lists.filter(F.col("k") > SMALL_LIST).join(found, "node", "left").select(
        "s", "node", F.coalesce("component", "node").alias("c"))
    ends = rows.groupBy("s").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    return settle(rows.join(ends.filter("lo < hi").select("s"), "s", "left_semi"), "open-lists")


def centre_pairs(rows: DataFrame) -> DataFrame:
    """Each node with its list's centre, another one in each list: pairs grow with the postings."""
    centre = rows.groupBy("s").agg(F.min_by(F.struct("node", "c"), F.xxhash64("s", "node")).alias("z"))
    centre = centre.select("s", F.col("z.node").alias("b"), F.col("z.c").alias("cb"))
    met = rows.join(centre, "s").filter(F.col("c") != F.col("cb"))
    return met.select(F.least("node", "b").alias("x"), F.greatest("node", "b").alias("y")).distinct()


def blocks(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Open nodes with their sets, once in each block of two tiles that may hold a link.

    Nodes that lists connect are a group ``g``. Sizes of two sets that link differ by a third at
    most, so a node meets its own class ``q`` of sizes and both next to it. A class is cut into
    tiles by its shingles and nodes. ``block`` names two tiles, ``right`` the second one's nodes.
    """
    centre = rows.groupBy("s").agg(F.min("node").alias("x"))
    group = components(rows.join(centre, "s").select("x", F.col("node").alias("y")).distinct(), "x", "y")
    size_class = F.floor(F.log("n") / F.log(F.lit(100 / PERCENT + 0.01))).cast("int")
    nodes = parts.select("node", "n").join(
        rows.select("node", "c").distinct().join(group.withColumnRenamed("component", "g"), "node"), "node")
    nodes = settle(nodes.select("g", size_class.alias("q"), "node", "c", "n"), "open-nodes")
    tiles = F.ceil(F.greatest(F.sum("n") / TILE_SHINGLES, F.count(F.lit(1)) / TILE)).cast("int")
    cut = nodes.groupBy("g", "q").agg(tiles.alias("m"))
    here = nodes.join(cut, ["g", "q"])
    for name, step in (("above", 1), ("below", -1)):
        here = here.join(cut.select("g", (F.col("q") - step).alias("q"), F.col("m").alias(name)), ["g", "q"], "left")
    here = here.withColumn("t", F.pmod(F.xxhash64("node"), F.col("m")).cast("int"))

    def met(count: str, block):
        some = F.sequence(F.lit(0), F.col(count) - 1)
        return F.coalesce(F.transform(some, block), F.array())

    def named(q, first, second, next_class: int, right):
        return F.struct(q.alias("q"), first.alias("t"), second.alias("u"), F.lit(next_class).alias("up"),
                        right.alias("right"))

    at = F.concat(
        met("m", lambda u: named(F.col("q"), F.least("t", u), F.greatest(F.col("t"), u), 0, u < F.col("t"))),
        met("above", lambda u: named(F.col("q"), F.col("t"), u, 1, F.lit(False))),
        met("below", lambda u: named(F.col("q") - 1, u, F.col("t"), 1, F.lit(True))))
    return here.select("g", "node", "c", F.explode(at).alias("at")).select(
        "node", "c", F.struct("g", "at.q", "at.t", "at.u", "at.up").alias("block"), "at.right").join(
        picked(parts, nodes), "node")


def links_within(block: pa.Table) -> pa.Table:
    """(x, y) of links that join the components of a block's nodes.

    Sizes and bitmaps rule pairs out, then longer bitmaps, then the sets decide. Nodes that
    a link has joined are one component from there on: no further pair of theirs is needed.
    """
    block = block.combine_chunks()
    node, n, c, right = (block.column(k).to_numpy() for k in ("node", "n", "c", "right"))
    c, right = c.copy(), right.astype(bool)
    lists = block.column("parts").chunk(0) if block.num_rows else None
    found: list[tuple[int, int]] = []
    if lists is not None:
        ends = np.concatenate([[0], np.cumsum(n)])
        flat = lists.flatten().flatten().to_numpy().view(np.uint64)
        short = np.stack([block.column(w).to_numpy().view(np.uint64) for w in WORD_NAMES], axis=1)
        wide = _bitmaps(flat, n)
        second = np.flatnonzero(right)
        name = block.column("block")[0].as_py()
        within = not name["up"] and name["t"] == name["u"]
        for i in np.flatnonzero(~right):
            js = np.arange(i + 1, len(node)) if within else second
            js = js[c[js] != c[i]]
            for words in (short, wide):
                js = js[_may_link(words[i], n[i], words[js], n[js])]
            for j in js:
                if c[i] == c[j]:
                    continue
                both = len(np.intersect1d(flat[ends[i]:ends[i + 1]], flat[ends[j]:ends[j + 1]], assume_unique=True))
                if both * 100 >= (n[i] + n[j] - both) * PERCENT:
                    found.append((min(int(node[i]), int(node[j])), max(int(node[i]), int(node[j]))))
                    c[c == c[j]] = c[i]
    return pa.table({"x": pa.array([x for x, _ in found], pa.int64()), "y": pa.array([y for _, y in found], pa.int64())})


def _bitmaps(flat: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A bitmap per set, of eight bits for a shingle of the largest set, at most 32,768."""
    bits = min(1 << 15, max(64, 1 << int(8 * n.max() - 1).bit_length()))
    at = (flat >> np.uint64(8)) & np.uint64(bits - 1)
    out = np.zeros((len(n), bits // 64), np.uint64)
    np.bitwise_or.at(out, (np.repeat(np.arange(len(n)), n), (at >> np.uint64(6)).astype(np.int64)),
                     np.uint64(1) << (at & np.uint64(63)))
    return out


def _may_link(a: np.ndarray, na: int, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """``may_link`` of one bitmap with many, in a task."""
    most = np.minimum(na - np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64),
                      nb - np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64))
    return most * (100 + PERCENT) >= (na + nb) * PERCENT


def left_links(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """(x, y): links that are left between nodes of open lists, enough of them to span components."""
    met = blocks(rows, parts).groupBy("block").applyInArrow(links_within, "x long, y long")
    return settle(met, "left-links")


def every_pair(lists: DataFrame, parts: DataFrame) -> DataFrame:
    """(x, y): all pairs of nodes of a long list that may link.

    A pair is not made in a list if both nodes have the same earlier list among their first ones;
    it is made in the first list that both have.
    """
    whole = F.struct("n", *WORD_NAMES).alias("a")
    rows = lists.filter(F.col("k") > SMALL_LIST).join(parts.select("node", whole), "node")
    earliest = rows.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("s")), 1, FIRST_LISTS).alias("e"))
    rows = rows.join(earliest, "node").select(
        "s", "node", "a", F.ceil(F.col("k") / TILE).alias("tiles"), F.filter("e", lambda x: x < F.col("s")).alias("e"))
    left = rows.withColumn("tile", F.pmod(F.xxhash64("node"), "tiles"))
    other = rows.select(F.col("s").alias("sb"), F.col("node").alias("nb"), F.col("a").alias("b"), F.col("e").alias("eb"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tb"))
    met = left.join(other, [F.col("s") == F.col("sb"), F.col("tile") == F.col("tb"), F.col("node") < F.col("nb"),
                            ~F.arrays_overlap("e", "eb"), may_link("a", "b")])
    return met.select(F.col("node").alias("x"), F.col("nb").alias("y")).distinct()


def picked(parts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of ``parts`` for the join with ``nodes``; where these are few, others are not shuffled."""
    nodes = nodes.select("node").distinct()
    return parts.join(F.broadcast(nodes), "node", "left_semi") if nodes.count() <= FEW_NODES else parts


def verified(parts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that link: partial overlaps, counted in each fragment and summed per pair."""
    parts = picked(parts, pairs.select(F.explode(F.array("x", "y")).alias("node")))
    left = parts.select(F.col("node").alias("x"), F.col("parts").alias("px"))
    right = parts.select(F.col("node").alias("y"), F.col("parts").alias("py"))
    partial = F.zip_with("px", "py", lambda a, b: F.size(F.array_intersect(a, b)))
    total = pairs.join(left, "x").join(right, "y").select(
        "x", "nx", "y", "ny", F.aggregate(partial, F.lit(0), lambda a, b: a + b).alias("both"))
    return settle(total.filter(
        F.col("both") * 100 >= (F.col("nx") + F.col("ny") - F.col("both")) * PERCENT
    ).select("x", "y"), "links")


def all_links(docs: DataFrame, members: DataFrame, every: bool) -> tuple[DataFrame, DataFrame]:
    """(x, y) links, all or such that span every component, and (node, component)."""
    repeated = repeated_shingles(docs, members)
    kept = kept_postings(postings(docs, repeated), repeated)
    parts = fragments(docs, settle(kept.select("node").distinct(), "list-nodes"))
    links = verified(parts, settle(able(first_pairs(kept), parts), "pairs"))
    found = components(links, "x", "y")
    pairs = settle(able(centre_pairs(open_lists(kept, found)), parts), "pairs")
    if not pairs.isEmpty():
        links = links.union(verified(parts, pairs))
        found = components(links, "x", "y")
    rows = open_lists(kept, found)
    if not rows.isEmpty():
        left = left_links(rows, parts)
        if not left.isEmpty():
            links = links.union(left)
            found = components(links, "x", "y")
    if every:
        links = links.union(verified(parts, settle(able(every_pair(kept, parts), parts), "pairs")))
    return links.distinct(), found


def jaccard_classes(docs: DataFrame, every: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row, and with ``every`` also ``n_links``.

    ``component_id`` is the smallest doc_id reachable by links, the row's own included.
    ``n_links`` is the number of different texts' sets that its set links with, copies left out.
    It needs every link by itself: its cost grows with the square of a group of near copies, while
    the classes need only links that span each group.
    """
    members = settle_texts(sets(docs), "members")
    links, found = all_links(docs, members, every)
    named = members.join(found, "node", "left").select(
        "doc_id", "n_shingles", "node", F.coalesce("component", "node").alias("class"))
    extra = ["n_links"] if every else []
    if every:
        n_links = links.select(F.explode(F.array("x", "y")).alias("node")).groupBy("node").agg(
            F.count(F.lit(1)).alias("n_links"))
        named = named.join(n_links, "node", "left").fillna(0, extra)
    empty = named.filter(F.col("node") == _EMPTY).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *extra)
    full = named.filter(F.col("node") != _EMPTY)
    least = full.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    return full.join(least, "class").select("doc_id", "n_shingles", "component_id", *extra).union(empty)


def one_per_class(docs: DataFrame) -> DataFrame:
    """Documents whose id is their class's smallest one; rows with one id stay or go together."""
    classes = jaccard_classes(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = classes.select(F.col("doc_id").alias("__jaccard_id")).distinct()
    return docs.join(stay, docs["doc_id"].cast("long").eqNullSafe(stay["__jaccard_id"]), "left_semi")
