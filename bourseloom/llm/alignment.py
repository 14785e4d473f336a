"""Alignment of two tokenizers by an as-of merge of their token starts, and counts of linked ids.

Both tokenizers read a blank and the text: A (byte-level pairs, a ``tokenizers`` file) gets it as
it is, B (pieces with byte fallback, a ``sentencepiece`` model) adds the blank itself. A token is
the byte range it covers. Per batch, ``pandas.merge_asof`` keyed by document finds, for each token
start of one side, the token of the other side that covers it; both directions together are all
overlaps. Where tokens of both sides end at one byte, a group ends.

1. Every text is encoded once. Rows are written with their groups' digest and their distinct linked
   id pairs with the number of links of each.
2. Documents per pair are counted over the written pairs, by partial sums in the tasks. A pair is
   best if its count is its A id's highest.
3. The counts come back to the documents. The most frequent pairs, ``MOST_FREQUENT`` at most, are
   broadcast and looked up in the task; all others are in few documents each and are joined, so no
   key of the join is hot. Both ways are exact.

No unit of text that both tokenizers see apart is encoded twice by a worker while it is in a bounded
table: a text is cut before a blank that follows a non-blank and stands before a visible character.
No token of either side spans such a place (B's vocabulary is checked for it).

Defined cases: a text has no tokens, and zeros in all counts, if it is null or empty or if the joined
bytes of either side's tokens differ from blank and text (a normaliser changed it). Repeated rows and
ids are documents of their own, null ids stay null, an empty table gives an empty table, and other
input columns are not read. The paths of both vocabularies are parameters.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourseloom.llm.arrays import span_hashes, text_slices
from bourseloom.llm.store import settle
from bourseloom.session import work_dir

#: Id pairs whose counts are broadcast, 13 bytes each; the others are joined.
MOST_FREQUENT = 1 << 20
#: Different units of text that a worker keeps encoded.
MOST_UNITS = 1 << 19
#: Different pairs that a task counts before it passes them on.
MOST_PENDING = 1 << 22

#: Bytes of ASCII white space, and first bytes of other Unicode white space in UTF-8.
_BEFORE_NO_CUT = np.zeros(256, bool)
_BEFORE_NO_CUT[:33] = True
_BEFORE_NO_CUT[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = True

COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
            "groups_sha256 string, pairs binary, times binary")
_encoders: dict[tuple, PairEncoder] = {}


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def encoder(path_a: str, path_b: str, most_units: int = MOST_UNITS) -> PairEncoder:
    """The worker's encoder of both sides, kept between batches and tasks."""
    key = path_a, path_b, most_units
    if key not in _encoders:
        _encoders[key] = PairEncoder(*key)
    return _encoders[key]


def _byte_level_sizes(tokens: list[str]) -> np.ndarray:
    """Bytes of byte-level tokens: every character stands for one."""
    return np.array([len(t) for t in tokens], np.int64)


class _Lists:
    """Id lists by number, appended to flat arrays."""

    def __init__(self) -> None:
        self.flat, self.at = np.zeros(1 << 14, np.int32), np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int64)
        self.used = self.count = 0

    def add(self, lists: list[list[int]]) -> None:
        sizes = np.array([len(x) for x in lists], np.int64)
        n, total = len(lists), int(sizes.sum())
        while self.count + n > len(self.at):
            self.at, self.size = np.resize(self.at, 2 * len(self.at)), np.resize(self.size, 2 * len(self.size))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.at[self.count:self.count + n] = self.used + np.cumsum(sizes) - sizes
        self.size[self.count:self.count + n] = sizes
        self.flat[self.used:self.used + total] = np.fromiter((i for x in lists for i in x), np.int32, total)
        self.used += total
        self.count += n

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists end to end, and their sizes."""
        sizes = self.size[which]
        ends = np.cumsum(sizes)
        pos = np.repeat(self.at[which] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[pos], sizes


class PairEncoder:
    """Token ids of both sides, by units that a bounded table remembers."""

    def __init__(self, path_a: str, path_b: str, most_units: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        vocab = self.a.get_vocab(with_added_tokens=True)
        names = [""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            names[i] = token
        self.bytes_a = _byte_level_sizes(names)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.by_unit = not any("▁" in p.lstrip("▁") for p in pieces)
        self.piece = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(pieces)]
        self.bytes_b = np.array([len(p) for p in self.piece], np.int64)
        self._alphabet = _byte_alphabet()
        self.names = names
        self.size_a, self.size_b = len(names), len(pieces)
        self.most = most_units
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.lists_a, self.lists_b = _Lists(), _Lists()
        self.good = np.zeros(1 << 12, bool)

    def _add(self, hashes: list[int], units: list[str]) -> None:
        a = [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        b = self.b.encode(units, num_threads=1)
        base = self.lists_a.count
        while base + len(units) > len(self.good):
            self.good = np.resize(self.good, 2 * len(self.good))
        back, piece, names = self._alphabet, self.piece, self.names
        for k, (unit, ia, ib) in enumerate(zip(units, a, b, strict=True)):
            want = b" " + unit.encode()
            self.good[base + k] = (b"".join([piece[i] for i in ib]) == want
                                   and "".join([names[i] for i in ia]).translate(back) == want.decode("latin-1"))
            self.known[hashes[k]] = base + k
        self.lists_a.add(a)
        self.lists_b.add(b)

    def _units(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the units, without the blank before, and units per row."""
        rows = np.flatnonzero(np.diff(offs))
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs) - 1, np.int64)
        cut = np.zeros(len(data), bool)
        if self.by_unit and len(data) > 2:
            cut[1:-1] = (data[1:-1] == 32) & (data[:-2] != 32) & ~_BEFORE_NO_CUT[data[2:]]
            inner = offs[1:-1]
            cut[inner[inner < len(data)]] = False  # a text's first byte
            last = offs[1:] - 1
            cut[last[last >= 0]] = False
        blanks = np.flatnonzero(cut)
        starts = np.sort(np.concatenate([offs[rows], blanks + 1]))
        ends = np.sort(np.concatenate([offs[rows + 1], blanks]))
        return starts, ends, np.diff(np.searchsorted(starts, offs))

    def slices(self, column: pa.Array):
        """Runs of rows as (first row, end row, A ids, A per row, B ids, B per row).

        A row that has no tokens by the rules above has none on either side.
        """
        for lo, hi, data, offs in text_slices(column):
            starts, ends, counts = self._units(data, offs)
            h, place, of = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
            keys = h.tolist()
            new = [k for k, x in enumerate(keys) if x not in self.known]
            if new and len(self.known) + len(new) > self.most:
                self._clear()
                new = range(len(keys))
            if new:
                raw = data.tobytes()
                at = place[list(new)]
                self._add([keys[k] for k in new],
                          [raw[s:e].decode() for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            unit = np.fromiter((self.known[x] for x in keys), np.int64, len(keys))[of]
            row = np.repeat(np.arange(hi - lo), counts)
            bad = np.zeros(hi - lo, bool)
            bad[row[~self.good[unit]]] = True
            unit, row = unit[~bad[row]], row[~bad[row]]
            out = []
            for lists in (self.lists_a, self.lists_b):
                ids, sizes = lists.take(unit)
                out += [ids, np.bincount(row, weights=sizes, minlength=hi - lo).astype(np.int64)]
            yield lo, hi, *out


def _byte_alphabet() -> dict[int, int]:
    """Characters of byte-level tokens to their bytes: printable bytes stand for themselves, the
    others, in order, for 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {256 + k: b for k, b in enumerate(others)}


def overlaps(
    doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of all overlapping tokens.

    Starts are places in the batch's bytes, so they rise with the document; ranges are gapless.
    """
    a = pd.DataFrame({"start": start_a, "doc": doc_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"start": start_b, "doc": doc_b, "b": np.arange(len(start_b))})
    over_a = pd.merge_asof(a, b, on="start", by="doc")["b"].to_numpy(np.int64)
    over_b = pd.merge_asof(b, a, on="start", by="doc")["a"].to_numpy(np.int64)
    only = start_a[over_b] != start_b  # equal starts are found in both directions
    return (np.concatenate([a["a"].to_numpy(), over_b[only]]),
            np.concatenate([over_a, b["b"].to_numpy()[only]]))


def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal texts of 0 to ``most`` - 1, each in a row with room for a sign behind, and lengths."""
    text = np.array([str(i) for i in range(most)], dtype=f"S{len(str(most)) + 1}")
    return text.view(np.uint8).reshape(most, -1), np.char.str_len(text).astype(np.int64)


def group_texts(
    n_docs: int, doc_a: np.ndarray, ids_a: np.ndarray, group_a: np.ndarray, doc_b: np.ndarray,
    ids_b: np.ndarray, group_b: np.ndarray, digits: tuple[np.ndarray, np.ndarray],
) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of all documents end to end, and their offsets."""
    table, lengths = digits
    n = len(ids_a) + len(ids_b)
    place_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, "left")
    place_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
    ids, sign = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[place_a], ids[place_b] = ids_a, ids_b
    sign[place_a[np.append(group_a[1:] != group_a[:-1], True)]] = ord("|")
    sign[place_b[np.append(group_b[1:] != group_b[:-1], True)]] = ord(";")
    size = lengths[ids]
    cells = table[ids]
    cells[np.arange(n), size] = sign
    wide = size + 1
    text = cells[np.arange(table.shape[1])[None, :] < wide[:, None]].tobytes()
    per_doc = (np.bincount(doc_a, lengths[ids_a] + 1, n_docs) + np.bincount(doc_b, lengths[ids_b] + 1, n_docs))
    return text, np.concatenate([[0], np.cumsum(per_doc.astype(np.int64))])


def align_slice(both: PairEncoder, part: tuple, digits: tuple) -> dict[str, list | np.ndarray]:
    """The aligned columns of one run of rows."""
    lo, hi, ids_a, per_a, ids_b, per_b = part
    n = hi - lo
    doc_a, doc_b = np.repeat(np.arange(n), per_a), np.repeat(np.arange(n), per_b)
    out: dict = {"n_a": per_a, "n_b": per_b, "n_groups": np.zeros(n, np.int64), "n_links": np.zeros(n, np.int64),
                 "groups_sha256": [""] * n, "pairs": [b""] * n, "times": [b""] * n}
    if not len(ids_a):
        return out
    end_a, end_b = np.cumsum(both.bytes_a[ids_a]), np.cumsum(both.bytes_b[ids_b])
    link_a, link_b = overlaps(doc_a, end_a - both.bytes_a[ids_a], doc_b, end_b - both.bytes_b[ids_b])
    met = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b = np.searchsorted(met, end_a), np.searchsorted(met, end_b)
    out["n_groups"] = np.bincount(doc_a[np.append(group_a[1:] != group_a[:-1], True)], minlength=n)
    out["n_links"] = np.bincount(doc_a[link_a], minlength=n)
    text, at = group_texts(n, doc_a, ids_a, group_a, doc_b, ids_b, group_b, digits)
    span = np.uint64(both.size_a * both.size_b)
    code = ids_a[link_a].astype(np.uint64) * np.uint64(both.size_b) + ids_b[link_b].astype(np.uint64)
    keys, times = np.unique(doc_a[link_a].astype(np.uint64) * span + code, return_counts=True)
    cuts = np.searchsorted(keys, np.arange(n + 1, dtype=np.uint64) * span)
    codes = (keys % span).astype("<u4" if span <= 1 << 32 else "<u8")
    step = np.diff(codes, prepend=codes.dtype.type(0))
    step[cuts[:-1][cuts[:-1] < len(step)]] = codes[cuts[:-1][cuts[:-1] < len(codes)]]
    times = times.astype("<u4")
    for i in np.flatnonzero(per_a):
        own = slice(cuts[i], cuts[i + 1])
        out["groups_sha256"][i] = hashlib.sha256(text[at[i]:at[i + 1] - 1]).hexdigest()
        out["pairs"][i], out["times"][i] = step[own].tobytes(), times[own].tobytes()
    return out


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Every row's counts and digest, its distinct id pairs (steps of codes) and links of each, written."""

    def run(batches):
        both = encoder(path_a, path_b)
        digits = _digits(max(both.size_a, both.size_b))
        for batch in batches:
            for part in both.slices(batch.column(2)):
                cols = align_slice(both, part, digits)
                lo, hi = part[:2]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(1)[lo:hi],
                     *(pa.array(np.asarray(cols[c], np.int64)) for c in COUNTS),
                     pa.array(cols["groups_sha256"], pa.string()),
                     pa.array(cols["pairs"], pa.binary()), pa.array(cols["times"], pa.binary())],
                    names=["row", "doc_id", *COUNTS, "groups_sha256", "pairs", "times"])

    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    path = work_dir(spark, "aligned")
    rows.mapInArrow(run, _ALIGNED).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(_ALIGNED).parquet(path)


def _codes(pairs: pa.Array, wide: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Pair codes of a column of rows end to end, and how many each row has."""
    lists = [np.cumsum(np.frombuffer(x or b"", wide), dtype=np.int64) for x in pairs.to_pylist()]
    return (np.concatenate(lists) if lists else np.zeros(0, np.int64)), np.array([len(x) for x in lists], np.int64)


def pair_counts(rows: DataFrame, wide: str, size_b: int) -> DataFrame:
    """(pair, docs, best): in how many documents a pair is linked, and whether that is its A id's most."""

    def run(batches):
        held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            codes, _ = _codes(batch.column(0), np.dtype(wide))
            for lo in range(0, len(codes), MOST_PENDING):
                own, n = np.unique(codes[lo:lo + MOST_PENDING], return_counts=True)
                held, of = np.unique(np.concatenate([held, own]), return_inverse=True)
                counts = np.bincount(of, np.concatenate([counts, n])).astype(np.int64)
                if len(held) > MOST_PENDING:
                    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], names=["pair", "n"])
                    held, counts = held[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts)], names=["pair", "n"])

    found = settle(rows.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("docs")).withColumn("a", F.expr(f"pair div {size_b}")), "pair-counts")
    most = found.groupBy("a").agg(F.max("docs").alias("most"))
    return found.join(F.broadcast(most), "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def frequent_from(counts: DataFrame, most: int) -> int:
    """The least count whose pairs, with all more frequent ones, are at most ``most``."""
    sizes = counts.groupBy(F.length(F.bin("docs")).alias("bits")).count().orderBy(F.desc("bits")).collect()
    total, least = 0, 1 << 62
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        least = 1 << (row["bits"] - 1)
    return least


def align(
    docs: DataFrame, path_a: str | None = None, path_b: str | None = None, most_frequent: int = MOST_FREQUENT
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``.

    ``n_best`` are the links whose pair is in as many documents as any pair of its A id, ties
    included; ``count_sum`` is the sum of the pairs' document counts over all links.
    """
    default = default_paths()
    path_a, path_b = path_a or default[0], path_b or default[1]
    both = encoder(path_a, path_b)
    wide, size_b = ("<u4" if both.size_a * both.size_b <= 1 << 32 else "<u8"), both.size_b
    rows = aligned(docs, path_a, path_b)
    counts = settle(pair_counts(rows, wide, size_b), "counts")
    least = frequent_from(counts, most_frequent)
    table = counts.filter(F.col("docs") >= least).orderBy("pair").toArrow()
    frequent = docs.sparkSession.sparkContext.broadcast(tuple(
        table[c].to_numpy() for c in ("pair", "docs", "best")))
    del table

    def look_up(batches):
        pair, docs_of, best = frequent.value
        for batch in batches:
            codes, per_row = _codes(batch.column(1), np.dtype(wide))
            times = np.concatenate([np.zeros(0, np.int64), *(
                np.frombuffer(x or b"", "<u4").astype(np.int64) for x in batch.column(2).to_pylist())])
            row = np.repeat(np.arange(len(batch)), per_row)
            at = np.minimum(np.searchsorted(pair, codes), max(len(pair) - 1, 0))
            hit = pair[at] == codes if len(pair) else np.zeros(len(codes), bool)
            at = at[hit]
            total, n_best = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(total, row[hit], times[hit] * docs_of[at])
            np.add.at(n_best, row[hit], times[hit] * best[at])
            sizes = np.bincount(row[~hit], minlength=len(batch))
            offs = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_best), pa.array(total),
                 pa.ListArray.from_arrays(offs, pa.array(codes[~hit])),
                 pa.ListArray.from_arrays(offs, pa.array(times[~hit]))],
                names=["row", "n_best", "count_sum", "rare", "times"])

    looked = settle(rows.select("row", "pairs", "times").mapInArrow(
        look_up, "row long, n_best long, count_sum long, rare array<long>, times array<long>"), "looked-up")
    frequent.destroy()
    rare = looked.filter(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("x"))
    rare = rare.select("row", F.col("x.rare").alias("pair"), F.col("x.times").alias("times")).join(
        counts.filter(F.col("docs") < least), "pair")
    parts = looked.select("row", "n_best", "count_sum").union(rare.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)), F.sum(F.col("times") * F.col("docs"))))
    total = parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.drop("pairs", "times").join(total, "row").select(
        "doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")
