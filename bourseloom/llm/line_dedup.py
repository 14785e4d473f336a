"""Line dedup: two Bloom filters pick suspected repeats, only those shuffle and are confirmed.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at
least ``min_chars`` code points found in at least ``min_docs`` documents lose all their lines
except in the document with the largest id.

Pass 1 fills a once-seen and a twice-seen filter (``bloom``). Pass 2 sends on the keys that the
second filter holds, as 128-bit digests; they are counted exactly and one document is chosen per
key. Pass 3 drops the other lines. A hot key arrives as at most one row per document, and the
count and the choice are partial aggregates.

Defined cases: a null or empty text is one empty line; rows with one id are one document, all of
them keep or lose a key's lines together; a null id counts as the smallest; an empty table gives
an empty table; a result column replaces an input column of its name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourseloom.llm.arrays import LOWER_TABLE, SPACE_BYTES
from bourseloom.llm.bloom import contains, filter_bits, seen_twice
from bourseloom.llm.store import settle, settle_texts

_ID, _DROP = "__line_doc", "__line_drop"
_NULL_ID = -(1 << 63)


def _keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """A digest for each line; none for a key that is too short to count."""
    out: list[bytes | None] = []
    for line in (text or "").encode().split(b"\n"):
        key = line.strip(SPACE_BYTES)
        if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
            out.append(None)
        else:
            out.append(xxhash.xxh3_128_digest(key.translate(LOWER_TABLE)))
    return out


def _row_digests(texts: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct key digests of each row, as pairs of 64-bit values, and how many each row has."""
    found, counts = [], []
    for text in texts.to_pylist():
        own = set(_keys(text, min_chars)) - {None}
        found.extend(own)
        counts.append(len(own))
    return np.frombuffer(b"".join(found), np.int64).reshape(-1, 2), np.array(counts, np.int64)


def repeated_keys(docs: DataFrame, min_chars: int, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """Suspected (key, document) rows, and the confirmed keys with the document to keep."""
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias(_ID), "text")
    lines = texts.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0]
    bits = filter_bits(lines or 1)
    bitmap = docs.sparkSession.sparkContext.broadcast(seen_twice(
        texts.select("text"), lambda b: _row_digests(b.column(0), min_chars)[0][:, 0], bits,
        least=min(2, min_docs)))

    def suspects(batches):
        for batch in batches:
            digests, counts = _row_digests(batch.column(1), min_chars)
            ids = np.repeat(batch.column(0).to_numpy(), counts)
            held = contains(bitmap.value, digests[:, 0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests[held, 0]), pa.array(digests[held, 1]), pa.array(ids[held])],
                names=["k1", "k2", _ID])

    held = settle_texts(texts.mapInArrow(suspects, f"k1 long, k2 long, {_ID} long"), "suspect-lines")
    sure = (held.groupBy("k1", "k2")
            .agg(F.count_distinct(_ID).alias("docs"), F.max(_ID).alias("keep"))
            .filter(F.col("docs") >= min_docs).select("k1", "k2", "keep"))
    return held, sure


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Documents with their repeated lines dropped, plus n_lines (before) and n_dropped."""
    held, sure = repeated_keys(docs, min_chars, min_docs)
    drops = (held.join(sure, ["k1", "k2"]).filter(F.col(_ID) != F.col("keep")).distinct()
             .groupBy(_ID).agg(F.collect_list(F.struct("k1", "k2")).alias(_DROP)))
    drops = settle(drops, "line-drops")
    own = [f for f in docs.schema.fields if f.name not in ("n_lines", "n_dropped")]
    keyed = docs.select([f.name for f in own]).withColumn(
        _ID, F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)))
    joined = keyed.join(drops.hint("shuffle_hash"), _ID, "left").drop(_ID)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in own]
                          + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = [f.name for f in own]

    def cut(batches):
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            lists = batch.column(_DROP).to_pylist()
            for text, drop in zip(batch.column("text").to_pylist(), lists, strict=True):
                lines = (text or "").split("\n")
                kept = lines
                if drop:
                    gone = {np.array([d["k1"], d["k2"]], np.int64).tobytes() for d in drop}
                    kept = [x for x, k in zip(lines, _keys(text, min_chars), strict=True)
                            if k not in gone]
                texts.append("\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            columns = [pa.array(texts, batch.schema.field("text").type) if n == "text"
                       else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=[*names, "n_lines", "n_dropped"])

    return joined.mapInArrow(cut, schema)
