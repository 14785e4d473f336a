"""Operators over documents against brute force, on the smallest tables and on odd rows."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bourseloom.llm import (
    arrays, chunks, jaccard_join, lengths, line_dedup, mixing, packing, syncmers, tokens,
)

WS = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.default_path())


def encode(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


# --- token ids ---------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=80), st.text(
    alphabet="aZé×'́<| .,5\n İẖ", max_size=60)), max_size=8))
def test_ids_are_the_tokenizers(texts):
    own = Tokenizer.from_file(tokens.default_path())
    got = {}
    for lo, hi, ids, at in tokens.encoder(tokens.default_path()).slices(pa.array(texts, pa.string())):
        for i in range(lo, hi):
            got[i] = ids[at[i - lo]:at[i - lo + 1]].tolist()
    assert [got[i] for i in range(len(texts))] == [encode(own, t) for t in texts]


def test_a_full_word_table_starts_over(tokenizer):
    small = tokens.WordEncoder(tokens.default_path(), 50)
    texts = [" ".join(f"word{i * 30 + k}" for k in range(30)) for i in range(20)]
    for text in texts:
        (_, _, ids, _), = small.slices(pa.array([text]))
        assert ids.tolist() == encode(tokenizer, text)
    assert small.count <= 100


# --- packing -----------------------------------------------------------------------------------


def check_packing(rows, docs, tokenizer, window):
    """Every id of every row in one piece, sequences gapless and without padding."""
    want = Counter()
    for r in docs:
        want[r["doc_id"], tuple(encode(tokenizer, r["text"]) + [2])] += 1
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    total = Counter()
    for (doc_id, ids), n in want.items():
        total[doc_id] += n * len(ids)
        texts = {i for d, i in want if d == doc_id}
        for r in pieces[doc_id]:
            assert any(zlib.crc32(np.array(t[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
                       == r["ids_crc32"] and len(t) == r["doc_tokens"] for t in texts)
    assert {d: sum(r["length"] for r in p) for d, p in pieces.items()} == dict(total)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["sequence_tokens"]))
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == parts[0][2] <= window and (at == window or at & (at - 1) == 0)


@pytest.mark.parametrize("window,shard", [(4096, 1 << 19), (64, 700)])
def test_packing_keeps_every_id(spark, odd_docs, tokenizer, window, shard):
    rows = packing.pack(odd_docs, window=window, shard_tokens=shard, part_tokens=100_000).collect()
    check_packing(rows, odd_docs.collect(), tokenizer, window)


def test_packing_of_the_table(sf_docs, tokenizer):
    check_packing(packing.pack(sf_docs).collect(), sf_docs.collect(), tokenizer, 4096)


def test_neighbours_fill_a_window():
    """The seed's nearest document by BM25 comes next, whatever the order of rows."""
    docs = [np.array([1, 2, 3, 4] * 5), np.array([9, 8, 7] * 6), np.array([1, 2, 3, 5] * 5)]
    idf = np.ones(10, np.float32)
    assert packing.chain(docs, idf, 19.0, 1000, 1000) == [0, 2, 1]


def test_texts_without_terms_are_appended_without_a_search():
    idf = np.array([0, 0, 0, 1, 1, 1], np.float32)
    empty, docs = np.array([2]), [np.array([3, 4, 2]), np.array([5, 2]), np.array([4, 5, 2])]
    assert packing.chain([empty] * 200_000 + docs, idf, 2.0, 1 << 20, 1 << 20) == [
        *range(200_000), 200_000, 200_002, 200_001]


def test_short_and_long_lists_give_the_same_neighbours():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 3000, 4) for _ in range(400)]
    index = packing.Shard(docs, np.ones(3000, np.float32), 4.0)
    unused = rng.random(400) < 0.7
    for seed in range(400):
        own, scores = set(docs[seed]), np.zeros(400)
        for row in range(400):
            for t in sorted(own & set(docs[row])):
                at = index.at[t] + np.flatnonzero(index.rows[index.at[t]:index.at[t + 1]] == row)
                scores[row] += index.weights[at].sum()
        want = [r for r in sorted(range(400), key=lambda r: (-scores[r], r)) if scores[r] > 0 and unused[r]]
        got = index.neighbours(seed, unused).tolist()
        assert got == want or (got == [] and want == [seed])


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs).count() == 0


# --- length histogram ----------------------------------------------------------------------------


def test_limits_match_brute_force(odd_docs, sf_docs, tokenizer):
    for docs in (odd_docs, sf_docs):
        sizes = np.array([len(encode(tokenizer, r["text"])) for r in docs.collect()])
        histogram = lengths.length_histogram(docs)
        table = lengths.limit_table(histogram)
        rows = table.collect()
        assert {r["length"]: r["docs"] for r in rows} == dict(Counter(sizes.tolist()))
        for r in rows:
            over = sizes > r["length"]
            assert (r["docs_over"], r["tokens_over"]) == (over.sum(), sizes[over].sum())
            assert r["tokens_kept"] == np.minimum(sizes, r["length"]).sum()
        limits = [0, 7, 100, 10**6]
        assert {r["context_limit"]: r["tokens_kept"] for r in lengths.at_limits(histogram, limits).collect()} == {
            x: np.minimum(sizes, x).sum() for x in limits}
        assert lengths.quantile(table, 0.9) == np.sort(sizes)[int(np.ceil(0.9 * len(sizes))) - 1]


def test_no_lengths(no_docs):
    assert lengths.limit_table(lengths.length_histogram(no_docs)).count() == 0


# --- Jaccard join --------------------------------------------------------------------------------


def brute_classes(rows):
    sets = []
    for r in rows:
        w = WS.findall((r["text"] or "").translate(LOWER))
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    names = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            names[root(i)] = min(names.get(root(i), r["doc_id"]), r["doc_id"])
    return Counter((r["doc_id"], len(sets[i]), names.get(root(i))) for i, r in enumerate(rows))


def near_copies(spark, n, seed=1):
    """A chain of edited copies, one passage in all of them, and a group of equal texts."""
    rng = np.random.default_rng(seed)
    text, rows = [f"w{i}" for i in range(120)], []
    passage = [f"p{i}" for i in range(30)]
    for i in range(n):
        text = list(text)
        text[int(rng.integers(0, 120))] = f"e{i}"
        rows.append((int(rng.integers(0, 10**9)), " ".join(text)))
        rows.append((int(rng.integers(0, 10**9)), " ".join([f"u{i}x{k}" for k in range(40)] + passage)))
        rows.append((int(rng.integers(0, 10**9)), " ".join([f"s{i}x{k}" for k in range(int(rng.integers(1, 9)))] + passage)))
        rows.append((i, "the same words in each of these rows once more"))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("kind", ["odd", "sf", "near"])
def test_classes_match_brute_force(spark, odd_docs, sf_docs, kind):
    docs = {"odd": odd_docs, "sf": sf_docs}.get(kind) or near_copies(spark, 60)
    got = jaccard_join.jaccard_classes(docs)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute_classes(docs.collect())


def test_all_links_of_a_large_group_are_counted(spark, monkeypatch):
    """Different near copies, in lists of many nodes and over several tiles, against brute force."""
    monkeypatch.setattr(jaccard_join, "TILE", 7)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(40):
        text = [f"w{k}" for k in range(150)]
        for at in rng.integers(0, 150, int(rng.integers(1, 4))):
            text[int(at)] = f"e{i}"
        rows += [(i, " ".join(text)), (100 + i, " ".join(text))][:1 + (i % 5 == 0)]
    sets = {i: frozenset(zip(*(t.split()[k:] for k in range(5)), strict=False)) for i, t in rows}
    different = set(sets.values())
    want = {i: sum(s != o and 100 * len(s & o) >= 75 * len(s | o) for o in different) for i, s in sets.items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["n_links"] for r in jaccard_join.jaccard_classes(docs, every=True).collect()} == want
    assert max(want.values()) > 30


def test_one_row_of_a_class_stays(odd_docs):
    kept = jaccard_join.one_per_class(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 6, 7, 8, 10, 11, 13, 14, 15]


def test_no_classes(no_docs):
    assert jaccard_join.jaccard_classes(no_docs).count() == 0


def test_shingles_equal_those_of_words():
    texts = ["A b\tc d e f", "a B c D e f", "x", "", None, "a b c d e g"]
    sets = dict(arrays.row_sets(pa.array(texts)))
    assert [len(sets[i]) for i in range(6)] == [2, 2, 1, 0, 0, 2]
    assert (sets[0] == sets[1]).all() and len(set(sets[0]) & set(sets[5])) == 1


# --- line dedup ------------------------------------------------------------------------------------


def brute_lines(rows):
    where = defaultdict(set)
    keys = lambda t: [x.strip("\x20\t\n\x0b\x0c\r").translate(LOWER) for x in (t or "").split("\n")]
    least = lambda i: -1 if i is None else i
    for r in rows:
        for k in keys(r["text"]):
            if len(k) >= 20:
                where[k].add(least(r["doc_id"]))
    out = Counter()
    for r in rows:
        lines = (r["text"] or "").split("\n")
        kept = [x for x, k in zip(lines, keys(r["text"]), strict=True)
                if len(where[k]) < 3 or max(where[k]) == least(r["doc_id"])]
        out[r["doc_id"], "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    return out


def test_lines_match_brute_force(odd_docs, sf_docs):
    for docs in (odd_docs, sf_docs):
        got = line_dedup.drop_repeated_lines(docs)
        assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
        assert Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()) == brute_lines(docs.collect())


def test_lines_with_clashing_columns_and_no_rows(odd_docs, no_docs):
    named = odd_docs.withColumn("n_lines", F.lit("x")).withColumn("k1", F.lit(1)).withColumn("keep", F.lit(2))
    got = line_dedup.drop_repeated_lines(named)
    assert dict(got.dtypes)["n_lines"] == "bigint" and got.count() == odd_docs.count()
    assert line_dedup.drop_repeated_lines(no_docs).count() == 0


# --- mixing ----------------------------------------------------------------------------------------


def test_raked_margins_meet_targets(spark):
    rows = [(i, "a b c " * (1 + i % 7), "en" if i % 3 else "de", f"s{i % 5 if i % 2 else 0}", 1) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    described = mixing.described(docs)
    chances = mixing.probabilities(described, rounds=30, keep_share=0.5)
    cells = described.groupBy(*mixing.DIMS).agg(F.sum("__mix_tokens").alias("tokens")).join(chances, list(mixing.DIMS))
    targets = {r[0]: r[1] for r in mixing.tempered_targets(cells, mixing.DIMS[0], mixing.TEMPER, 0.5).collect()}
    got = {r[0]: r[1] for r in cells.groupBy(mixing.DIMS[0]).agg(F.sum(F.col("tokens") * F.col("__mix_probability"))).collect()}
    assert got == pytest.approx(targets, rel=0.02)
    kept = mixing.mix(docs, rounds=30, keep_share=0.5).agg(F.sum("__mix_tokens")).first()[0]
    assert kept == pytest.approx(sum(targets.values()), rel=0.1)


def raked(spark, tokens, dims, **targets):
    """Cells of two dimensions raked to literal targets: misfits by value and the weights."""
    cells = spark.createDataFrame([(*k, n) for k, n in tokens.items()], f"{dims[0]} string, {dims[1]} string, tokens long")
    wanted = {d: spark.createDataFrame(list(targets[d].items()), f"{d} string, {d}_target double") for d in dims}
    out = mixing.raked_cells(cells, wanted)
    errors = {(r["dim"], r["value"]): r["have"] / r["target"] - 1 for r in mixing.margin_errors(out, dims).collect()}
    return errors, {(r[dims[0]], r[dims[1]]): r["weight"] for r in out.collect()}


def test_default_rounds_reach_what_can_be_reached(spark):
    rng = np.random.default_rng(9)
    tokens = {(f"a{i}", f"b{j}"): int(rng.integers(100, 900)) for i in range(6) for j in range(5)}
    share = {k: rng.uniform(0.2, 0.9) for k in tokens}  # some weights within the cells give both margins
    margin = [Counter(), Counter()]
    for (a, b), n in tokens.items():
        margin[0][a] += n * share[a, b]
        margin[1][b] += n * share[a, b]
    errors, weights = raked(spark, tokens, ("a", "b"), a=dict(margin[0]), b=dict(margin[1]))
    assert max(map(abs, errors.values())) < 0.01
    assert all(0 <= weights[k] <= tokens[k] for k in tokens)


def test_a_margin_out_of_reach_gives_all_it_has(spark):
    tokens = {("a", "x"): 100, ("a", "y"): 50, ("b", "x"): 1000, ("b", "y"): 1000}
    errors, weights = raked(spark, tokens, ("s", "l"), s={"a": 600.0, "b": 400.0}, l={"x": 500.0, "y": 500.0})
    assert weights["a", "x"] == pytest.approx(100, rel=0.05) and weights["a", "y"] == pytest.approx(50, rel=0.05)
    assert errors["s", "a"] < -0.7


def test_mixing_of_odd_rows(odd_docs, no_docs):
    kept = mixing.mixed_documents(odd_docs, keep_share=1.0, temper=1.0)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    named = odd_docs.withColumn("tokens", F.lit(1)).withColumn("weight", F.lit(2)).withColumn("topic", F.lit(3))
    assert mixing.mixed_documents(named).columns == named.columns
    assert mixing.mix(no_docs).count() == 0


# --- fingerprints ------------------------------------------------------------------------------------


def brute_anchors(text):
    points = [ord(c) for c in text]
    grams = [tuple(points[i:i + syncmers.S]) for i in range(len(points) - syncmers.S + 1)]
    number = {}
    for g in set(grams):
        value = [(np.uint64(x) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) for x in map(np.uint64, g)]
        h = np.uint64(0)
        for k, v in enumerate(value):
            h += v * np.uint64(pow(arrays._BASE, k, 1 << 64))
        number[g] = int(arrays.mix(np.array([h]))[0])
    width = syncmers.K - syncmers.S + 1
    own = [number[g] for g in grams]
    return [i for i in range(len(points) - syncmers.K + 1)
            if min(own[i:i + width]) in (own[i], own[i + width - 1])]


def test_anchors_match_brute_force():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abc é\U0001f600"), size=n)) for n in (0, 5, 31, 32, 33, 200, 900)]
    with np.errstate(over="ignore"):
        for text, (at, _) in zip(texts, syncmers.anchors(texts), strict=True):
            assert at.tolist() == (brute_anchors(text) or ([0] if text else []))


def test_edited_neighbours(odd_docs, sf_docs, monkeypatch):
    import hashlib

    for docs, size in ((sf_docs, 8_000_000), (sf_docs, 20_000), (odd_docs, 100)):
        monkeypatch.setattr(syncmers, "RANGE_CHARS", size)
        rows = sorted(((-(1 << 63) if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in docs.collect()),
                      key=lambda r: (-r[0], r[1]))
        want = Counter()
        for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
            half = len(text) // 2
            edited = text[:len(text) - half] + following[:half]
            want[i, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
        got = syncmers.edited_neighbours(docs).collect()
        assert Counter((-(1 << 63) if r["doc_id"] is None else r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
        assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
        prints = defaultdict(set)
        for r in syncmers.fingerprints(docs).join(docs, "doc_id").select("text", "fingerprint").collect():
            prints[r["text"]].add(r["fingerprint"])
    long = [r for r in got if r["n_chars"] > 1000 and r["doc_id"] == 14]
    assert 0.4 < long[0]["near_edited"] < 0.7


def test_likeness_follows_shared_text():
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefgh"), size=6))
    a = " ".join(word() for _ in range(400))
    half = a[:len(a) // 2] + " ".join(word() for _ in range(200))
    fp = [syncmers.decode(syncmers.encode(x)) for x in syncmers.text_anchors([a, "intro " + a, half, half[::-1]])]
    assert syncmers.likeness(fp[0], fp[0]) == 1 and syncmers.likeness(fp[0], fp[1]) > 0.97
    assert 0.4 < syncmers.likeness(fp[0], fp[2]) < 0.6 and syncmers.likeness(fp[0], fp[3]) < 0.05


def test_no_neighbours(no_docs):
    assert syncmers.edited_neighbours(no_docs).count() == 0


# --- substring dedup -----------------------------------------------------------------------------------


def test_planted_passages_are_found(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefghij"), size=int(rng.integers(2, 9))))
    passage = " ".join(word() for _ in range(70))
    rows = [(i, " ".join(word() for _ in range(200)) + (" " + passage if i % 3 == 0 else "")
             + " " + " ".join(word() for _ in range(int(rng.integers(5, 90))))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spans = chunks.repeated_spans(docs).collect()
    assert {r["doc_id"] for r in spans} == {i for i in range(3, 30, 3)}
    texts = dict(rows)
    for r in spans:
        own = texts[r["doc_id"]].encode()[r["start"]:r["start"] + r["length"]]
        assert r["first_doc_id"] == 0 and own in texts[0].encode()
        assert passage.encode() in own or own in passage.encode()
    cut = {r["doc_id"]: r["text"] for r in chunks.without_repeats(docs).collect()}
    assert cut[0] == texts[0] and len(cut[3]) < len(texts[3]) - 200 and cut[4] == texts[4]


def test_chunks_cover_texts_and_survive_insertions():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 107, 5000).astype(np.uint8)
    longer = np.concatenate([rng.integers(97, 107, 37).astype(np.uint8), data])
    made = []
    for x in (data, longer):
        starts, ends = chunks.cuts(x, np.array([0, len(x)]))
        assert starts[0] == 0 and ends[-1] == len(x) and (starts[1:] == ends[:-1]).all()
        made.append({x[a:b].tobytes() for a, b in zip(starts, ends, strict=True)})
    assert len(made[0] - made[1]) <= 4


def test_repeats_of_odd_rows(odd_docs, no_docs):
    rows = chunks.repeated_spans(odd_docs, 60).collect()
    assert {r["doc_id"] for r in rows} == {1, 2, 3} and {r["first_doc_id"] for r in rows} <= {None, 1}
    assert chunks.without_repeats(odd_docs).count() == odd_docs.count()
    assert chunks.repeated_spans(no_docs).count() == 0


def test_spans_lie_in_the_document_named(spark):
    """Parts of a passage that stand alone in smaller ids don't take its holder's place."""
    rng = np.random.default_rng(8)
    words = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), size=int(rng.integers(3, 9)))) for _ in range(n))
    passage = words(60)
    part = " ".join(passage.split()[20:35])
    rows = [(1, f"{words(30)} {part} {words(30)}"), (2, f"{words(9)} {part}"), (5, f"{words(20)} {passage} {words(9)}"),
            (7, f"{words(40)} {passage}"), (8, f"{passage} {words(8)}"), (8, f"{words(3)} {passage}")]
    spans = chunks.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(r["doc_id"], r["first_doc_id"]) for r in spans} == {(7, 5), (8, 5)} and len(spans) == 3
    assert all(r["length"] == len(passage) for r in spans)
    texts = dict(rows)
    for r in spans:
        if r["doc_id"] == 7:
            assert texts[7].encode()[r["start"]:r["start"] + r["length"]] == passage.encode()


def test_passages_of_51_words_are_found_whatever_surrounds_them(spark):
    """Of short words, of repeated phrases, in another script: each whole."""
    rng = np.random.default_rng(9)
    words = lambda n, least, most: ["".join(rng.choice(list("abcdefghij"), size=int(rng.integers(least, most)))) for _ in range(n)]
    passages = [" ".join(words(51, 1, 2 + i % 7)) for i in range(60)]
    passages += [" ".join((words(k, 1, 8) * 51)[:51]) for k in range(1, 13)]
    passages += ["".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 5000, 60))]
    rows = [(k * 1000 + i, " ".join([*words(int(rng.integers(5, 60)), 3, 9), p, *words(int(rng.integers(5, 60)), 3, 9)]))
            for i, p in enumerate(passages) for k in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spans = {r["doc_id"]: r for r in chunks.repeated_spans(docs).collect()}
    texts = dict(rows)
    for i, p in enumerate(passages):
        r = spans[2000 + i]
        assert r["first_doc_id"] == 1000 + i
        assert texts[2000 + i].encode()[r["start"]:r["start"] + r["length"]] == p.encode()


def test_spans_hold_all_repeated_windows(sf_docs):
    """Against all windows of whole words of the table, by their bytes."""
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in sf_docs.collect()]
    first, own = {}, defaultdict(list)
    for i, raw in rows:
        at = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        fits = lambda k, j: j - k >= chunks.MIN_WORDS - 1 or at[j][1] - at[k][0] >= chunks.MIN_SPAN
        runs = {(k, next((j for j in range(k, len(at)) if fits(k, j)), -1)) for k in range(len(at))}
        runs |= {(next((k for k in range(j, -1, -1) if fits(k, j)), -1), j) for j in range(len(at))}
        for k, j in runs:
            if k >= 0 and j >= 0:
                own[i].append((at[k][0], at[j][1], raw[at[k][0]:at[j][1]]))
                first[own[i][-1][2]] = min(i, first.get(own[i][-1][2], i))
    texts, got = dict(rows), defaultdict(list)
    for r in chunks.repeated_spans(sf_docs).collect():
        got[r["doc_id"]].append((r["start"], r["start"] + r["length"]))
        assert r["first_doc_id"] < r["doc_id"]
        assert texts[r["doc_id"]][slice(*got[r["doc_id"]][-1])] in texts[r["first_doc_id"]]
    covered = lambda spans: {x for a, b in spans for x in range(a, b)}
    for i in texts:
        assert covered(got[i]) >= covered((a, b) for a, b, w in own[i] if first[w] < i)
    assert got


def test_passages_too_short_for_a_span_are_not_asked_for(spark):
    """Three short shared passages in a row make a long stretch; no holder's bytes are fetched for it in vain."""
    rng = np.random.default_rng(8)
    passage = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))
    rows = []
    for i in range(100):
        shared = [passage(8) for _ in range(3)]
        rows += [(4 * i + k, f"{passage(20)} {p} {passage(20)}") for k, p in enumerate(shared)]
        rows.append((4 * i + 3, " ".join(shared)))
    asked = chunks._meetings(chunks._keyed(spark.createDataFrame(rows, "doc_id long, text string")), 99)
    assert asked.count() < 30
    whole = passage(30)
    more = spark.createDataFrame([*rows, (900, f"{passage(9)} {whole} {passage(9)}"), (901, f"{passage(5)} {whole}")],
                                 "doc_id long, text string")
    got = chunks.repeated_spans(more).collect()
    assert [(r["doc_id"], r["first_doc_id"], r["length"]) for r in got] == [(901, 900, len(whole))]
