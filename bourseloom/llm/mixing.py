"""Mixing sources to target weights by iterative proportional fitting. DataFrame operations only.

Documents are reduced to cells (source x language x topic) with their tokens. Raking multiplies
the cells' weights until their sums meet a target for every source, language and topic in turn.
A cell can give no more than it has: what a full cell cannot give, the others of its margin do. Rounds
go on until the margins stop getting closer. Then
``weight / tokens`` of a cell is the probability with which each of its documents is sampled.

By default the target of a value is its own tokens to the power ``temper``, scaled to
``keep_share`` of all tokens: large sources shrink, small ones stay. The table has no topic
column, so the topic stands in for one: a bucket of the document's alphabetically last word, the
same for copies. A document's random number comes from its id, so a run can be repeated.

Only cells, a product of three short lists, are raked; documents see one aggregate with partial
sums and one join with the cells. Sums of a hot source are partial aggregates too.

Defined cases: null source or language is the value ''; a null text has no tokens and the topic
of the empty word; cells without tokens are sampled with probability 1, as they weigh nothing;
rows with one id are sampled together; a null id counts as the text 'null'; an empty table gives
an empty table; helper columns start with ``__mix_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bourseloom.llm.store import settle

TOPICS, ROUNDS, TEMPER, KEEP_SHARE, SEED = 8, 8, 0.7, 0.8, "mix"
MOST_STEPS, STALL, CLOSE = 10, 0.05, 1e-4
DIMS = ("__mix_source", "__mix_lang", "__mix_topic")


def words(text: Column) -> Column:
    """The text's words: runs without ASCII white space."""
    blank = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(blank, " "), lambda w: w != F.lit(""))


def topic_of(last_word: Column, topics: int = TOPICS) -> Column:
    first = F.conv(F.substring(F.md5(F.coalesce(last_word, F.lit("")).cast("binary")), 1, 4), 16, 10)
    return first.cast("int") % topics


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    named = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def described(docs: DataFrame, topics: int = TOPICS) -> DataFrame:
    """Documents with their cell and tokens."""
    own = docs.withColumn("__mix_words", words(F.col("text")))
    return own.select(
        *[docs[c] for c in docs.columns],
        F.coalesce("source", F.lit("")).alias(DIMS[0]), F.coalesce("lang", F.lit("")).alias(DIMS[1]),
        topic_of(F.array_max("__mix_words"), topics).alias(DIMS[2]),
        F.size("__mix_words").cast("long").alias("__mix_tokens"))


def tempered_targets(cells: DataFrame, dim: str, temper: float, keep_share: float) -> DataFrame:
    """(value, target tokens) of a dimension."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").alias("have"))
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    power = F.pow(F.col("have").cast("double"), F.lit(temper))
    return sums.select(dim, (power / F.sum(power).over(every) * F.sum("have").over(every)
                             * keep_share).alias(f"{dim}_target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Cells with ``weight``: tokens raked to the targets, never more than the cell has.

    A margin below its target is raised by its cells that have room; full cells stay full.
    """
    if "weight" not in cells.columns:
        for dim, target in targets.items():
            cells = cells.join(target, dim)
        cells = cells.withColumn("weight", F.col("tokens").cast("double"))
    cells = cells.coalesce(1)  # a few hundred rows: windows need no exchange
    full, most = F.col("weight") >= F.col("tokens"), F.col("tokens").cast("double")
    for _ in range(rounds):
        for dim in targets:
            own = W.partitionBy(dim)
            cells = cells.select("*", F.sum("weight").over(own).alias("__mix_sum"),
                                 F.sum(F.when(full, F.col("weight")).otherwise(0.0)).over(own).alias("__mix_full"))
            goal = F.col(f"{dim}_target")
            factor = F.when(F.col("__mix_sum") <= 0, 0.0).when(
                F.col("__mix_sum") >= goal, goal / F.col("__mix_sum")).when(full, 1.0).otherwise(
                (goal - F.col("__mix_full")) / (F.col("__mix_sum") - F.col("__mix_full")))
            cells = cells.withColumn("weight", F.least(F.col("weight") * F.coalesce(factor, F.lit(1.0)), most)
                                     ).drop("__mix_sum", "__mix_full")
    return cells


def margin_errors(cells: DataFrame, dims: tuple[str, ...] = DIMS) -> DataFrame:
    """(dim, value, have, target) of raked cells: what each margin got and should have."""
    parts = [cells.groupBy(d).agg(F.sum("weight").alias("have"), F.first(f"{d}_target").alias("target")).select(
        F.lit(d).alias("dim"), F.col(d).cast("string").alias("value"), "have", "target") for d in dims]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def raked_cells(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Raked in steps of ``ROUNDS`` rounds until the misfit of all margins stops falling.

    The misfit is the sum of what the margins lack or have too much. A step that lowers it by less
    than ``STALL`` of itself is the last, as is one that leaves less than ``CLOSE`` of the tokens,
    and the step ``MOST_STEPS``. What is left is what the cells' tokens do not allow.
    """
    before = None
    for step in range(MOST_STEPS):
        cells = settle(rake(cells, targets), f"raked-{step}")
        misfit, tokens = margin_errors(cells, tuple(targets)).agg(
            F.sum(F.abs(F.col("have") - F.col("target"))), F.sum("target")).first()
        if not misfit or misfit <= CLOSE * tokens or (before is not None and misfit > (1 - STALL) * before):
            break
        before = misfit
    return cells


def probabilities(
    rows: DataFrame, rounds: int | None = None, temper: float = TEMPER, keep_share: float = KEEP_SHARE,
    targets: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """(cell, probability). ``targets`` gives (value, ``<dim>_target``) per dimension.

    Raked until the margins stop getting closer, or for a set number of ``rounds``.
    """
    cells = settle(rows.groupBy(*DIMS).agg(F.sum("__mix_tokens").alias("tokens")), "cells")
    targets = targets or {d: tempered_targets(cells, d, temper, keep_share) for d in DIMS}
    raked = raked_cells(cells, targets) if rounds is None else rake(cells, targets, rounds)
    share = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(1.0)
    return settle(raked.select(*DIMS, share.alias("__mix_probability")), "raked")


def mix(
    docs: DataFrame, rounds: int | None = None, temper: float = TEMPER, keep_share: float = KEEP_SHARE,
    seed: str = SEED, targets: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """The sampled documents with their cell, tokens and probability in ``__mix_`` columns."""
    rows = described(docs)
    chances = probabilities(rows.select(*DIMS, "__mix_tokens"), rounds, temper, keep_share, targets)
    return rows.join(chances, list(DIMS)).filter(
        uniform(F.col("doc_id"), seed) < F.col("__mix_probability"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The sampled documents in the columns of ``docs``."""
    return mix(docs, **options).select(docs.columns)


def mix_sql(temper: float = TEMPER, keep_share: float = KEEP_SHARE, seed: str = SEED, topics: int = TOPICS) -> str:
    """The SQL twin of ``op2``'s query over the view ``documents``; the rounds are a recursion."""
    blank = "translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     ')"
    dims = ("source", "lang", "topic")
    targets = "".join(f"""
sums_{d} AS (SELECT {d}, sum(tokens)::DOUBLE AS have FROM cells GROUP BY {d}),
target_{d} AS MATERIALIZED (
  SELECT {d}, pow(have, {temper}) / sum(pow(have, {temper})) OVER () * sum(have) OVER ()
              * {keep_share} AS {d}_target FROM sums_{d}),""" for d in dims)
    turned = "rounds"
    for d in dims:
        turned = f"""(
    SELECT * EXCLUDE (total, used) REPLACE (least(weight * CASE
             WHEN total <= 0 THEN 0 WHEN total >= {d}_target THEN {d}_target / total WHEN weight >= tokens THEN 1
             ELSE ({d}_target - used) / (total - used) END, tokens) AS weight)
    FROM (SELECT *, sum(weight) OVER (PARTITION BY {d}) AS total,
                 sum(CASE WHEN weight >= tokens THEN weight ELSE 0 END) OVER (PARTITION BY {d}) AS used
          FROM {turned} WHERE going))"""
    gaps = ", ".join(f"abs(sum(weight) OVER (PARTITION BY {d}) - {d}_target) / count(*) OVER (PARTITION BY {d}) AS gap_{d}"
                     f", {d}_target / count(*) OVER (PARTITION BY {d}) AS goal_{d}" for d in dims)
    step = f"(n + 1) % {ROUNDS} = 0"
    return f"""WITH RECURSIVE
rows AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
         ('0x' || substr(md5(coalesce(list_max(w), '')), 1, 4))::INTEGER % {topics} AS topic,
         len(w)::BIGINT AS tokens
  FROM (SELECT doc_id, source, lang, list_filter(string_split({blank}, ' '), lambda x: x <> '') AS w
        FROM documents)),
cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM rows GROUP BY ALL),{targets}
rounds AS (
  SELECT source, lang, topic, tokens::DOUBLE AS tokens, source_target, lang_target, topic_target,
         tokens::DOUBLE AS weight, 0 AS n, 1e300 AS before, true AS going
  FROM cells JOIN target_source USING (source) JOIN target_lang USING (lang) JOIN target_topic USING (topic)
  UNION ALL
  SELECT source, lang, topic, tokens, source_target, lang_target, topic_target, weight, n + 1,
         CASE WHEN {step} THEN misfit ELSE before END,
         NOT ({step} AND (misfit <= {CLOSE} * goals OR misfit > {1 - STALL} * before OR n + 1 >= {ROUNDS * MOST_STEPS}))
  FROM (SELECT *, sum(gap_source + gap_lang + gap_topic) OVER () AS misfit,
               sum(goal_source + goal_lang + goal_topic) OVER () AS goals
        FROM (SELECT *, {gaps} FROM {turned}))),
raked AS (
  SELECT source, lang, topic, CASE WHEN tokens > 0 THEN weight / tokens ELSE 1.0 END AS p
  FROM rounds WHERE n = (SELECT max(n) FROM rounds))
SELECT doc_id, source, lang, topic, tokens, round(p, 6) AS probability
FROM rows JOIN raked USING (source, lang, topic)
WHERE ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT
      / 4294967296.0 < p
"""
