"""Message validation, reject reasons and contract checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourseloom.schemas import HEADLINE_REQUIRED, PRICE_REQUIRED, Contract


def present(name: str, truthy: bool) -> Column:
    """Field test: not null, and with ``truthy`` not the empty string either (blanks pass)."""
    c = F.col(name)
    return c.isNotNull() & (c != "") if truthy else c.isNotNull()


def valid(df: DataFrame, required: Sequence[str], truthy: bool) -> DataFrame:
    """Rows whose required fields are all present."""
    for name in required:
        df = df.filter(present(name, truthy))
    return df


def valid_headlines(df: DataFrame) -> DataFrame:
    return valid(df, HEADLINE_REQUIRED, truthy=True)


def valid_prices(df: DataFrame) -> DataFrame:
    return valid(df, PRICE_REQUIRED, truthy=False)


def reject_reasons(df: DataFrame, required: Sequence[str], truthy: bool) -> DataFrame:
    """Adds ``reasons``: every required field the row lacks."""
    named = [F.when(~F.coalesce(present(c, truthy), F.lit(False)), F.lit(c)) for c in required]
    return df.withColumn("reasons", F.array_compact(F.array(*named)))


def rejected_counts(
    df: DataFrame, required: Sequence[str], truthy: bool, feed: str
) -> DataFrame:
    """Rejections per feed and missing field; one row counts once per field it lacks."""
    return (
        reject_reasons(df, required, truthy)
        .select(F.explode("reasons").alias("field"))
        .groupBy("field").agg(F.count(F.lit(1)).alias("rejected"))
        .select(F.lit(feed).alias("feed"), "field", "rejected")
    )


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """(contract, rule, field, violations) for every rule, zeros included.

    Row rules share one aggregation pass. The key rule counts surplus rows per key with a
    partial aggregate, so a key of any weight is combined before the shuffle. Columns the
    frame lacks or holds in another type are counted under rule ``schema``.
    """
    have = set(df.columns)
    rules: list[tuple[str, str, Column]] = []

    def add(rule: str, name: str, broken: Column) -> None:
        if name in have:
            rules.append((rule, name, F.count_if(broken)))

    lacking = sum(f.name not in have for f in contract.schema)
    wrong = sum(f.name in have and df.schema[f.name].dataType != f.dataType
                for f in contract.schema)
    rules.append(("schema", "missing", F.lit(lacking).cast("long")))
    rules.append(("schema", "wrong_type", F.lit(wrong).cast("long")))
    for name in contract.not_null:
        add("not_null", name, F.col(name).isNull())
    for name in contract.non_blank:
        add("non_blank", name, F.trim(name) == "")
    for name, limit in contract.max_length.items():
        add("max_length", name, F.length(name) > limit)
    for name, allowed in contract.domain.items():
        add("domain", name, ~F.col(name).isin(allowed))
    for name, (low, high) in contract.between.items():
        add("range", name, ~F.col(name).between(low, high))

    checked = df.agg(*[r[2].alias(f"_v{i}") for i, r in enumerate(rules)])
    report = checked.select(F.inline(F.array(*[
        F.struct(
            F.lit(contract.name).alias("contract"), F.lit(rule).alias("rule"),
            F.lit(name).alias("field"), F.col(f"_v{i}").alias("violations"),
        )
        for i, (rule, name, _) in enumerate(rules)
    ])))
    if contract.unique and set(contract.unique) <= have:
        keyed = df.groupBy(*contract.unique).agg(F.count(F.lit(1)).alias("_n"))
        surplus = keyed.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("violations"))
        report = report.unionByName(surplus.select(
            F.lit(contract.name).alias("contract"), F.lit("unique").alias("rule"),
            F.lit(",".join(contract.unique)).alias("field"), "violations",
        ))
    return report


def with_defaults(df: DataFrame, contract: Contract, now: Column) -> DataFrame:
    """Fill nulls by the contract's column defaults; ``now`` stands for the load time."""
    for name, value in contract.defaults.items():
        if name in df.columns:
            df = df.withColumn(name, F.coalesce(name, now if value == "now" else F.lit(value)))
    return df
