"""JSON message encoding and decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How a missing value looks when a NaN was written as JSON.
NAN_TEXTS = ["NaN", '"NaN"']


def encode(df: DataFrame, key: str | None = None) -> DataFrame:
    """Whole rows as one JSON ``value`` column, with ``key`` beside it; nulls are written out."""
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    value = F.to_json(record, {"ignoreNullFields": "false"}).alias("value")
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), value)


def parsed(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON text or bytes -> one column per field, other columns of ``df`` kept.

    ``inline`` fixes the parse in place: each document is parsed once, whatever is filtered
    or projected from its fields later.
    """
    rest = [F.col(c) for c in df.columns if c != value]
    record = F.from_json(F.col(value).cast("string"), schema)
    return df.select(*rest, F.inline(F.array(record)).alias(*schema.names))


def decode(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Messages -> typed rows.

    A missing key, a malformed document and a NaN token all become null; unknown keys are ignored.
    """
    rest = [c for c in df.columns if c != value]
    return parsed(df, schema, value).select(*rest, *[_nan_to_null(f).alias(f.name) for f in schema])


def _nan_to_null(field: T.StructField) -> Column:
    c = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.when(~c.isin(NAN_TEXTS), c)
    if isinstance(field.dataType, T.DoubleType):
        return F.when(~F.isnan(c), c)
    return c


def json_array(items: Column) -> Column:
    """Array -> JSON text, ``[]`` for an empty or missing array."""
    return F.coalesce(F.to_json(items), F.lit("[]"))
