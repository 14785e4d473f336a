"""CSV and JSON files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourseloom.functions.codec import parsed
from bourseloom.functions.text import na_to_null, safe_name
from bourseloom.functions.times import iso_market, market_now
from bourseloom.operators.bars import TIME_COL
from bourseloom.schemas import (
    DAILY_BAR, HEADLINE_MESSAGE, INTRADAY_BAR, PREOPEN_PAYLOAD, PRICE_MESSAGE, STOCK,
)
from bourseloom.sources.tables import write_table

# Fixed value: file name ending of stored bars per interval.
BAR_SUFFIX = "_%s_data.csv"
CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns -> the schema's types; NA texts and unreadable values become null.

    Numbers for a whole-number column are read as doubles and cut, so ``12.0`` is 12.
    """
    out = []
    for f in schema:
        c = na_to_null(F.col(f.name))
        if isinstance(f.dataType, T.LongType):
            c = c.try_cast("double").try_cast("long")
        elif not isinstance(f.dataType, T.StringType):
            c = c.try_cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """CSV with a header, typed by ``schema``.

    ``multi_line`` lets quoted fields span lines; such a file cannot be split over tasks.
    """
    raw = (
        spark.read.options(header="true", escape='"', multiLine=str(multi_line).lower())
        .options(**options).schema(_as_text(schema)).csv(path)
    )
    return typed(raw, schema)


def read_headlines_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_csv(spark, path, HEADLINE_MESSAGE, multi_line)


def read_prices_csv(spark: SparkSession, path: str) -> DataFrame:
    """Price rows stamped with the fetch time; a bad number is null and fails validation later."""
    stored = T.StructType([f for f in PRICE_MESSAGE if f.name != "fetched_at"])
    return read_csv(spark, path, stored).withColumn("fetched_at", iso_market(market_now()))


def read_stock_list(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, STOCK)


def _history_lines(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> DataFrame | None:
    """All lines as text columns, with the line itself where its shape is wrong, and the file."""
    layout = _as_text(schema).add(CORRUPT, T.StringType())
    try:
        raw = (
            spark.read.options(header="true", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                               enforceSchema="true", ignoreCorruptFiles="true")
            .options(**options).schema(layout).csv(path)
        )
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return None
    return raw.withColumn(SOURCE_FILE, F.col("_metadata.file_name"))


def _sound(schema: T.StructType) -> Column:
    return F.col(CORRUPT).isNull() & F.coalesce(*schema.names).isNotNull()


def read_history(
    spark: SparkSession, path: str, schema: T.StructType, with_file: bool = False, **options: str
) -> DataFrame:
    """Stored history; an absent folder or file is an empty history, not an error.

    A byte-order mark before the header does no harm, since columns go by position. Lines of
    another shape than the header and lines without any value are left out here; they are what
    :func:`rejected_lines` gives. ``with_file`` adds the name of each row's file.
    """
    raw = _history_lines(spark, path, schema, **options)
    if raw is None:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(SOURCE_FILE, F.lit("")) if with_file else empty
    kept = raw.filter(_sound(schema))
    if not with_file:
        return typed(kept, schema)
    return typed(kept, T.StructType([*schema.fields, T.StructField(SOURCE_FILE, T.StringType())]))


def rejected_lines(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> DataFrame:
    """(source_file, line) of what :func:`read_history` leaves out; a line without values is ''."""
    raw = _history_lines(spark, path, schema, **options)
    if raw is None:
        return spark.createDataFrame([], f"{SOURCE_FILE} string, line string")
    return raw.filter(~_sound(schema)).select(
        SOURCE_FILE, F.coalesce(CORRUPT, F.lit("")).alias("line"))


def silent_files(
    spark: SparkSession, path: str, schema: T.StructType, **options: str
) -> DataFrame:
    """(source_file, bytes) of files that gave :func:`read_history` no line at all.

    These are files that cannot be read, such as broken archives, and files of a header only. A file
    that breaks off in its middle gives the lines before that.
    """
    raw = _history_lines(spark, path, schema, **options)
    if raw is None:
        return spark.createDataFrame([], f"{SOURCE_FILE} string, bytes long")
    kinds = {k: v for k, v in options.items() if k in ("pathGlobFilter", "recursiveFileLookup")}
    found = spark.read.format("binaryFile").options(**kinds).load(path).select(
        F.col("_metadata.file_name").alias(SOURCE_FILE), F.col("length").alias("bytes"))
    return found.join(raw.select(SOURCE_FILE).distinct(), SOURCE_FILE, "left_anti")


def bar_schema(interval: str) -> T.StructType:
    return DAILY_BAR if interval == "daily" else INTRADAY_BAR


def read_bar_files(spark: SparkSession, folder: str, interval: str) -> DataFrame:
    """All per-stock bar files of an interval; merged files and corrupt files are passed over.

    :func:`silent_files` names the files that gave nothing.
    """
    return read_history(spark, folder, bar_schema(interval),
                        pathGlobFilter="*" + BAR_SUFFIX % interval)


def write_bars(
    df: DataFrame, path: str, interval: str, mode: str = "append", stock_folders: bool = True
) -> int:
    """Append bars as CSV, partitioned by the stock's safe name and year.

    One writer per stock and year keeps files few and a hot stock spread over its years. Every stock
    costs a file per year and append, so where stocks are many and their bars few, ``stock_folders`` off
    lets the stocks of a writer share its file of a year: files then grow with the bytes alone.
    """
    named = df.withColumns({
        "stock": safe_name(F.col("symbol")), "year": F.year(TIME_COL[interval]),
    }).repartition("stock", "year")
    if stock_folders:
        return write_table(named, path, ["stock", "year"], fmt="csv", mode=mode, header="true")
    return write_table(named.drop("stock"), path, ["year"], fmt="csv", mode=mode, header="true")


def read_bars(spark: SparkSession, path: str, interval: str) -> DataFrame:
    """What :func:`write_bars` stored, without the partition columns."""
    return read_history(spark, path, bar_schema(interval), recursiveFileLookup="true")


def read_preopen_json(spark: SparkSession, path: str) -> DataFrame:
    """Payload documents, one per file."""
    return spark.read.option("multiLine", True).schema(PREOPEN_PAYLOAD).json(path)


def parse_preopen(
    df: DataFrame, text: str, with_id: bool = False, schema: T.StructType = PREOPEN_PAYLOAD
) -> DataFrame:
    """Payload documents held in a text column; ``with_id`` adds the document's hash.

    A narrower ``schema`` (``PREOPEN_MOVES``) leaves fields that are not needed unread.
    """
    kept = [F.sha2(text, 256).alias("payload_id")] if with_id else []
    return parsed(df.select(*kept, text), schema, text)
