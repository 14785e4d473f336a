"""Table schemas and contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()
_NTZ, _DATE = T.TimestampNTZType(), T.DateType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Column names, orders and length limits of the market-data tables.
OHLCV = ["open", "high", "low", "close", "volume", "adjusted_close"]

RAW_HEADLINE = _struct(
    ("headline_id", _S), ("symbol", _S), ("published_at", _S), ("source", _S),
    ("headline", _S), ("article_url", _S), ("scraped_at", _NTZ), ("inserted_at", _NTZ),
)
CLEAN_HEADLINE = _struct(
    ("headline_id", _S), ("symbol", _S), ("published_at", _S), ("source", _S),
    ("headline", _S), ("article_url", _S), ("scraped_at", _NTZ),
)
HEADLINE_MESSAGE = _struct(
    ("headline_id", _S), ("symbol", _S), ("published_at", _S), ("source", _S),
    ("headline", _S), ("article_url", _S), ("scraped_at", _S),
)
RAW_PRICE = _struct(
    ("symbol", _S), ("date", _DATE), ("open", _D), ("high", _D), ("low", _D),
    ("close", _D), ("volume", _L), ("adjusted_close", _D), ("inserted_at", _NTZ),
)
CLEAN_PRICE = _struct(
    ("symbol", _S), ("date", _DATE), ("open", _D), ("high", _D), ("low", _D),
    ("close", _D), ("volume", _L), ("adjusted_close", _D),
)
PRICE_MESSAGE = _struct(
    ("symbol", _S), ("date", _S), ("open", _D), ("high", _D), ("low", _D),
    ("close", _D), ("volume", _L), ("adjusted_close", _D), ("fetched_at", _S),
)
FEATURE_VECTOR = _struct(
    *[(f.name, f.dataType) for f in CLEAN_PRICE],
    ("headline_count", _L), ("headlines_json", _S),
)
EXECUTION_SIGNAL = _struct(
    ("symbol", _S), ("date", _DATE), ("signal", _S), ("confidence", _D),
    ("model_version", _S), ("created_at", _NTZ),
)
DAILY_BAR = _struct(
    ("symbol", _S), ("date", _DATE), ("open", _D), ("high", _D), ("low", _D),
    ("close", _D), ("volume", _L),
)
INTRADAY_BAR = _struct(
    ("symbol", _S), ("datetime", _NTZ), ("open", _D), ("high", _D), ("low", _D),
    ("close", _D), ("volume", _L),
)
STOCK = _struct(
    ("Symbol", _S), ("Stock_name", _S), ("Sector", _S), ("Groww_name", _S),
    ("TradingView_name", _S),
)
PREOPEN_PAYLOAD = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("metadata", _struct(
            ("symbol", _S), ("previousClose", _D), ("iep", _D), ("change", _D),
            ("pChange", _D), ("lastPrice", _D), ("finalQuantity", _L),
            ("totalTurnover", _D), ("marketCap", _D), ("yearHigh", _D), ("yearLow", _D),
        )),
    ]))),
    T.StructField("advances", _L),
    T.StructField("declines", _L),
    T.StructField("timestamp", _S),
])
# What counting advances and declines takes of a payload.
PREOPEN_MOVES = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([T.StructField("metadata", _struct(("change", _D)))]))),
    *PREOPEN_PAYLOAD.fields[1:],
])
PREDICTION_REQUEST = T.StructType([
    T.StructField("symbol", _S, False),
    T.StructField("date", _S, False),
    T.StructField("headlines", T.ArrayType(_S), True),
    T.StructField("latest_close", _D, True),
])
PREDICTION_RESPONSE = _struct(
    ("symbol", _S), ("date", _S), ("direction", _S), ("confidence", _D),
    ("model_version", _S), ("timestamp", _S),
)
PRICE_RECORD = _struct(
    ("symbol", _S), ("date", _S), ("open", _D), ("high", _D), ("low", _D),
    ("close", _D), ("volume", _L), ("adjusted_close", _D),
)
HEADLINE_RECORD = _struct(
    ("headline_id", _S), ("symbol", _S), ("published_at", _S), ("source", _S),
    ("headline", _S), ("author", _S), ("body_snippet", _S),
)
DIRECTIONS = ["high", "low", "flat"]
TOPICS = {
    "headlines": "news_features",
    "prices": "market_features",
    "signals": "execution_signals",
}


@dataclass(frozen=True)
class Contract:
    """What a table promises; Spark enforces none of it, so it is checked."""

    name: str
    schema: T.StructType
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    domain: dict[str, list[str]] = field(default_factory=dict)
    between: dict[str, tuple[float, float]] = field(default_factory=dict)
    non_blank: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)


# Keys, NOT NULL columns, length limits, domains and defaults.
CONTRACTS = {
    "raw_headlines": Contract(
        "raw_headlines", RAW_HEADLINE,
        not_null=("headline_id", "symbol", "headline"), unique=("headline_id",),
        max_length={"headline_id": 64, "symbol": 128, "published_at": 128, "source": 256},
        non_blank=("headline",),
        defaults={"scraped_at": "now", "inserted_at": "now"},
    ),
    "raw_prices": Contract(
        "raw_prices", RAW_PRICE,
        not_null=("symbol", "date"), unique=("symbol", "date"),
        max_length={"symbol": 128},
        defaults={"inserted_at": "now"},
    ),
    "clean_headlines": Contract(
        "clean_headlines", CLEAN_HEADLINE,
        not_null=("headline_id", "symbol", "headline"), unique=("headline_id",),
        max_length={"headline_id": 64, "symbol": 128, "published_at": 128, "source": 256},
        non_blank=("headline",),
    ),
    "clean_prices": Contract(
        "clean_prices", CLEAN_PRICE,
        not_null=("symbol", "date"), unique=("symbol", "date"),
        max_length={"symbol": 128},
    ),
    "feature_vectors": Contract(
        "feature_vectors", FEATURE_VECTOR,
        not_null=("symbol", "date"), unique=("symbol", "date"),
        max_length={"symbol": 128},
        defaults={"headline_count": 0, "headlines_json": "[]"},
    ),
    "execution_signals": Contract(
        "execution_signals", EXECUTION_SIGNAL,
        not_null=("symbol", "date", "signal"),
        max_length={"symbol": 128, "signal": 16, "model_version": 256},
        domain={"signal": DIRECTIONS}, between={"confidence": (0.0, 1.0)},
        defaults={"created_at": "now"},
    ),
    "price_record": Contract(
        "price_record", PRICE_RECORD,
        not_null=("symbol", "date", "open", "high", "low", "close", "volume"),
    ),
    "headline_record": Contract(
        "headline_record", HEADLINE_RECORD,
        not_null=("headline_id", "symbol", "published_at", "source", "headline"),
    ),
    "prediction_request": Contract(
        "prediction_request", PREDICTION_REQUEST, not_null=("symbol", "date"),
    ),
    "prediction_response": Contract(
        "prediction_response", PREDICTION_RESPONSE,
        not_null=("symbol", "date", "direction", "confidence", "model_version"),
        domain={"direction": DIRECTIONS}, between={"confidence": (0.0, 1.0)},
    ),
}

# Fields a message must carry to be accepted.
HEADLINE_REQUIRED = ["headline_id", "symbol", "headline"]
PRICE_REQUIRED = ["symbol", "date", "close"]
