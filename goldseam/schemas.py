"""Table schemas, feature views and the fixed value lists of the data contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ISO-4217 codes the cleaning step keeps.
VALID_CURRENCIES = ("USD", "EUR", "GBP", "JPY", "AUD", "CAD", "CNY", "CHF", "MXN", "ARS")

# Enumerations of the wire contracts.
TRANSACTION_TYPES = ("BUY", "SELL")
STATUSES = ("pending", "completed", "failed", "cancelled")
CHANNELS = ("mobile", "web", "api")
TIERS = ("standard", "gold", "platinum")


def _struct(required: dict[str, T.DataType], optional: dict[str, T.DataType]) -> T.StructType:
    fields = [T.StructField(n, t, False) for n, t in required.items()]
    return T.StructType(fields + [T.StructField(n, t, True) for n, t in optional.items()])


_TEXT, _TIME, _NUMBER, _FLAG = T.StringType(), T.TimestampType(), T.DoubleType(), T.BooleanType()
_dec = T.DecimalType

# Column names and types of the data model, required ones first.
RAW_TRANSACTION = _struct(
    {
        "transaction_id": _TEXT,
        "user_id": _TEXT,
        "timestamp": _TIME,
        "transaction_type": _TEXT,
        "currency": _TEXT,
        "amount_brl": _dec(15, 2),
        "amount_foreign": _dec(15, 4),
        "exchange_rate": _dec(10, 4),
        "spread_pct": _dec(5, 3),
    },
    {
        "fee_brl": _dec(10, 2),
        "status": _TEXT,
        "channel": _TEXT,
        "device": _TEXT,
        "is_anomaly": _FLAG,
        "anomaly_score": _dec(5, 4),
    },
)
TRANSACTION = T.StructType(
    [f for f in RAW_TRANSACTION.fields if f.name not in ("is_anomaly", "anomaly_score")]
)
USER = _struct(
    {"user_id": _TEXT, "name": _TEXT},
    {
        "cpf": _TEXT,
        "email": _TEXT,
        "state": _TEXT,
        "tier": _TEXT,
        "registration_date": _TIME,
        "avg_monthly_volume": _dec(15, 2),
    },
)
EXCHANGE_RATE = _struct(
    {"rate_id": _TEXT, "currency_pair": _TEXT, "rate": _dec(10, 4)},
    {"bid": _dec(10, 4), "ask": _dec(10, 4)},
).add("timestamp", _TIME, False)
RATE_EVENT = _struct(
    {},
    {
        "currency_pair": _TEXT,
        "currency": _TEXT,
        "rate": _NUMBER,
        "bid": _NUMBER,
        "ask": _NUMBER,
        "pct_change": _NUMBER,
        "timestamp": _TEXT,
        "is_anomaly": _FLAG,
        "source": _TEXT,
    },
)
BRONZE_AUDIT = ("_bronze_loaded_at", "_source_file", "_batch_id")
ANOMALY_SUMMARY = {
    "date": "date",
    "total_transactions": "long",
    "total_anomalies": "long",
    "anomaly_rate": "double",
}

# The model's input columns, in vector order.
MODEL_FEATURES = (
    "amount_brl",
    "hour_of_day",
    "day_of_week",
    "is_business_hours",
    "spread_pct",
    "velocity_1h",
    "z_score_amount",
)


@dataclass(frozen=True)
class FeatureView:
    """Features of an entity at points in time, valid for ``ttl_seconds``."""

    name: str
    entity: tuple[str, ...]
    features: tuple[str, ...]
    ttl_seconds: int
    timestamp: str = "event_timestamp"
    tags: dict = field(default_factory=dict, compare=False)


# The three stored feature views.
USER_FEATURES = FeatureView(
    "user_transaction_features",
    ("user_id",),
    (
        "total_transactions_30d",
        "total_volume_30d",
        "avg_ticket_30d",
        "preferred_currency",
        "transaction_count_buy",
        "transaction_count_sell",
        "days_since_registration",
        "tier",
    ),
    86_400,
)
CURRENCY_FEATURES = FeatureView(
    "currency_features",
    ("currency",),
    (
        "current_rate",
        "rate_change_1h",
        "rate_change_24h",
        "volatility_7d",
        "avg_spread",
        "volume_24h",
    ),
    3_600,
)
PATTERN_FEATURES = FeatureView(
    "transaction_pattern_features",
    ("user_id",),
    (
        "transactions_last_1h",
        "avg_amount_last_24h",
        "distinct_currencies_last_7d",
        "night_transaction_ratio",
    ),
    3_600,
)
