"""Cases of the wire contracts."""

import json

import pytest

from goldseam.functions.contracts import TRANSACTION_CONTRACT, USER_CONTRACT, with_violations

VALID = {
    "transaction_id": "tx-1",
    "user_id": "u-1",
    "timestamp": "2024-01-15T10:00:00Z",
    "transaction_type": "BUY",
    "currency": "USD",
    "amount_brl": 5000.0,
    "amount_foreign": 1000.0,
    "exchange_rate": 5,
    "spread_pct": 0.5,
    "status": "completed",
}
USER = {"user_id": "u-1", "name": "A", "email": "a@example.org", "tier": "gold", "state": "SP"}


def check(spark, value, contract=TRANSACTION_CONTRACT, **options):
    text = value if isinstance(value, str) or value is None else json.dumps(value)
    frame = spark.createDataFrame([(text,)], "value string")
    return with_violations(frame, contract, **options).first()["violations"]


def test_accepts_minimal_full_and_old_messages(spark):
    assert check(spark, VALID) == []
    full = {**VALID, "fee_brl": 1, "channel": "web", "device": "x", "is_anomaly": True, "anomaly_score": 1}
    assert check(spark, full) == []


@pytest.mark.parametrize("name", ["transaction_id", "user_id", "currency", "amount_brl", "status"])
def test_required_fields(spark, name):
    assert check(spark, {k: v for k, v in VALID.items() if k != name}) == [f"required:{name}"]


@pytest.mark.parametrize(
    "change,code",
    [
        ({"currency": "US"}, "pattern:currency"),
        ({"currency": "usd"}, "pattern:currency"),
        ({"currency": "USDD"}, "pattern:currency"),
        ({"amount_brl": -1}, "minimum:amount_brl"),
        ({"transaction_type": "TRANSFER"}, "enum:transaction_type"),
        ({"anomaly_score": 1.5}, "maximum:anomaly_score"),
        ({"anomaly_score": -0.1}, "minimum:anomaly_score"),
        ({"spread_pct": 100.5}, "maximum:spread_pct"),
        ({"unknown_field": 1}, "additional:unknown_field"),
        ({"amount_brl": "12"}, "type:amount_brl"),
        ({"user_id": 7}, "type:user_id"),
        ({"user_id": None}, "type:user_id"),
        ({"is_anomaly": "true"}, "type:is_anomaly"),
    ],
)
def test_single_faults(spark, change, code):
    assert check(spark, {**VALID, **change}) == [code]


@pytest.mark.parametrize("text", ["not-json", "{broken", "", "null", "[1]", None])
def test_malformed_texts(spark, text):
    assert check(spark, text) == ["malformed"]


def test_user_contract(spark):
    assert check(spark, USER, USER_CONTRACT) == []
    assert check(spark, {**USER, "extra": 1}, USER_CONTRACT) == []
    assert check(spark, {**USER, "tier": "vip"}, USER_CONTRACT) == ["enum:tier"]
    for state in ("SP1", "sp"):
        assert check(spark, {**USER, "state": state}, USER_CONTRACT) == ["pattern:state"]
    assert check(spark, {"user_id": "u"}, USER_CONTRACT) == [
        "required:email",
        "required:name",
        "required:tier",
    ]
    assert check(spark, USER, USER_CONTRACT, assert_formats=True) == ["format:user_id"]
