"""Rules, scores and labels on single transactions."""

import pytest

from ledgerwatch.functions.rules import FIRED_RULES, RULE_SCORE
from ledgerwatch.functions.scores import LABEL, score_transactions
from ledgerwatch.operators.alerts import raise_alerts

PLAIN = {"amount": 25.0, "merchant_category": "GROCERY", "country": "US", "device_type": "mobile_ios"}
TYPES = "name string, amount double, merchant_category string, country string, device_type string"

# name: (changes to the plain transaction, score, fired rules)
CASES = {
    "plain": ({}, 0.0, []),
    "small grocery": ({"amount": 12.5}, 0.0, []),
    "high": ({"amount": 4001.0}, 0.30, ["HIGH_AMOUNT_3K"]),
    "very high": ({"amount": 9001.0}, 0.50, ["HIGH_AMOUNT_3K", "VERY_HIGH_AMOUNT_8K"]),
    "below limit": ({"amount": 2999.99}, 0.0, []),
    "at limit": ({"amount": 3000.0}, 0.38, ["HIGH_AMOUNT_3K", "SUSPICIOUSLY_ROUND_AMOUNT"]),
    "gambling": ({"merchant_category": "GAMBLING"}, 0.25, ["HIGH_RISK_MCC:GAMBLING"]),
    "crypto": ({"merchant_category": "CRYPTO_EXCHANGE"}, 0.25, ["HIGH_RISK_MCC:CRYPTO_EXCHANGE"]),
    "cash machine": ({"merchant_category": "ATM"}, 0.0, []),
    "country": ({"country": "NG"}, 0.20, ["HIGH_RISK_COUNTRY:NG"]),
    "device": ({"device_type": "unknown"}, 0.10, ["UNKNOWN_DEVICE"]),
    "micro": ({"amount": 0.99}, 0.15, ["MICRO_AMOUNT_CARD_TEST"]),
    "zero": ({"amount": 0.0}, 0.0, []),
    "two": ({"amount": 2.0}, 0.0, []),
    "negative": ({"amount": -500.0}, 0.0, []),
    "round": ({"amount": 1000.0}, 0.08, ["SUSPICIOUSLY_ROUND_AMOUNT"]),
    "first round": ({"amount": 500.0}, 0.08, ["SUSPICIOUSLY_ROUND_AMOUNT"]),
    "too small to be round": ({"amount": 400.0}, 0.0, []),
    "no country": ({"country": None}, 0.0, []),
    "nothing known": ({"merchant_category": None, "country": None, "device_type": None}, 0.0, []),
    "just an alert": (
        {"amount": 3001.0, "merchant_category": "GAMBLING", "device_type": "unknown"},
        0.65,
        ["HIGH_AMOUNT_3K", "HIGH_RISK_MCC:GAMBLING", "UNKNOWN_DEVICE"],
    ),
    "just no fraud": (
        {"amount": 8001.0, "country": "NG", "device_type": "unknown"},
        0.7999999999999999,
        ["HIGH_AMOUNT_3K", "VERY_HIGH_AMOUNT_8K", "HIGH_RISK_COUNTRY:NG", "UNKNOWN_DEVICE"],
    ),
    "capped": (
        {"amount": 50000.0, "merchant_category": "GAMBLING", "country": "NG", "device_type": "unknown"},
        1.0,
        [
            "HIGH_AMOUNT_3K",
            "VERY_HIGH_AMOUNT_8K",
            "HIGH_RISK_MCC:GAMBLING",
            "HIGH_RISK_COUNTRY:NG",
            "UNKNOWN_DEVICE",
            "SUSPICIOUSLY_ROUND_AMOUNT",
        ],
    ),
}


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(name, *{**PLAIN, **changes}.values()) for name, (changes, _, _) in CASES.items()]
    frame = spark.createDataFrame(rows, TYPES).selectExpr("name", f"{RULE_SCORE} as score", f"{FIRED_RULES} as rules")
    return {row.name: row for row in frame.collect()}


@pytest.mark.parametrize("name", CASES)
def test_rule_score_and_rules(scored, name):
    _, score, rules = CASES[name]
    assert scored[name].score == score
    assert scored[name].rules == rules


def features(spark, rows):
    columns = "transaction_id string, amount double, merchant_category string, country string, device_type string, "
    values = [(str(i), *{**PLAIN, **changes}.values(), count, spend) for i, (changes, count, spend) in enumerate(rows)]
    return spark.createDataFrame(values, columns + "window_count bigint, window_spend double")


def test_velocity_scores(spark):
    cases = [
        (20, 5000.0, 0.0, []),
        (21, 0.0, 1 / 30, ["VELOCITY_COUNT:21"]),
        (32, 0.0, 0.40, ["VELOCITY_COUNT:32"]),
        (500, 0.0, 0.40, ["VELOCITY_COUNT:500"]),
        (1, 5000.5, 0.00005, ["VELOCITY_SPEND:5000"]),
        (1, 5001.5, 0.00015, ["VELOCITY_SPEND:5002"]),
        (1, 8000.0, 0.30, ["VELOCITY_SPEND:8000"]),
        (50, 90000.0, 0.70, ["VELOCITY_COUNT:50", "VELOCITY_SPEND:90000"]),
    ]
    rows = score_transactions(features(spark, [({}, n, spend) for n, spend, _, _ in cases])).orderBy(
        "transaction_id"
    ).collect()
    for row, (_, _, score, rules) in zip(rows, cases):
        assert row.velocity_score == pytest.approx(score, abs=1e-15)
        assert row.fraud_score == row.velocity_score
        assert row.rules_triggered == rules


def test_labels_and_threshold_use_the_unrounded_score(spark):
    rows = [
        (CASES["just an alert"][0], 1, 0.0),
        (CASES["just no fraud"][0], 1, 0.0),
        (CASES["capped"][0], 40, 9000.0),
        (CASES["very high"][0], 1, 0.0),
    ]
    scored = score_transactions(features(spark, rows)).selectExpr("*", "'A' as account_id", "null as is_fraud")
    alerts = raise_alerts(scored, "12.345D", "timestamp'2024-01-01 00:00:00'").orderBy("transaction_id").collect()
    assert [(a.transaction_id, a.fraud_score, a.label) for a in alerts] == [
        ("0", 0.65, "REVIEW"),
        ("1", 0.8, "REVIEW"),
        ("2", 1.0, "FRAUD"),
    ]
    assert alerts[0].is_fraud_ground_truth is False
    assert LABEL.startswith("case")
