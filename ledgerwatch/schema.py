"""Schemas of transactions and alerts, and the value sets the rules look up."""

from __future__ import annotations

# Field names and types of a transaction message.
TRANSACTION_FIELDS = {
    "transaction_id": "string",
    "account_id": "string",
    "merchant_id": "string",
    "amount": "double",
    "currency": "string",
    "transaction_type": "string",
    "merchant_category": "string",
    "country": "string",
    "city": "string",
    "device_type": "string",
    "ip_address": "string",
    "timestamp": "string",
    "is_fraud": "boolean",
}

# Field names and types of an alert message.
ALERT_FIELDS = {
    "alert_id": "string",
    "transaction_id": "string",
    "account_id": "string",
    "merchant_category": "string",
    "amount": "double",
    "country": "string",
    "fraud_score": "double",
    "label": "string",
    "rules_triggered": "array<string>",
    "detection_latency_ms": "double",
    "detected_at": "string",
    "is_fraud_ground_truth": "boolean",
}

# Categories and countries that count as high risk.
HIGH_RISK_CATEGORIES = ["GAMBLING", "CRYPTO_EXCHANGE", "MONEY_TRANSFER"]
HIGH_RISK_COUNTRIES = ["NG", "RO", "CN", "PK", "VN"]

# Device name that stands for an unidentified device.
UNKNOWN_DEVICE = "unknown"


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())
