"""JSON messages: decoding transactions, setting bad ones aside, encoding alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerwatch.schema import ALERT_FIELDS, TRANSACTION_FIELDS, ddl

# How far the time of an event may be ahead of its message: clocks differ a little.
FUTURE_SECONDS = 300

# Why a decoded row cannot be scored; null for a good row. Amounts from 10^20 on are no money (see functions/columns.py).
FAULT = """case
    when transaction_id is null then 'no transaction_id'
    when account_id is null then 'no account_id'
    when amount is null or isnan(amount) then 'no amount'
    when abs(amount) >= 1.0E20D then 'amount out of range'
    when event_time is null then 'no event time'
    end"""

# In a stream that keeps what is newest, a row dated ahead of its message is a fault too.
STREAM_FAULT = f"""coalesce({FAULT}, case
    when event_time > kafka_timestamp + interval {FUTURE_SECONDS} seconds then 'event time in the future'
    end)"""

ISO_TIME = "date_format(detected_at, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\")"


def decode_transactions(raw: DataFrame, *keep: str) -> DataFrame:
    """Message bytes to typed columns; unreadable messages become rows of nulls.

    ``raw`` has the layout of the Kafka source: ``key``, ``value``, ``timestamp``. Its columns
    ``keep`` stay as they are.
    """
    # ``inline`` makes the fields rows of a generator: filters on them stay above it, where
    # as parts of a struct each of them would parse the message once more.
    return raw.selectExpr(
        *keep,
        "cast(key as string) as message_key",
        "timestamp as kafka_timestamp",
        "cast(value as string) as message",
        f"inline(array(from_json(cast(value as string), '{ddl(TRANSACTION_FIELDS)}')))",
    ).selectExpr("*", "try_to_timestamp(timestamp) as event_time")


def parse_transactions(raw: DataFrame) -> DataFrame:
    """The messages that can be scored."""
    return decode_transactions(raw).where(f"({FAULT}) is null").drop("message_key", "message")


def quarantine(raw: DataFrame, fault: str = FAULT) -> DataFrame:
    """The messages that cannot be scored, with the reason and the message itself, to be read again after a fix."""
    return quarantined(decode_transactions(raw).selectExpr("*", f"{fault} as reason"))


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.where("reason is not null").selectExpr(
        "message_key as account_key", "kafka_timestamp", "reason", "message"
    )


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as key and JSON value, keyed by account."""
    fields = [f"{ISO_TIME} as detected_at" if name == "detected_at" else name for name in ALERT_FIELDS]
    return alerts.selectExpr("account_id as key", f"to_json(struct({', '.join(fields)})) as value")


def decode_alerts(raw: DataFrame) -> DataFrame:
    """JSON alerts back to columns; messages that cannot be read are left out."""
    decoded = raw.selectExpr(f"inline(array(from_json(cast(value as string), '{ddl(ALERT_FIELDS)}')))")
    fields = ["try_to_timestamp(detected_at) as detected_at" if name == "detected_at" else name for name in ALERT_FIELDS]
    return decoded.where("transaction_id is not null").selectExpr(*fields)
