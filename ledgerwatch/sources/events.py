"""Transactions and messages derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.functions.columns import micros, text, text_list
from ledgerwatch.schema import TRANSACTION_FIELDS

# The value lists from which the events get their attributes.
CATEGORIES = [
    "GROCERY", "ELECTRONICS", "TRAVEL", "RESTAURANT", "FUEL", "PHARMACY",
    "ENTERTAINMENT", "GAMBLING", "CRYPTO_EXCHANGE", "MONEY_TRANSFER", "ATM", "RETAIL",
]
COUNTRIES = ["US", "GB", "DE", "BR", "NG", "RO", "CN", "PK", "VN", "FR"]
DEVICES = ["mobile_ios", "mobile_android", "desktop_chrome", "desktop_safari", "api_key", "unknown"]
TYPES = {"purchase": "PURCHASE", "signup": "PURCHASE", "click": "TRANSFER", "view": "WITHDRAWAL", "error": "REFUND"}

# Start of the events, and the factor by which their time line is shortened so that
# accounts have sessions.
EPOCH_US = 1_704_067_200_000_000
TIME_FACTOR = 300


def _pick(values: list[str], position: str) -> str:
    return f"element_at(array({text_list(values)}), cast({position} + 1 as int))"


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table seen as card transactions, one row each.

    ``latency_ms`` carries the time to detection that an alert on the row reports.
    """
    kinds = " ".join(f"when {text(name)} then {text(kind)}" for name, kind in TYPES.items())
    elapsed = f"({micros('ts')} - {EPOCH_US}) div {TIME_FACTOR}"
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "*",
        "cast(get_json_object(props, '$.k') as bigint) as k",
        f"cast(timestamp_micros({EPOCH_US} + {elapsed}) as timestamp_ntz) as event_time",
        f"{_pick(COUNTRIES, '(event_id div 12) % 10')} as country",
    )
    return events.selectExpr(
        "concat('TXN', lpad(event_id, 10, '0')) as transaction_id",
        "concat('ACC', lpad(user_id, 6, '0')) as account_id",
        "concat('MER', lpad(event_id % 200 + 1, 5, '0')) as merchant_id",
        # ``k`` is named once, so a filter on the amount reads the JSON once per mention.
        """cast(cast(coalesce(get(array(cast(floor(value) * 100 as double), value * 20), cast(k % 10 as int)), value)
           as decimal(18,2)) as double) as amount""",
        "'USD' as currency",
        f"case event_type {kinds} end as transaction_type",
        f"{_pick(CATEGORIES, 'event_id % 12')} as merchant_category",
        "country",
        "concat(country, '-CITY') as city",
        f"{_pick(DEVICES, '(event_id div 120) % 6')} as device_type",
        "concat('10.0.', (event_id div 250) % 250, '.', event_id % 250) as ip_address",
        "date_format(event_time, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\") as timestamp",
        "k < 2 as is_fraud",
        "event_time",
        "value as latency_ms",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same transactions as message bytes; every 97th message is cut in half.

    The messages carry a field that the schema does not know, as producers do.
    """
    rows = transactions(spark, sf_dir).selectExpr(
        "*",
        f"to_json(struct({', '.join(TRANSACTION_FIELDS)}, 'none' as fraud_pattern)) as body",
        "cast(substring(transaction_id, 4) as bigint) as number",
    )
    return rows.selectExpr(
        "cast(account_id as binary) as key",
        "cast(case when number % 97 = 0 then substring(body, 1, length(body) div 2) else body end as binary) as value",
        "cast(event_time as timestamp) as timestamp",
    )
