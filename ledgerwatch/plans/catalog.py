"""The registered queries, each a function of a session and a folder of parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.config import SkewConfig
from ledgerwatch.functions.columns import micros, rounded, text_list
from ledgerwatch.functions.rules import FIRED_RULES, RULE_SCORE, rule_hits
from ledgerwatch.functions.scores import score_transactions
from ledgerwatch.operators import alerts as al
from ledgerwatch.operators import analytics as an
from ledgerwatch.operators import detectors as de
from ledgerwatch.operators import percentiles as pc
from ledgerwatch.operators import quality as qu
from ledgerwatch.operators import sketches as sk
from ledgerwatch.operators import velocity as ve
from ledgerwatch.operators import windows as wi
from ledgerwatch.schema import ALERT_FIELDS, HIGH_RISK_CATEGORIES, ddl
from ledgerwatch.sources import events, messages

Query = Callable[[SparkSession, str], DataFrame]

KEY = ["transaction_id", "account_id"]

RULE_QUERIES = {
    "rule_high_amount": "HIGH_AMOUNT_3K",
    "rule_very_high_amount": "VERY_HIGH_AMOUNT_8K",
    "rule_high_risk_mcc": "HIGH_RISK_MCC",
    "rule_high_risk_country": "HIGH_RISK_COUNTRY",
    "rule_unknown_device": "UNKNOWN_DEVICE",
    "rule_micro_amount": "MICRO_AMOUNT_CARD_TEST",
    "rule_round_amount": "SUSPICIOUSLY_ROUND_AMOUNT",
}


JOINED_RULES = "array_join(rules_triggered, '|') as rules_triggered"
DETECTED_US = f"{micros()} + cast(round(latency_ms * 1000) as bigint)"


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ve.session_velocity(events.transactions(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_transactions(_features(spark, sf_dir))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    detected_at = f"cast(timestamp_micros({DETECTED_US}) as timestamp_ntz)"
    return al.raise_alerts(_scored(spark, sf_dir), "latency_ms", detected_at)


def _probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction is a probe: its truth and sending time are known."""
    return events.transactions(spark, sf_dir).selectExpr("transaction_id", "event_time as sent_at", "is_fraud")


def _flat(alerts: DataFrame) -> DataFrame:
    """Alerts with the rules as one text."""
    return alerts.selectExpr(*[JOINED_RULES if c == "rules_triggered" else c for c in alerts.columns])


def _zoneless(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.selectExpr(*[f"cast({c} as timestamp_ntz) as {c}" if c in columns else c for c in rows.columns])


def parse_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = messages.parse_transactions(events.messages(spark, sf_dir))
    return _zoneless(parsed, "event_time", "kafka_timestamp")


def quarantined_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless(messages.quarantine(events.messages(spark, sf_dir)), "kafka_timestamp").drop("message")


def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.transactions(spark, sf_dir).selectExpr(*KEY, f"{RULE_SCORE} as rule_score")


def rules_triggered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events.transactions(spark, sf_dir).selectExpr(*KEY, f"{FIRED_RULES} as rules_triggered")
    return rows.selectExpr(*KEY, "cast(size(rules_triggered) as bigint) as rule_count", JOINED_RULES)


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = "to_json(struct(account_id, country, is_fraud))"
    tagged = "concat(merchant_category, ':', country)"
    words = "array(merchant_category, country, device_type, currency)"
    return events.transactions(spark, sf_dir).selectExpr(
        "transaction_id",
        "cast(cast(account_id as binary) as string) as text_of_bytes",
        f"from_json({body}, 'account_id string, country string').country as json_field",
        "cast(try_to_timestamp(timestamp) as timestamp_ntz) as parsed_time",
        "least(amount, 100D) as at_most",
        "greatest(amount, 100D) as at_least",
        "amount % 100D = 0D as is_round",
        f"merchant_category in ({text_list(HIGH_RISK_CATEGORIES)}) as is_member",
        f"{tagged} as tagged",
        f"substring_index({tagged}, ':', 1) as head",
        "cast(bround(amount, 0) as bigint) as whole_amount",
        f"{rounded('amount / 7', 4)} as rounded",
        f"array_join(slice({words}, 1, 3), ', ') as first_words",
        "substring(timestamp, 1, 19) as first_chars",
        "concat('$', format_number(amount, 2)) as money",
        "coalesce(case when amount > 100D then amount end, 0D) as or_zero",
        f"{DETECTED_US} - {micros()} as apart_us",
    )


def velocity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).select(*KEY, "event_time", "amount", "window_count", "window_spend")


def velocity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select(*KEY, "window_count", "window_spend", "velocity_score")


def scored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).selectExpr(
        *KEY,
        "event_time",
        "amount",
        "window_count",
        "window_spend",
        "rule_score",
        "velocity_score",
        "fraud_score",
        JOINED_RULES,
    )


def alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published messages, read back field by field."""
    sent = messages.alert_messages(_alerts(spark, sf_dir))
    return _flat(sent.selectExpr("key", f"inline(array(from_json(value, '{ddl(ALERT_FIELDS)}')))"))


def account_alert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = events.transactions(spark, sf_dir).agg(F.max("event_time")).scalar()
    history = al.account_history(_alerts(spark, sf_dir), now)
    return history.selectExpr(
        "account_id", "cast(position as bigint) as position", "transaction_id", "fraud_score", "label", "detected_at"
    )


def live_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest alerts as a reader of the published messages sees them."""
    read_back = messages.decode_alerts(messages.alert_messages(_alerts(spark, sf_dir)))
    return _zoneless(_flat(al.recent_alerts(read_back)), "detected_at")


def probe_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qu.probe_latency(_probes(spark, sf_dir), _alerts(spark, sf_dir))


def _skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of the transactions with a third of the rows on one account, pauses of exactly the gap,
    and ties in time.
    """
    number = "cast(substring(transaction_id, 4) as bigint)"
    us = f"timestamp_micros(({micros()} div 300000000) * 300000000 + if({number} % 5 = 0, 0, {micros()} % 300000000))"
    changed = {
        "account_id": f"if({number} % 3 = 0, 'ACC000000', account_id) as account_id",
        "event_time": f"cast({us} as timestamp_ntz) as event_time",
    }
    rows = events.transactions(spark, sf_dir)
    return rows.selectExpr(*[changed.get(c, c) for c in rows.columns])


def skewed_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ve.session_velocity(_skewed(spark, sf_dir), SkewConfig(slice_rows=100))
    return rows.select(*KEY, "event_time", "amount", "window_count", "window_spend")


def _tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of the transactions with a third of the rows on one account, half of these in one microsecond and the
    others in three more, of which two lie exactly a gap apart.
    """
    number = "cast(substring(transaction_id, 4) as bigint)"
    at = f"1704070800000000 + element_at(array(0L, 300000000L, 600000001L, 900000000L), cast(greatest(1, {number} % 8 - 3) as int))"
    hot = f"{number} % 3 = 0"
    changed = {
        "account_id": f"if({hot}, 'ACC000000', account_id) as account_id",
        "event_time": f"if({hot}, cast(timestamp_micros({at}) as timestamp_ntz), event_time) as event_time",
    }
    rows = events.transactions(spark, sf_dir)
    return rows.selectExpr(*[changed.get(c, c) for c in rows.columns])


def tied_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ve.session_velocity(_tied(spark, sf_dir), SkewConfig(slice_rows=100))
    return rows.select(*KEY, "event_time", "amount", "window_count", "window_spend")


def tied_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ve.trailing_velocity(_tied(spark, sf_dir), SkewConfig(slice_rows=100))


def quantile_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per percentile of the latency: whether the value that merged sketches of every minute give has a rank within
    the stated error, and the exact count of values.
    """
    rows = events.transactions(spark, sf_dir)
    minutes = rows.groupBy(F.expr(f"{micros()} div 60000000 as minute")).agg(F.expr(f"{sk.quantile_summary('latency_ms')} as summary"))
    found = sk.quantiles(minutes, "summary", pc.INTERPOLATED).first()
    near = [
        f"struct('{name}' as metric, count_if(latency_ms < {found[name]!r}D) <= {p + sk.RANK_ERROR}D * count(latency_ms) "
        f"and count_if(latency_ms <= {found[name]!r}D) >= {p - sk.RANK_ERROR}D * count(latency_ms) as near)"
        for name, p in pc.INTERPOLATED.items()
    ]
    return rows.agg(F.expr(f"array({', '.join(near)}) as found")).selectExpr(f"{found.n}L as n", "inline(found)")


def repeated_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the detector when a topic delivers every third alert twice."""
    alerts = _alerts(spark, sf_dir)
    again = alerts.where("cast(substring(transaction_id, 4) as bigint) % 3 = 0").withColumn(
        "detected_at", F.expr("detected_at + interval 1 minute")
    )
    return qu.full_report(_probes(spark, sf_dir), alerts.unionByName(again))


def _on_transactions(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(events.transactions(spark, sf_dir))


def _on_alerts(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_alerts(spark, sf_dir))


def _on_scored(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_scored(spark, sf_dir))


def _on_probes(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_probes(spark, sf_dir), _alerts(spark, sf_dir))


def _on_latencies(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(probe_latency(spark, sf_dir))


def queries() -> dict[str, Query]:
    rule_queries = {
        query: _on_transactions(lambda rows, rule=rule: rule_hits(rows, rule)) for query, rule in RULE_QUERIES.items()
    }
    return {
        "parse_transactions": parse_transactions,
        "quarantined_messages": quarantined_messages,
        **rule_queries,
        "rule_scores": rule_scores,
        "rules_triggered": rules_triggered,
        "scalar_functions": scalar_functions,
        "velocity_features": velocity_features,
        "velocity_trailing": _on_transactions(ve.trailing_velocity),
        "velocity_windows": _on_transactions(wi.window_activity),
        "velocity_windows_approx": _on_transactions(wi.sketch_errors),
        "velocity_tumbling": _on_transactions(lambda rows: wi.window_activity(rows, slide_seconds=wi.LENGTH_SECONDS)),
        "account_sessions": _on_transactions(wi.account_sessions),
        "account_features": _on_transactions(wi.account_features),
        "velocity_scores": velocity_scores,
        "scored_transactions": scored_transactions,
        "alerts": _on_alerts(_flat),
        "alert_messages": alert_messages,
        "account_alert_history": account_alert_history,
        "live_feed": _on_alerts(lambda rows: _flat(al.live_feed(rows))),
        "live_alerts": live_alerts,
        "feed_rows": _on_alerts(al.feed_rows),
        "global_stats": _on_alerts(al.global_stats),
        "alert_kpis": _on_alerts(an.alert_kpis),
        "score_histogram": _on_alerts(an.score_histogram),
        "score_buckets": _on_scored(an.score_buckets),
        "latency_buckets": _on_transactions(an.latency_buckets),
        "pipeline_counters": _on_scored(an.pipeline_counters),
        "throughput": _on_transactions(an.throughput),
        "throughput_per_second": _on_transactions(an.throughput_per_second),
        "alerts_per_5s": _on_alerts(an.alerts_over_time),
        "top_categories": _on_alerts(lambda rows: an.top_groups(rows, "merchant_category")),
        "top_countries": _on_alerts(lambda rows: an.top_groups(rows, "country")),
        "top_accounts": _on_alerts(lambda rows: an.top_groups(rows, "account_id")),
        "heavy_accounts": _on_alerts(lambda rows: sk.heavy_groups(rows, "account_id", 0.01)),
        "heavy_merchants": _on_transactions(lambda rows: sk.heavy_groups(rows, "merchant_id", 0.005)),
        "heavy_categories": _on_alerts(lambda rows: sk.heavy_groups(rows, "merchant_category", 0.05)),
        "quantile_errors": quantile_errors,
        "rule_frequency": _on_alerts(an.rule_frequency),
        "latency_percentiles": _on_alerts(pc.latency_percentiles),
        "probe_latency": probe_latency,
        "probe_coverage": _on_probes(qu.probe_coverage),
        "confusion_matrix": _on_probes(qu.confusion_matrix),
        "classifier_report": _on_probes(qu.classifier_report),
        "full_report": _on_probes(qu.full_report),
        "repeated_alerts": repeated_alerts,
        "skewed_velocity": skewed_velocity,
        "tied_velocity": tied_velocity,
        "tied_trailing": tied_trailing,
        "latency_nearest_rank": _on_latencies(qu.latency_nearest_rank),
        "latency_summary": _on_latencies(qu.latency_summary),
        "geo_impossible": _on_transactions(de.geo_impossible),
        "card_testing": _on_transactions(de.card_testing),
        "night_owl": _on_transactions(de.night_owl),
        "velocity_abuse": lambda spark, sf_dir: de.velocity_abuse(_features(spark, sf_dir)),
        "spend_anomaly": _on_transactions(de.spend_anomaly),
        "device_switching": _on_transactions(de.device_switching),
        "rule_precision": _on_alerts(an.rule_precision),
    }
