"""Run the scoring stream and the velocity monitor in one session.

    PYSPARK_SUBMIT_ARGS="--packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 pyspark-shell" \\
        python -m ledgerwatch.streaming --servers broker:9092 --output /shared/risk
"""

from __future__ import annotations

import argparse
from functools import partial

from ledgerwatch.config import ALERT_THRESHOLD
from ledgerwatch.session import build_session
from ledgerwatch.sources.messages import parse_transactions
from ledgerwatch.sources.streams import ALERT_TOPIC, MESSAGES_PER_BATCH, TOPIC, publish, source
from ledgerwatch.streaming.lifecycle import run_until_one_ends
from ledgerwatch.streaming.scoring import ScoringJob, start_scoring
from ledgerwatch.streaming.velocity import start_monitor, window_monitor


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--output", required=True, help="folder of the scored, alerts and state tables")
    parser.add_argument("--servers", help="Kafka servers; without them messages are read from --files")
    parser.add_argument("--topic", default=TOPIC)
    parser.add_argument("--alert-topic", default=ALERT_TOPIC)
    parser.add_argument("--per-batch", type=int, default=MESSAGES_PER_BATCH)
    parser.add_argument("--files", help="folder of message files")
    parser.add_argument("--threshold", type=float, default=ALERT_THRESHOLD)
    return parser.parse_args()


def main() -> None:
    options = arguments()
    spark = build_session()
    if options.servers:
        kind, where = "kafka", {"servers": options.servers, "topic": options.topic, "per_batch": options.per_batch}
        send = partial(publish, servers=options.servers, topic=options.alert_topic)
    else:
        kind, where, send = "files", {"path": options.files}, None
    job = ScoringJob(options.output, threshold=options.threshold, publish=send)
    scoring = start_scoring(source(spark, kind, **where), job)
    monitor = start_monitor(window_monitor(parse_transactions(source(spark, kind, **where))))
    run_until_one_ends(spark, [scoring, monitor])


if __name__ == "__main__":
    main()
