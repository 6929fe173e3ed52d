"""Parameters of scoring, windows and skew handling."""

from __future__ import annotations

from dataclasses import dataclass

MICROS_PER_SECOND = 1_000_000

# The levels at which a score raises an alert and is called fraud.
ALERT_THRESHOLD = 0.65
FRAUD_THRESHOLD = 0.80

# Activity of an account is one session until it pauses longer than this.
SESSION_GAP_SECONDS = 300

# Windows and watermark of the velocity stream.
WINDOW_LENGTH = "5 minutes"
WINDOW_SLIDE = "1 minute"
WATERMARK = "30 seconds"

# Limits of the alert feeds.
HISTORY_PER_ACCOUNT = 100
HISTORY_HOURS = 24
FEED_SIZE = 500
RECENT_ALERTS = 200
FEED_ROWS = 25
FEED_RULES = 3
TOP_GROUPS = 8
TOP_RULES = 10

# Upper bounds of the cumulative histograms.
SCORE_BOUNDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
LATENCY_BOUNDS_MS = [5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0, 2500.0]


@dataclass(frozen=True)
class SkewConfig:
    """How finely the time lines of busy accounts are cut.

    A slice should have ``slice_rows`` rows, or more if the table has over ``max_slices`` times as many;
    accounts with more than about twice that are cut. The lists of their slices are broadcast if there are at
    most ``max_keys`` of them, and joined by a shuffle beyond that.
    """

    slice_rows: int = 20_000
    max_slices: int = 100_000
    max_keys: int = 1_024


DEFAULT_SKEW = SkewConfig()
