"""Parameters with the reference job's default values."""

# Fixed values (must equal the reference job's defaults):
# score weights for growth, long-term ratio, share of total, volatility, acceleration
DEFAULT_WEIGHTS = (0.4, 0.2, 0.2, 0.1, 0.1)
# a series point alerts when its score is strictly above this
ALERT_THRESHOLD = 2.0
# growth a point must exceed to count towards the duration flag
DURATION_THRESHOLD = 2.0
# collection cadence: one snapshot every 30 minutes
SNAPSHOT_MINUTES = 30
# rows per search query a collector keeps per batch
QUERY_CAP = 400
# rolling-window widths of the metrics (rows before the current one)
LONG_TERM_ROWS = 3
VOLATILITY_ROWS = 6

# Our own limits (not from the reference).
# Largest wordbag matched through an in-plan literal set; bigger bags go
# through a join on exploded tokens instead.
LITERAL_KEYWORD_LIMIT = 2048
# Largest wordbag (bytes) that may be broadcast to every executor.
BROADCAST_BAG_BYTES = 64 << 20
