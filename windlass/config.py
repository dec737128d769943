"""Options and fixed values.

Fixed values below must equal the behaviour being reproduced (operating
parameters of the windowed-state library and of its sample program).
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------
# restore: fetch a remote snapshot only if local + threshold < remote (strict)
RESTORE_OFFSET_THRESHOLD = 10_000
# snapshot on average once per this many flushes
DEFAULT_SNAPSHOT_FREQUENCY = 20
# a task counts as caught up within this many offsets
ACCEPTABLE_RECOVERY_LAG = 10_000
# sample program: tumbling window of 1,000,000 seconds, no grace
SAMPLE_WINDOW_SECONDS = 1_000_000
SAMPLE_GRACE_SECONDS = 0
# sample program: source topic and application id
SAMPLE_TOPIC = "order"
SAMPLE_APPLICATION_ID = "global-stores-test"
# source rate limits of the sample program
MAX_POLL_RECORDS = 100_000
MAX_PARTITION_FETCH_BYTES = 50 * 1024 * 1024
# segmented stores: segment interval = max(retention / 2, 60 s)
MIN_SEGMENT_INTERVAL_SECONDS = 60
# listener event names, in callback order
TASK_EVENTS = (
    "restore_start",
    "batch_restored",
    "restore_end",
    "restore_suspended",
    "standby_start",
    "standby_batch",
    "standby_suspended",
)
# --- end of fixed values ----------------------------------------------------

# Test-fixture parameters (FIXTURES.md): how RECORD is cut out of `events`.
FIXTURE_PARTITIONS = 4
FIXTURE_LATE_EVERY = 17
FIXTURE_LATE_SHIFT_HOURS = 2

# The windowed store the fixture pipeline keeps: 1 hour tumbling, grace 0,
# retention 1 day (so segments are 12 hours).
STORE_NAME = "agg-store"
STORE_WINDOW_SECONDS = 3_600
STORE_GRACE_SECONDS = 0
STORE_RETENTION_SECONDS = 86_400

# Rows of one group that a single window-function partition may hold before
# a running computation is split into blocks (see operators/scan.py).
DEFAULT_BLOCK_SPAN = 1 << 20


def segment_interval_seconds(retention_seconds: int) -> int:
    return max(retention_seconds // 2, MIN_SEGMENT_INTERVAL_SECONDS)


def changelog_topic(app_id: str, store: str) -> str:
    return f"{app_id}-{store}-changelog"


@dataclass(frozen=True)
class SnapshotOptions:
    """Where and how often windowed state is snapshotted.

    ``path`` is any Hadoop filesystem URI (``s3a://bucket/prefix``,
    ``hdfs://...``); bucket, region and endpoint belong to the Hadoop
    filesystem configuration, not here.
    """

    path: str
    app_id: str
    store: str = STORE_NAME
    every_n: int = DEFAULT_SNAPSHOT_FREQUENCY
    threshold: int = RESTORE_OFFSET_THRESHOLD
    segment_seconds: int = segment_interval_seconds(STORE_RETENTION_SECONDS)
    retention_seconds: int | None = None
    max_records_per_file: int = 5_000_000
