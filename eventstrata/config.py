"""Business rules of the event stream, in one frozen object that every operator reads."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class EventType:
    name: str
    rank: int  # order among events of one entity that share an event time
    milestone: str  # lifecycle column holding the first time this type was seen
    terminal: bool = False


# Event vocabulary, reject reasons, keys, threshold and output layout.
EVENT_TYPES = (
    EventType("ORDER_CREATED", 1, "created_at"),
    EventType("RIDER_ALLOCATED", 2, "first_allocated_at"),
    EventType("RIDER_ACCEPTED", 3, "accepted_at"),
    EventType("STARTED_PICKUP", 4, "started_pickup_at"),
    EventType("DELIVERED", 5, "delivered_at", terminal=True),
    EventType("CANCELLED", 6, "cancelled_at", terminal=True),
)
UNPARSEABLE_JSON = "UNPARSEABLE_JSON"
MISSING_EVENT_ID = "MISSING_EVENT_ID"
MISSING_ORDER_ID = "MISSING_ORDER_ID"
UNKNOWN_EVENT_TYPE = "UNKNOWN_EVENT_TYPE"
INVALID_EVENT_TIME = "INVALID_EVENT_TIME"
INVALID_INGESTED_AT = "INVALID_INGESTED_AT"
REJECT_REASONS = (
    UNPARSEABLE_JSON,
    MISSING_EVENT_ID,
    MISSING_ORDER_ID,
    UNKNOWN_EVENT_TYPE,
    INVALID_EVENT_TIME,
    INVALID_INGESTED_AT,
)
PAYLOAD_FIELDS = (
    "event_id",
    "order_id",
    "event_type",
    "event_time",
    "ingested_at",
    "city",
    "rider_id",
    "supplier_id",
)
TIMESTAMP_FIELDS = ("event_time", "ingested_at")
EXACT_KEY = ("event_id",)
SEMANTIC_KEY = ("order_id", "event_type", "event_time", "rider_id", "supplier_id")
LATENESS_THRESHOLD_SECONDS = 300
STATUSES = ("DELIVERED", "CANCELLED", "OPEN")
LAYOUT = {
    "bronze": "bronze/events.parquet",
    "silver": "silver/events.parquet",
    "quarantine": "quarantine/rejected_events.parquet",
    "orders": "gold/orders.parquet",
    "daily": "gold/daily_metrics.parquet",
    "report": "report.json",
}

# A vocabulary travels to every task as a broadcast, so its size is bounded here.
MAX_EVENT_TYPES = 10_000


@dataclass(frozen=True)
class StreamConfig:
    event_types: tuple[EventType, ...] = EVENT_TYPES
    fields: tuple[str, ...] = PAYLOAD_FIELDS
    exact_key: tuple[str, ...] = EXACT_KEY
    semantic_key: tuple[str, ...] = SEMANTIC_KEY
    lateness_threshold_seconds: int = LATENESS_THRESHOLD_SECONDS
    compression: str = "zstd"
    layout: dict[str, str] = field(default_factory=lambda: dict(LAYOUT))
    # "total" sorts Bronze by file and line, as published; "scan" writes it without a shuffle,
    # in order inside a file only.
    bronze_order: str = "total"
    # "replace" overwrites the layers at their paths, one after the other; "generations" writes
    # them to new folders that one manifest makes visible together.
    publish: str = "replace"
    # Payload bytes per partition of sorted Bronze; small inputs are dealt to all cores down to
    # the second figure.
    partition_bytes: int = 256 << 20
    min_partition_bytes: int = 1 << 20
    # Above this many input blocks (500 TB in blocks of 128 MB) the line offsets are joined by
    # shuffle, not broadcast. A block is six longs, some 80 bytes in the broadcast table.
    max_broadcast_blocks: int = 4_000_000
    # Above this many touched orders their events are found by a salted join, not a broadcast.
    max_broadcast_ids: int = 1_000_000
    # Hash buckets of the order store: a refresh reads and rewrites whole buckets. At 100 TB some
    # ten thousand keep a bucket in a few files.
    order_buckets: int = 64
    # Types that the lifecycle and cohort metrics refer to by role.
    creation: str = "ORDER_CREATED"
    allocation: str = "RIDER_ALLOCATED"
    acceptance: str = "RIDER_ACCEPTED"
    success: str = "DELIVERED"
    abort: str = "CANCELLED"

    def __post_init__(self) -> None:
        names = [t.name for t in self.event_types]
        if len(set(names)) != len(names):
            raise ValueError(f"event types must be unique: {sorted(names)}")
        if len(names) > MAX_EVENT_TYPES:
            raise ValueError(f"at most {MAX_EVENT_TYPES} event types, got {len(names)}")
        if self.bronze_order not in ("scan", "total"):
            raise ValueError(f"bronze_order must be 'scan' or 'total', got {self.bronze_order!r}")
        if self.publish not in ("replace", "generations"):
            raise ValueError(f"publish must be 'replace' or 'generations', got {self.publish!r}")
        missing = [f for f in PAYLOAD_FIELDS if f not in self.fields]
        if missing or len(set(self.fields)) != len(self.fields):
            raise ValueError(f"fields must be unique and include {PAYLOAD_FIELDS}, got {self.fields}")
        for role in (self.creation, self.allocation, self.acceptance, self.success, self.abort):
            if role not in names:
                raise ValueError(f"role type {role!r} is not in the vocabulary")

    def milestone(self, event_type: str) -> str:
        return next(t.milestone for t in self.event_types if t.name == event_type)

    @property
    def identifiers(self) -> tuple[str, ...]:
        return tuple(f for f in self.fields if f not in TIMESTAMP_FIELDS)


DEFAULT = StreamConfig()
