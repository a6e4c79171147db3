"""One registered query per operator, over the delivery stream derived from ``events``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstrata import config as C
from eventstrata.catalog import delivery_stream
from eventstrata.config import DEFAULT, EventType
from eventstrata.functions.rates import safe_rate
from eventstrata.functions.text import strip_carriage_returns
from eventstrata.operators import compare, incremental, layout, monitors, quality, sketches
from eventstrata.operators import lifecycle as life
from eventstrata.operators.cohort import DAILY_COUNTS, daily_counts, daily_metrics
from eventstrata.operators.dedup import (
    SILVER_COLUMNS,
    SILVER_KEYS,
    dedup_input,
    drop_exact,
    drop_semantic,
    keep_first,
    silver_with_counts,
    to_silver,
)
from eventstrata.operators.order_store import OrderStore
from eventstrata.operators.prints import PrintedTable, printed_differences
from eventstrata.operators.validate import (
    match_vocabulary,
    normalize,
    rejected,
    slim,
    valid,
    validate,
)
from eventstrata.plans.job import REPORT_SCHEMA, run
from eventstrata.session import configure, scratch_path, stage
from eventstrata.sinks import tables
from eventstrata.sinks.generations import Generations
from eventstrata.sources.lines import (
    BRONZE_KEYS,
    land_files,
    land_rows,
    number_lines,
    payload_lines,
    scan_lines,
)
from eventstrata.sources.vocabulary import vocabulary
from eventstrata.streaming import events as streams
from eventstrata.streaming import state

# Query parameters shared with the expected SQL.
HISTORY_END = dt.datetime(2024, 1, 25)
OVERLAP_START = dt.datetime(2024, 1, 20)
INDEX_SINCE = dt.date(2024, 1, 18)
IDLE_HOURS = 240
ALLOWED_SECONDS = 120
HORIZON_DAYS = 60
PERCENTILES = (0.5, 0.9, 0.99)
ORDER_FIELDS = (
    "final_status",
    "allocation_attempts",
    "unique_riders",
    "city",
    "supplier_id",
    "event_count",
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


class Layers:
    """The layers of one stream; what several branches read is staged once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    @cached_property
    def payloads(self) -> DataFrame:
        return delivery_stream.payloads(self.spark, self.sf_dir)

    @cached_property
    def facts(self) -> DataFrame:
        return delivery_stream.facts(self.spark, self.sf_dir)

    @cached_property
    def files(self) -> str:
        return delivery_stream.write_landing_files(self.spark, self.sf_dir)

    @cached_property
    def lines(self) -> DataFrame:
        return scan_lines(self.spark, self.files).withColumn(
            "shard", F.regexp_extract("_path", r"shard=(\d+)", 1).cast("long")
        )

    @cached_property
    def bronze(self) -> DataFrame:
        return land_rows(self.payloads)

    @cached_property
    def validated(self) -> DataFrame:
        return validate(self.bronze)

    @cached_property
    def rows(self) -> DataFrame:
        return stage(slim(self.validated), scratch_path(self.spark, "validated"))

    @cached_property
    def typed(self) -> DataFrame:
        """Valid rows; from the staged ones where a query has staged them already."""
        return dedup_input(valid(self.__dict__.get("rows", self.validated)))

    @cached_property
    def counted_silver(self) -> DataFrame:
        return silver_with_counts(self.typed)

    @cached_property
    def silver(self) -> DataFrame:
        return stage(self.counted_silver, scratch_path(self.spark, "silver"))

    @cached_property
    def orders(self) -> DataFrame:
        return life.reconstruct(self.silver)

    @cached_property
    def published(self) -> str:
        output = scratch_path(self.spark, "published")
        run(self.spark, self.files, output)
        return output


def query(build: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    REGISTRY[build.__name__.rstrip("_")] = lambda spark, sf_dir: build(Layers(spark, sf_dir))
    return build


# Landing


def _by_folder(rows: DataFrame) -> DataFrame:
    """Lineage without the file names that the writer of the landing files drew: one file per shard."""
    return rows.withColumn("_source_file", F.regexp_extract("_source_file", r"^(.*)/[^/]+$", 1))


@query
def bronze_scan(x: Layers) -> DataFrame:
    return x.lines.select(
        "shard", F.md5("value").alias("line_digest"), F.length("value").cast("long").alias("chars")
    )


@query
def bronze_crlf_trim(x: Layers) -> DataFrame:
    cleaned = x.lines.withColumn("_raw_payload", strip_carriage_returns(F.col("value")))
    return cleaned.select(
        "shard", "_raw_payload", (F.col("_raw_payload") != F.col("value")).alias("stripped")
    )


@query
def bronze_nonblank_filter(x: Layers) -> DataFrame:
    return payload_lines(x.lines).select("shard", "_raw_payload")


@query
def bronze_source_file(x: Layers) -> DataFrame:
    return payload_lines(x.lines).groupBy("shard").agg(
        F.count_distinct("_source_file").alias("files"),
        F.count_if(~F.col("_source_file").rlike("^shard=[0-9]+/[^/]+$")).alias("not_below_input"),
        F.count("*").alias("payloads"),
    )


@query
def bronze_source_row(x: Layers) -> DataFrame:
    return number_lines(payload_lines(x.lines)).select("shard", "_source_row", "_raw_payload")


@query
def bronze_events(x: Layers) -> DataFrame:
    return _by_folder(land_files(x.spark, x.files))


@query
def ref_event_types(x: Layers) -> DataFrame:
    seen = x.facts.groupBy("event_type").agg(F.count("*").alias("events"))
    return vocabulary(x.spark).join(seen, "event_type", "left")


@query
def json_valid_flag(x: Layers) -> DataFrame:
    return x.bronze.select(*BRONZE_KEYS, "_is_valid_json")


@query
def json_field_extract(x: Layers) -> DataFrame:
    return x.bronze.select(*BRONZE_KEYS, *C.PAYLOAD_FIELDS)


# Validation


@query
def normalize_identifiers(x: Layers) -> DataFrame:
    return normalize(x.bronze).select(*BRONZE_KEYS, *DEFAULT.identifiers)


@query
def parse_timestamps(x: Layers) -> DataFrame:
    return normalize(x.bronze).select(
        *BRONZE_KEYS, "event_time_raw", "ingested_at_raw", "event_time", "ingested_at"
    )


@query
def vocab_left_join(x: Layers) -> DataFrame:
    return match_vocabulary(normalize(x.bronze)).select(
        *BRONZE_KEYS, "event_type", "lifecycle_rank"
    )


@query
def validate_events(x: Layers) -> DataFrame:
    return x.validated.drop("_payload_md5")


def _reject_query(code: str) -> None:
    def build(x: Layers) -> DataFrame:
        wanted = rejected(x.validated).where(F.col("reject_reason") == code)
        return wanted.select(*BRONZE_KEYS, "event_id", "order_id", "event_type", "_raw_payload")

    build.__name__ = f"reject_{code.lower()}"
    query(build)


for _code in C.REJECT_REASONS:
    _reject_query(_code)


@query
def quarantine_events(x: Layers) -> DataFrame:
    return rejected(x.validated)


@query
def valid_events(x: Layers) -> DataFrame:
    return x.typed


# Deduplication and Silver


@query
def dedup_exact(x: Layers) -> DataFrame:
    return drop_exact(x.typed).withColumnRenamed("_copies", "copies")


@query
def dedup_semantic(x: Layers) -> DataFrame:
    return (
        drop_semantic(drop_exact(x.typed))
        .withColumnRenamed("_exact_survivors", "copies")
        .withColumnRenamed("_valid_rows", "valid_rows")
    )


@query
def keep_first_lineitem(x: Layers) -> DataFrame:
    items = x.spark.read.parquet(f"{x.sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"
    )
    order = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    return keep_first(items, ("l_orderkey", "l_linenumber"), order, "copies").drop("l_shipdate")


@query
def silver_events(x: Layers) -> DataFrame:
    return x.counted_silver.select(*SILVER_COLUMNS)


@query
def silver_sorted(x: Layers) -> DataFrame:
    return x.counted_silver.select(*SILVER_COLUMNS).orderBy(*SILVER_KEYS)


@query
def lateness_seconds(x: Layers) -> DataFrame:
    return x.counted_silver.select("event_id", "event_time", "ingested_at", "lateness_seconds")


@query
def late_events(x: Layers) -> DataFrame:
    return x.counted_silver.where("is_late").select(
        "event_id", "order_id", "event_date", "lateness_seconds"
    )


# Orders


@query
def lifecycle_rank_join(x: Layers) -> DataFrame:
    return life.with_rank(x.counted_silver).select("event_id", "event_type", "lifecycle_rank")


@query
def order_milestones(x: Layers) -> DataFrame:
    return x.counted_silver.groupBy("order_id").agg(*life.milestones())


@query
def allocation_attempts(x: Layers) -> DataFrame:
    return x.counted_silver.groupBy("order_id").agg(life.attempts().alias("allocation_attempts"))


@query
def unique_riders(x: Layers) -> DataFrame:
    return life.riders_per_order(x.counted_silver)


@query
def order_city(x: Layers) -> DataFrame:
    ranked = life.with_rank(x.counted_silver)
    return ranked.groupBy("order_id").agg(life.first_city().alias("city"))


@query
def order_latest_supplier(x: Layers) -> DataFrame:
    ranked = life.with_rank(x.counted_silver)
    return ranked.groupBy("order_id").agg(life.last_supplier().alias("supplier_id"))


@query
def order_event_count(x: Layers) -> DataFrame:
    return x.counted_silver.groupBy("order_id").agg(F.count("*").alias("event_count"))


@query
def order_final_status(x: Layers) -> DataFrame:
    reached = x.counted_silver.groupBy("order_id").agg(*life.milestones())
    return reached.select(
        "order_id", "delivered_at", "cancelled_at", life.final_status().alias("final_status")
    )


@query
def gold_orders(x: Layers) -> DataFrame:
    return x.orders


@query
def orders_by_status(x: Layers) -> DataFrame:
    return x.orders.groupBy("final_status").agg(F.count("*").alias("orders"))


@query
def orders_missing_created_at(x: Layers) -> DataFrame:
    return x.orders.agg(F.count_if(F.col("created_at").isNull()).alias("orders_missing_created_at"))


@query
def orders_grain_check(x: Layers) -> DataFrame:
    return quality.grain(x.orders)


@query
def status_contradictions(x: Layers) -> DataFrame:
    return quality.status_violations(x.orders)


@query
def rider_attempt_check(x: Layers) -> DataFrame:
    return quality.rider_violations(x.orders)


# Daily metrics


@query
def daily_counts_(x: Layers) -> DataFrame:
    return daily_counts(x.orders)


@query
def avg_allocation_attempts(x: Layers) -> DataFrame:
    return daily_metrics(x.orders).select("date", "avg_allocation_attempts")


@query
def null_safe_rates(x: Layers) -> DataFrame:
    return daily_metrics(x.orders).select("date", "fulfilment_rate", "acceptance_rate")


@query
def daily_metrics_(x: Layers) -> DataFrame:
    return daily_metrics(x.orders)


@query
def daily_total_created(x: Layers) -> DataFrame:
    return daily_metrics(x.orders).agg(F.sum("orders_created").alias("total_created"))


@query
def rate_domain_check(x: Layers) -> DataFrame:
    return quality.rate_violations(daily_metrics(x.orders))


@query
def cohort_rates_orders(x: Layers) -> DataFrame:
    sales = x.spark.read.parquet(f"{x.sf_dir}/orders.parquet")
    shipped = F.count_if(F.col("o_orderstatus") == "F")
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT")
    return sales.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.count("*").alias("orders"),
        safe_rate(shipped, F.count("*")).alias("shipped_rate"),
        safe_rate(shipped, urgent).alias("shipped_per_urgent"),
    )


# Counts, reconciliation, comparisons


@query
def rejections_by_reason(x: Layers) -> DataFrame:
    return rejected(x.validated).groupBy("reject_reason").agg(F.count("*").alias("events"))


@query
def layer_counts(x: Layers) -> DataFrame:
    landed = quality.long_form(
        quality.landing_counts(x.rows), "raw_events", "rejected_events", "valid_events"
    )
    silver = quality.long_form(
        quality.silver_counts(x.silver), "silver_events", "duplicate_events_removed", "late_events"
    )
    orders = quality.long_form(
        quality.order_counts(x.orders),
        "unique_orders",
        "orders_missing_created_at",
        "reporting_days",
    )
    return landed.unionByName(silver).unionByName(orders)


@query
def reconciliation(x: Layers) -> DataFrame:
    """The lines that arrived against the tables that a run published."""
    lines = payload_lines(x.lines).agg(F.count("*")).scalar()
    stored = {name: _published(x, name).agg(F.count("*")).scalar() for name in ("bronze", "quarantine", "silver")}
    accounted = stored["silver"] + stored["quarantine"] + F.col("duplicate_events_removed")
    counted = _report(x).select(lines.alias("raw_events"), stored["bronze"].alias("_bronze"), accounted.alias("accounted_events"))
    balanced = (F.col("raw_events") == F.col("accounted_events")) & (F.col("raw_events") == F.col("_bronze"))
    return counted.select("raw_events", "accounted_events", balanced.alias("balanced"))


@query
def duplicates_by_class(x: Layers) -> DataFrame:
    return quality.silver_counts(x.counted_silver).select(
        "exact_duplicates_removed", "semantic_duplicates_removed", "duplicate_events_removed"
    )


@query
def late_event_rate(x: Layers) -> DataFrame:
    return quality.silver_counts(x.counted_silver).select(
        "silver_events", "late_events", "late_event_rate"
    )


@query
def quarantine_completeness(x: Layers) -> DataFrame:
    return quality.quarantine_gaps(rejected(x.validated))


@query
def daily_vs_orders_diff(x: Layers) -> DataFrame:
    on_time = life.reconstruct(x.silver.where(~F.col("is_late")))
    return compare.field_differences(
        daily_counts(x.orders), daily_counts(on_time), "date", DAILY_COUNTS
    )


def _true_and_naive_orders(x: Layers) -> tuple[DataFrame, DataFrame]:
    """Orders, and orders from events that went through the exact stage only; both from one run of it."""
    exact = stage(drop_exact(x.typed), scratch_path(x.spark, "exact"))
    alone = exact.withColumns({"_valid_rows": F.col("_copies"), "_exact_survivors": F.lit(1)})
    silver = stage(to_silver(drop_semantic(exact)), scratch_path(x.spark, "silver"))
    naive = stage(to_silver(alone), scratch_path(x.spark, "exact-only"))
    return life.reconstruct(silver), life.reconstruct(naive)


@query
def orders_field_diff(x: Layers) -> DataFrame:
    return compare.field_differences(*_true_and_naive_orders(x), "order_id", ORDER_FIELDS)


@query
def orders_printed_diff(x: Layers) -> DataFrame:
    """The same differences through stored fingerprints, which name the buckets to join."""
    sides = [PrintedTable(x.spark, scratch_path(x.spark, "printed"), "order_id", 6) for _ in range(2)]
    for side, orders in zip(sides, _true_and_naive_orders(x)):
        side.write(orders)
    return printed_differences(*sides, ORDER_FIELDS)


@query
def orders_membership_diff(x: Layers) -> DataFrame:
    created = x.facts.where(F.col("event_type") == DEFAULT.creation)
    return compare.membership_differences(
        x.orders.where(F.col("created_at").isNotNull()), created, ["order_id"]
    )


@query
def silver_key_diff(x: Layers) -> DataFrame:
    return compare.membership_differences(x.counted_silver, x.facts, C.SEMANTIC_KEY)


@query
def table_fingerprint(x: Layers) -> DataFrame:
    micros = {
        c: F.unix_micros(F.col(c).cast("timestamp"))
        for c in [t.milestone for t in DEFAULT.event_types]
    }
    return compare.fingerprint(x.orders.withColumns(micros))


# Sinks and full runs


@query
def parquet_roundtrip(x: Layers) -> DataFrame:
    path = scratch_path(x.spark, "roundtrip")
    tables.write_scan_order(x.counted_silver.select(*SILVER_COLUMNS), path)
    stored = x.spark.read.parquet(path).where(F.col("event_type") == DEFAULT.success)
    return stored.select("order_id", "event_id", "event_time")


@query
def sink_silver_roundtrip(x: Layers) -> DataFrame:
    path = scratch_path(x.spark, "sorted")
    silver = x.counted_silver.select(*SILVER_COLUMNS)
    tables.write_ordered(silver, path, SILVER_KEYS)
    return x.spark.read.schema(silver.schema).parquet(path)


@query
def sink_partitioned_roundtrip(x: Layers) -> DataFrame:
    path = scratch_path(x.spark, "by-date")
    silver = x.counted_silver.select(*SILVER_COLUMNS)
    tables.write_by_date(silver, path, "event_date", SILVER_KEYS)
    return x.spark.read.schema(silver.schema).parquet(path)


def _published(x: Layers, layer: str) -> DataFrame:
    return x.spark.read.parquet(f"{x.published}/{C.LAYOUT[layer]}")


@query
def published_bronze(x: Layers) -> DataFrame:
    """With lineage, and the place at which each row lies in the files."""
    return _by_folder(layout.with_position(_published(x, "bronze")))


@query
def published_silver(x: Layers) -> DataFrame:
    return _by_folder(layout.with_position(_published(x, "silver")))


@query
def published_quarantine(x: Layers) -> DataFrame:
    return _by_folder(layout.with_position(_published(x, "quarantine")))


@query
def physical_order(x: Layers) -> DataFrame:
    keys = {"bronze": BRONZE_KEYS, "quarantine": BRONZE_KEYS, "silver": SILVER_KEYS, "orders": life.ORDER_KEYS}
    checks = [
        layout.physical_order(_published(x, name), key).withColumn("layer", F.lit(name))
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, checks)


@query
def published_orders(x: Layers) -> DataFrame:
    return _published(x, "orders")


@query
def published_daily(x: Layers) -> DataFrame:
    return _published(x, "daily")


@query
def published_generation(x: Layers) -> DataFrame:
    """Orders as readers of the newest generation see them, after two runs over one output."""
    output, config = scratch_path(x.spark, "generations"), replace(DEFAULT, publish="generations")
    run(x.spark, x.files, output, config)
    first = Generations(x.spark, output).layers()
    run(x.spark, x.files, output, config)
    store = Generations(x.spark, output)
    moved = all(first[name] != path for name, path in store.layers().items())
    return store.read("orders").withColumn("generation", F.lit(store.numbers()[-1])).withColumn("moved", F.lit(moved))


def _report(x: Layers) -> DataFrame:
    return x.spark.read.schema(REPORT_SCHEMA).json(f"{x.published}/{C.LAYOUT['report']}")


@query
def run_report(x: Layers) -> DataFrame:
    report = _report(x)
    plain = [name for name in quality.REPORT_FIELDS if name != "rejected_by_reason"]
    reasons = report.select(F.explode("rejected_by_reason").alias("metric", "value"))
    return quality.long_form(report, *plain).unionByName(
        reasons.select("metric", F.col("value").cast("double"))
    )


# Incremental upkeep


@query
def incremental_dedup_anti(x: Layers) -> DataFrame:
    x.rows
    history = drop_exact(x.typed.where(F.col("ingested_at") < F.lit(HISTORY_END)))
    index = history.select("event_id", F.to_date("event_time").alias("event_date"))
    path = scratch_path(x.spark, "id-index")
    tables.write_by_date(index, path, "event_date", ["event_id"])
    stored = x.spark.read.schema(index.schema).parquet(path)
    ranges = stage(incremental.id_ranges(stored), scratch_path(x.spark, "id-ranges"))
    batch = x.typed.where(F.col("ingested_at") >= F.lit(OVERLAP_START))
    return incremental.unseen_events(batch, stored, INDEX_SINCE, ranges=ranges).select(
        "event_id", "order_id", "event_type", "event_time", F.col("_copies").alias("copies")
    )


@query
def restate_affected_dates(x: Layers) -> DataFrame:
    silver = x.silver.select(*SILVER_COLUMNS)
    late = F.col("ingested_at") >= F.lit(HISTORY_END)
    path = scratch_path(x.spark, "restated")
    tables.write_by_date(silver.where(~late), path, "event_date", SILVER_KEYS)
    stored = x.spark.read.schema(silver.schema).parquet(path)
    new = silver.where(late)
    whole = tables.rows_of_dates(stored, new).unionByName(new)
    tables.restate_dates(whole, path, "event_date", SILVER_KEYS)
    return x.spark.read.schema(silver.schema).parquet(path)


@query
def gold_orders_incremental(x: Layers) -> DataFrame:
    """History and a batch through the bucketed store, which rebuilds only the batch's orders."""
    new = F.col("ingested_at") >= F.lit(HISTORY_END)
    silver = x.silver.select(*SILVER_COLUMNS)
    store = OrderStore(x.spark, scratch_path(x.spark, "order-store"))
    store.load(silver.where(~new))
    store.refresh(silver.where(new), 1)
    return store.orders()


@query
def daily_metrics_incremental(x: Layers) -> DataFrame:
    new = F.col("ingested_at") >= F.lit(HISTORY_END)
    before = stage(life.reconstruct(x.silver.where(~new)), scratch_path(x.spark, "orders-before"))
    now = stage(x.orders, scratch_path(x.spark, "orders-now"))
    touched = x.silver.where(new)
    return incremental.refresh_daily(daily_metrics(before), before, now, touched)


@query
def quarantine_replay(x: Layers) -> DataFrame:
    wider = incremental.with_event_type(DEFAULT, EventType("TELEPORTED", 7, "teleported_at"))
    return incremental.replay(rejected(x.validated), wider).select(
        *BRONZE_KEYS, "event_id", "event_type", "reject_reason"
    )


# Monitors


@query
def stuck_orders(x: Layers) -> DataFrame:
    return monitors.stuck_orders(x.silver, x.orders, IDLE_HOURS)


@query
def lateness_percentiles(x: Layers) -> DataFrame:
    return monitors.lateness_percentiles(x.counted_silver, PERCENTILES)


@query
def quality_monitor_daily(x: Layers) -> DataFrame:
    return monitors.daily_quality(x.counted_silver)


@query
def reject_rates_daily(x: Layers) -> DataFrame:
    return monitors.reject_rates(x.validated)


@query
def attempts_distribution(x: Layers) -> DataFrame:
    return monitors.attempts_drift(x.orders)


@query
def layer_referential_check(x: Layers) -> DataFrame:
    orders = stage(x.orders, scratch_path(x.spark, "orders"))
    return monitors.layer_violations(x.silver, orders, daily_metrics(orders))


@query
def approx_duplicate_rate(x: Layers) -> DataFrame:
    exact = x.typed.agg(F.count_distinct("event_id")).scalar()
    near = F.abs(F.col("estimated_ids") - exact) <= F.lit(0.1) * exact
    return monitors.duplicate_estimate(x.typed).select(
        "valid_events",
        near.alias("estimate_is_near"),
        (F.col("estimated_duplicate_rate") < 0.15).alias("rate_is_plausible"),
    )


def _stored_sketches(x: Layers) -> DataFrame:
    path = scratch_path(x.spark, "sketches")
    built = sketches.daily_sketches(x.typed)
    tables.write_by_date(built, path, "event_date", ["event_type"])
    return x.spark.read.schema(built.schema).parquet(path)


@query
def distinct_ids_daily(x: Layers) -> DataFrame:
    """Per date and over all dates (NULL): exact ids, and how often the estimate's error exceeds its bound."""
    x.rows
    stored, typed = _stored_sketches(x), x.typed
    per_date = sketches.distinct_error(stored, typed, "event_date")
    overall = sketches.distinct_error(stored, typed).withColumn("event_date", F.lit(None).cast("date"))
    over = sketches.times_bound(F.col("relative_error"), sketches.DEFAULT_SIZE.distinct_error)
    return per_date.unionByName(overall).select("event_date", "rows", "ids", over.alias("times_bound"))


@query
def lateness_sketch_ranks(x: Layers) -> DataFrame:
    """Per type and share: rows, and how often the merged sketch's rank error exceeds its bound."""
    x.rows
    found = sketches.lateness_quantiles(_stored_sketches(x), PERCENTILES, "event_type")
    ranked = sketches.rank_errors(found, x.typed, "event_type")
    over = sketches.times_bound(F.col("rank_error"), sketches.DEFAULT_SIZE.rank_error)
    return ranked.select("event_type", "rows", "share", over.alias("times_bound"))


# Streams


def _finish(stream) -> None:
    stream.awaitTermination()


def _files_per_trigger(x: Layers) -> int:
    """Eight files, as long as the landed ones are few."""
    return streams.files_to_catch_up(x.spark, x.files, 8)


@query
def stream_validate(x: Layers) -> DataFrame:
    out, checkpoint = scratch_path(x.spark, "validated"), scratch_path(x.spark, "progress")
    bronze = streams.stream_bronze(x.spark, x.files, files_per_trigger=_files_per_trigger(x))
    rows = streams.stream_validated(bronze).select(
        "event_id", "order_id", "event_type", "event_time", "ingested_at", "reject_reason"
    )
    _finish(streams.append_to(rows, out, checkpoint))
    return x.spark.read.schema(rows.schema).parquet(out)


@query
def stream_dedup(x: Layers) -> DataFrame:
    silver, seen, expired = (scratch_path(x.spark, n) for n in ("silver", "seen", "expired"))
    rows = streams.stream_valid(x.spark, x.files, files_per_trigger=_files_per_trigger(x))
    handler = streams.deduplicate_batches(silver, seen, expired, HORIZON_DAYS)
    _finish(streams.each_batch(rows, handler, scratch_path(x.spark, "progress")))
    return x.spark.read.parquet(silver).select(*C.SEMANTIC_KEY)


@query
def stream_dedup_state(x: Layers) -> DataFrame:
    """The same keys from watermark state instead of a stored index."""
    combined, out = scratch_path(x.spark, "combined"), scratch_path(x.spark, "unique")
    rows = streams.stream_valid(x.spark, x.files, files_per_trigger=_files_per_trigger(x))
    handler = state.combine_batches(combined)
    _finish(streams.each_batch(rows, handler, scratch_path(x.spark, "progress")))
    schema = drop_exact(x.typed).schema
    unique = state.unique_in_state(x.spark, combined, schema, HORIZON_DAYS)
    _finish(streams.append_to(unique, out, scratch_path(x.spark, "progress")))
    return x.spark.read.schema(schema).parquet(out).select(*C.SEMANTIC_KEY)


@query
def late_side_output(x: Layers) -> DataFrame:
    on_time, late = scratch_path(x.spark, "on-time"), scratch_path(x.spark, "late")
    rows = streams.stream_valid(x.spark, x.files, files_per_trigger=_files_per_trigger(x))
    handler = streams.route_by_lateness(on_time, late, ALLOWED_SECONDS)
    _finish(streams.each_batch(rows, handler, scratch_path(x.spark, "progress")))

    def side(path: str, name: str) -> DataFrame:
        return x.spark.read.parquet(path).select(
            "event_id", "order_id", "lateness_seconds", F.lit(name).alias("side")
        )

    return side(on_time, "on time").unionByName(side(late, "late"))
