"""Events and orders in hash buckets of the order, so that a batch touches only its own buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstrata.config import DEFAULT, StreamConfig
from eventstrata.operators.dedup import SILVER_KEYS
from eventstrata.operators.incremental import events_of
from eventstrata.operators.lifecycle import ORDER_KEYS, reconstruct
from eventstrata.session import scratch_path, stage, stage_counted, workspace

BUCKET, BATCH = "_bucket", "_batch"


class OrderStore:
    """Silver events and their order rows under ``path``, cut into ``config.order_buckets``.

    ``refresh`` adds a batch of new Silver events and rebuilds the orders it touches: it
    reads and rewrites their buckets and no others, so its cost follows the batch, not the
    history. Inside a bucket, files are ranges of the sort keys; an order that holds a third
    of all rows spans several of them. Events lie in folders per bucket and batch: a batch
    that is repeated after a failure replaces its own folders, and its orders are rebuilt
    from what is stored, so repeating a refresh changes nothing. Late events reopen their
    order whatever its age.
    """

    def __init__(self, spark: SparkSession, path: str, config: StreamConfig = DEFAULT):
        self.spark, self.config = spark, config
        self.events_path, self.orders_path = f"{path}/events", f"{path}/orders"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("order_id"), F.lit(self.config.order_buckets)).cast("int")

    def _write(self, rows: DataFrame, path: str, folders: list[str], keys: tuple[str, ...]) -> None:
        (
            rows.repartitionByRange(*folders, *keys)
            .sortWithinPartitions(*folders, *keys)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", self.config.compression)
            .partitionBy(*folders)
            .parquet(path)
        )

    def _read(self, path: str, buckets: list[int] | None) -> DataFrame:
        rows = self.spark.read.parquet(path)
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))

    def events(self, buckets: list[int] | None = None) -> DataFrame:
        """Stored events, of some buckets only if given: folders are pruned before any read."""
        return self._read(self.events_path, buckets).drop(BUCKET, BATCH)

    def orders(self, buckets: list[int] | None = None) -> DataFrame:
        return self._read(self.orders_path, buckets).drop(BUCKET)

    def load(self, silver: DataFrame) -> None:
        """The history as batch 0, with all its orders."""
        self.refresh(silver, 0)

    def refresh(self, new: DataFrame, batch: int) -> list[int]:
        """Add the Silver events of a batch; returns the buckets it touched, in order.

        ``new`` is deduplicated against the stored events already (``unseen_events``). Batch
        numbers differ between batches and stay the same when a batch is repeated.
        """
        with workspace(self.spark, "order-refresh"):
            rows = new.withColumn(BUCKET, self.bucket()).withColumn(BATCH, F.lit(batch).cast("long"))
            rows = stage(rows, scratch_path(self.spark, "batch"))
            # At most one number per bucket comes to the driver.
            touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
            if not touched:
                return []
            ids, count = stage_counted(rows.select("order_id").distinct(), scratch_path(self.spark, "ids"))
            self._write(rows, self.events_path, [BUCKET, BATCH], SILVER_KEYS)
            rebuilt = reconstruct(events_of(self.events(touched), ids, count, self.config), self.config)
            if self._has_orders():
                rebuilt = self.orders(touched).join(ids, "order_id", "left_anti").unionByName(rebuilt)
            # Staged first: the folders that it derives from are replaced.
            rebuilt = stage(rebuilt.withColumn(BUCKET, self.bucket()), scratch_path(self.spark, "orders"))
            self._write(rebuilt, self.orders_path, [BUCKET], ORDER_KEYS)
            return touched

    def _has_orders(self) -> bool:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.orders_path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(jvm_path)
