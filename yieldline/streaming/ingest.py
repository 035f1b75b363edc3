"""Message stream -> validated, deduplicated booking facts, quarantine and late list.

Each micro-batch is committed under its stream and batch id, so a batch that is replayed after a failure is stored once, and
another stream or a new checkpoint never takes it for its own. No state store
and no watermark stand in the way: a booking is stored however late it comes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from yieldline.operators.merge import align_columns, insert_missing, keep_first
from yieldline.schemas import EXTRAS, STATION_RECORDS
from yieldline.session import at_once
from yieldline.sources import topic
from yieldline.sources.commits import remove_folder
from yieldline.sources.layered import Log, Member
from yieldline.sources.tables import Warehouse, is_complete
from yieldline.streaming.clock import batch_folder, clock_before, is_late, note_clock, stream_of


@dataclass(frozen=True)
class Ingest:
    """Ingest into `warehouse`. `late_after` seconds of disorder are tolerated before a booking
    counts as late; `auto_evolve` stores all payload fields the fact table lacks, in its map column."""

    warehouse: Warehouse
    late_after: int = 2 * 3600
    auto_evolve: bool = True

    def start(self, messages: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        trigger = trigger or {"availableNow": True}
        return (
            messages.writeStream.foreachBatch(self.store)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )

    def batch_path(self, name: str, stream: str, batch_id: int) -> str:
        return batch_folder(self.warehouse.path(f"ingest/{name}"), stream, batch_id)

    def store(self, messages: DataFrame, batch_id: int, stream: str | None = None) -> None:
        """Store a micro-batch. What is fresh in it is written first and stays until the models are refreshed; a replay
        decides anew as long as the facts have not committed the batch, and repeats only what came after that."""
        spark, stream = self.warehouse.spark, stream or stream_of(messages)
        if not self.warehouse.log.has(stream, batch_id):
            self._write_fresh(messages, stream, batch_id)
        fresh = self.fresh(stream, [batch_id])
        append = partial(self.warehouse.append_facts, fresh, skip_present=False, load=(stream, batch_id))
        at_once(spark, [append, partial(self._write_late, fresh, stream, batch_id)])

    def fresh(self, stream: str, batch_ids: list[int]) -> DataFrame:
        """What some micro-batches stored; other batches' folders are not looked at."""
        schema = T.StructType([*STATION_RECORDS.fields, EXTRAS])
        paths = [self.batch_path("fresh", stream, b) for b in batch_ids]
        return self.warehouse.spark.read.schema(schema).parquet(*[p for p in paths if is_complete(self.warehouse.spark, p)])

    def forget(self, stream: str, batch_ids: list[int]) -> None:
        """Drop what fresh batches wrote once the models have it."""
        for batch_id in batch_ids:
            remove_folder(self.warehouse.spark, self.batch_path("fresh", stream, batch_id))

    def _write_fresh(self, messages: DataFrame, stream: str, batch_id: int) -> None:
        """Decode once, set bad messages aside, and keep bookings whose id is not stored yet."""
        decoded = topic.without_good_texts(topic.decode(messages)).persist()
        try:
            bad = align_columns(topic.quarantined(decoded), topic.QUARANTINE)
            self._log("quarantine", topic.QUARANTINE).append(bad, stream, batch_id)
            rows = topic.valid(decoded)
            position = ["offset"] if "offset" in rows.columns else []
            extras = F.when(F.size("extras") > 0, F.col("extras")) if self.auto_evolve else F.lit(None)
            rows = rows.select(*topic.FIELDS, extras.cast(EXTRAS.dataType).alias("extras"), *position)
            first = keep_first(rows, ["booking_id"], *position or ["date_created"])
            fresh = insert_missing(first, self.warehouse.stored_ids(rows), ["booking_id"]).drop(*position)
            fresh.write.mode("overwrite").parquet(self.batch_path("fresh", stream, batch_id))
        finally:
            decoded.unpersist()

    def _write_late(self, fresh: DataFrame, stream: str, batch_id: int) -> None:
        """List bookings whose hour had already closed when they came, and move the clock on."""
        path = self.warehouse.path("ingest/clock")
        clock = clock_before(self.warehouse.spark, path, stream, batch_id)
        bookings = fresh.select(*topic.FIELDS)
        late = bookings.where(is_late(clock, self.late_after)).select(*STATION_RECORDS.names)
        self._log("late", STATION_RECORDS).append(late, stream, batch_id)
        note_clock(bookings, path, stream, batch_id, clock)

    def _log(self, name: str, schema: T.StructType) -> Log:
        return Log(self.warehouse.spark, self.warehouse.path(f"ingest/{name}"), {"rows": Member(schema)})

    def late(self) -> DataFrame:
        return self._log("late", STATION_RECORDS).read()

    def quarantine(self) -> DataFrame:
        return self._log("quarantine", topic.QUARANTINE).read()
