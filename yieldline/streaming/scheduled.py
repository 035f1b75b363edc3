"""One scheduled run: take in what has arrived since the last run, then refresh the models.

Any scheduler may call `run_once` every hour. The checkpoint remembers how far the last run came.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from yieldline.plans.refresh import full_refresh, incremental_refresh
from yieldline.sources.commits import CommitLog
from yieldline.sources.topic import FIELDS
from yieldline.streaming.ingest import Ingest


def run_once(
    ingest: Ingest, open_stream: Callable[[], DataFrame], checkpoint: str, full: bool = False
) -> dict:
    """Ingest everything available, then refresh what these bookings can change.

    The facts know the newest batch of each stream, and `refreshed` the newest one whose bookings the models have. Only the
    batches between are read. A run that dies between ingest and refresh is made up for by the next one, and a new
    checkpoint starts a list of its own. Batches that the models have are dropped from `ingest/fresh`.
    """
    warehouse = ingest.warehouse
    query = ingest.start(open_stream(), checkpoint, availableNow=True)
    query.awaitTermination()
    refreshed = CommitLog(warehouse.spark, warehouse.path("refreshed"))
    done, stored = refreshed.latest()[1], warehouse.log.marks()
    pending = {s: list(range(done.get(s, -1) + 1, newest + 1)) for s, newest in stored.items() if newest > done.get(s, -1)}
    if not pending:
        return {}
    if full or not warehouse.has_table("quality_linewise_datehour"):
        replaced = full_refresh(warehouse)
    else:
        arrived = [ingest.fresh(s, batches).select(*FIELDS) for s, batches in pending.items()]
        replaced = incremental_refresh(warehouse, reduce(DataFrame.unionAll, arrived))
    refreshed.commit(lambda state: state | {s: max(batches[-1], state.get(s, -1)) for s, batches in pending.items()})
    for stream, batches in pending.items():
        ingest.forget(stream, batches)
    return replaced
