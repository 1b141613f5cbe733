"""The receipt load driven by arrival instead of by a window a caller gives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillhouse.plans.jobs import load_checks
from tillhouse.sources.tables import TableStore


def follow_checks(warehouse: TableStore, arriving: DataFrame, progress: str) -> StreamingQuery:
    """Load all tagged receipt lines that have arrived since the last run, batch by batch, and stop.

    The load is an upsert by key, so a batch that is repeated after a failure changes nothing.
    ``progress`` is the shared folder that remembers what was read.
    """
    def load(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            load_checks(warehouse, batch.distinct())

    return (arriving.writeStream.foreachBatch(load).option("checkpointLocation", progress)
            .trigger(availableNow=True).start())
