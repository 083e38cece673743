"""An insert-or-ignore sink for streams of relation rows.

Dumps carry no event time, so there is nothing to window; a stream of delivered row files is taken chunk by chunk,
each micro-batch one published version. A batch that is replayed after a failure adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cratework.operators.converge import insert_or_ignore
from cratework.plans.store import Store


def insert_stream(stream: DataFrame, store: Store, table: str, key: Sequence[str], checkpoint: str, null_safe: Sequence[str] = ()) -> StreamingQuery:
    """Start a query that takes what is there (available now) into ``table``; rows of stored keys are ignored."""

    def take(batch: DataFrame, _: int) -> None:
        rows = batch.dropDuplicates(list(key))
        stored = store.read(table)
        merged = rows if stored is None else insert_or_ignore(stored, rows, key, null_safe)
        store.publish({table: store.stage(table, merged)})

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
