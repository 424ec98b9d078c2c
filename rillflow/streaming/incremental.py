"""The incremental run as a stream: each micro-batch of changed items goes through the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rillflow.operators.state import compared


def changed_only(items: DataFrame, manifest: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], keys: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Writes what the manifest doesn't know unchanged, once per batch; a replayed batch overwrites its own output.

    ``manifest`` is read anew in every batch; ``write(rows, batch_id)`` must be idempotent by id.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        write(compared(rows, manifest(), keys).where("not skip").drop("seen_at", "known", "skip"), batch_id)

    return items.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
