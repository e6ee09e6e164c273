"""Streaming entity resolution: insert-if-absent and conflicts as they arise (K3, A4).

Rows of a stream are folded into one state per entity and file by a streaming
aggregate in update mode (least and greatest key, flags), combined on the map
side first, so a hot entity costs a row per task and file.  Each micro-batch
hands the states it changed to a ``ResolvedStore`` under its own number: the
entities are decided again, a late second value turns a resolved one into a
conflict, and the change set says which entities are new (``insert``) and which
decisions changed (``update``).  A batch that is replayed after a failure finds
its number taken, or replaces what was left of it.
"""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery

from wardline.operators.resolve import file_states
from wardline.plans.incremental import ResolvedStore
from wardline.sources.model import Source


def resolve_stream(source: Source, store: ResolvedStore, checkpoint: str, available_now: bool = True,
                   query_name: str | None = None) -> StreamingQuery:
    """Start resolving the streaming frame of ``source`` into ``store``.

    ``checkpoint`` is on shared storage and belongs to this stream and store: it
    numbers the batches.  The state of the aggregate is a row per entity and
    file; on a cluster keep it in the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    states = file_states([source], store.variables)

    def write_batch(batch, number: int) -> None:
        store.add_states(batch, number + 1)

    writer = (states.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
