"""Continuous ingest: each micro-batch is one ingest into the collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.embedding import Embedder
from ..operators.ingest import ingest
from ..sources.store import CollectionStore

COMPACT_EVERY = 4


def ingest_stream(
    store: CollectionStore,
    name: str,
    source: DataFrame,
    embedder: Embedder,
    checkpoint: str,
    compact_every: int = COMPACT_EVERY,
    trigger: dict | None = None,
    **settings,
) -> StreamingQuery:
    """Upsert a stream of rows.

    No state is kept between batches. A batch run again after a failure writes the same points
    once more, and since point ids are stable they replace themselves. Later batches win over
    earlier ones. After every `compact_every` batches neighbouring segments of like size are folded together (`fold`), which
    writes each row about as often as the number of batches has digits, and what no version shows any more is swept away.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # A batch without any id writes nothing; refusing it would stop the stream at it for good.
        ingest(store, name, batch, embedder, **{"some_ids": False, **settings})
        if (batch_id + 1) % compact_every == 0:
            store.fold(name)
            store.sweep(name)

    writer = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
