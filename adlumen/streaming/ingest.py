"""Messages to the ingest table as a stream."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from adlumen.operators.validate import validate_impressions
from adlumen.sources.tables import Tables, ingest_rows, write_ingest


def start_ingest(messages: DataFrame, tables: Tables, checkpoint: str,
                 processing_time: str | None = None) -> StreamingQuery:
    """Validate messages and store every one of them, valid or rejected.

    The checkpoint records a batch's source positions before it runs and its completion after it
    is written: a failed write is repeated with the same messages and the same batch id, and
    ``write_ingest`` replaces that batch. Batches belong to the query's own id, which its checkpoint
    keeps, so a stream with another or a new checkpoint never replaces them. Default timestamps come from the batch's recorded time,
    so a repeated batch also lands on the same day.

    Without ``processing_time`` the query takes what is there, in bounded batches, and ends.
    """
    rows = ingest_rows(validate_impressions(messages))
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}

    def store(batch: DataFrame, batch_id: int) -> None:
        # Written before the first batch starts.
        query = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()
        write_ingest(batch, tables, batch_id, json.loads(query.value)["id"])

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
