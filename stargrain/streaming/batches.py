"""Driving the same idempotent loads from a stream of arriving files.

A micro-batch is handed to the batch load as it is. Since the merge is idempotent, a batch that is
delivered again after a failure leaves the tables as they are; runs that arrive late are told apart
by the run in the fact key, so no watermark is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stargrain.sources.warehouse import Warehouse


def merge_stream(
    source: DataFrame,
    warehouse: Warehouse,
    table: str,
    assemble: Callable[[DataFrame, str], DataFrame],
    key: Sequence[str],
    update_cols: Sequence[str],
    date_column: str,
    surrogates: Sequence[str] = (),
) -> StreamingQuery:
    """Merge every micro-batch of `source` into a month-partitioned fact and stop when the source
    is read to its end. Its progress lies under the warehouse root, beside the table it belongs to.
    `assemble(rows, batch_id)` turns staged rows into fact rows."""

    def load(rows: DataFrame, epoch: int) -> None:
        batch_id = f"{table}-{epoch}"
        warehouse.merge_months(table, assemble(rows, batch_id), key, update_cols, batch_id, date_column, surrogates)

    return (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{warehouse.root}/_streams/{table}")
        .trigger(availableNow=True)
        .start()
    )
