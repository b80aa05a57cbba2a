"""A prompt that never closes: new requests are answered as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def answer_stream(
    requests: DataFrame,
    answer: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Answers a streaming request table with one of the batch operators.

    Every micro-batch owns the directory ``out/batch_id=...`` and replaces it, so
    a batch that is run again after a failure leaves no answer twice. ``once``
    answers what is there and ends.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        answer(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
