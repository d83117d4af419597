"""Streams written batch by batch under the batch's number, so that a batch that runs again replaces itself."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quality import Rule, expect, failures
from tidemark.sources.tables import overwrite_path, stored_rows
from tidemark.sources.window_states import BATCH, DAY, on_day

Write = Callable[[DataFrame, int], None]
COUNTS = "rule_counts"


def batch_sink(
    stream: DataFrame, write: Write, checkpoint: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Call ``write(rows, number)`` for each batch: every ``every``, or, without it, for all that is
    there now. After a failure the last batch comes again with its number and the same rows."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def dated_writer(path: str, ts: str, checkpoint: str, rules: Sequence[Rule] = ()) -> Write:
    """Append the rows that pass the rules under ``path``, in folders by day of ``ts`` and by batch.

    How many rows of a batch were checked and failed each rule is stored beside the checkpoint,
    again by batch, so that counts cover the whole life of the stream and no batch counts twice.
    """

    def write(rows: DataFrame, number: int) -> None:
        # A pass of its own over the columns of the rules: metrics observed on the way are lost where
        # adaptive execution finds that nothing is left to write.
        counts = rows.agg(*failures(rules)).first().asDict()
        if not counts["checked"]:
            return
        dated = expect(rows, rules).withColumns({DAY: on_day(F.col(ts)), BATCH: F.lit(number)})
        overwrite_path(dated, path, (DAY, BATCH), only_touched=True)
        if rules:
            stored = rows.sparkSession.createDataFrame([{**counts, BATCH: number}])
            stored.coalesce(1).write.mode("overwrite").json(f"{checkpoint}/{COUNTS}/{number}")

    return write


def rule_counts(spark: SparkSession, checkpoint: str, since: int = 0) -> dict[str, int]:
    """Rows checked and failed by rule, added up over the batches from number ``since`` on; empty without any."""
    stored = stored_rows(spark, f"{checkpoint}/{COUNTS}/*", "json")
    if stored is None:
        return {}
    names = [c for c in stored.columns if c != BATCH]
    sums = stored.where(F.col(BATCH) >= since).agg(*[F.sum(c).alias(c) for c in names]).first()
    return {c: sums[c] for c in names if sums[c] is not None}


def next_batch(spark: SparkSession, checkpoint: str) -> int:
    """The number that comes after those of the batches counted so far."""
    stored = stored_rows(spark, f"{checkpoint}/{COUNTS}/*", "json")
    return 0 if stored is None else stored.agg(F.max(BATCH)).first()[0] + 1
