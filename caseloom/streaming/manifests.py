"""Incremental merges: append-only event folders drained by ``availableNow`` triggers into current-state snapshots.

The source system has no event time, windows or late data, so there is no watermark: each batch is one merge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from caseloom.operators.state import MATERIAL, latest, merge
from caseloom.schemas import SCHEMAS
from caseloom.sources.sinks import read_snapshot, swap_snapshot


def merge_batch(spark: SparkSession, name: str, folder: str, seen_at: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that merges observations into table ``name``. A batch that is run again after a failure
    finds its snapshot written and leaves it."""
    key, material = MATERIAL[name]

    def apply(batch: DataFrame, batch_id: int) -> None:
        run_id = f"batch-{batch_id:09d}"
        from caseloom.sources.sinks import exists

        if exists(spark, f"{folder}/{name}/{run_id}/_SUCCESS"):
            return
        now = read_snapshot(spark, folder, name, SCHEMAS[name])
        merged = merge(now, latest(batch.select(key, *material), [key], ["source_fingerprint"]), key, material, seen_at, run_id)
        swap_snapshot(spark, merged.drop("changed"), folder, name, run_id)

    return apply


def follow(spark: SparkSession, events: str, name: str, folder: str, checkpoint: str, seen_at: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Drain new event files of table ``name`` and stop."""
    stream = spark.readStream.schema(SCHEMAS[name]).option("maxFilesPerTrigger", files_per_batch).json(events)
    return stream.writeStream.foreachBatch(merge_batch(spark, name, folder, seen_at)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
