"""An extension: provenance kept up to date from a stream. The merge gives the same result in any order, so a running
aggregation with one small state per key is all it needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from studygraph.operators.reconcile import merge_provenance


def merged_stream(tags: DataFrame, keys: Sequence[str], name: str, checkpoint: str) -> StreamingQuery:
    """Merges streamed tags (keys, source) into an in-memory table of that name, until what is there now has been read."""
    return merge_provenance(tags, keys).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_stream(tags: DataFrame, keys: Sequence[str], path: str, checkpoint: str) -> DataFrame:
    """The merged provenance of a stream of tags (keys, source), after what is there now has been read. Each batch is merged by
    itself and written under its number, so a batch that is run again replaces its own rows; the driver holds none. A later
    call with the same folders goes on where this one ended. Nulls are keys like others."""
    def put(batch: DataFrame, number: int) -> None:
        merge_provenance(batch, keys).write.mode("overwrite").parquet(f"{path}/batch={number}")

    tags.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    kept = tags.schema.fields
    merged = tags.sparkSession.read.schema(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept if f.name in (*keys, "source"))).parquet(path)
    return merge_provenance(merged, keys)


def windowed_counts(events: DataFrame, ts: str, kind: str, width: str, late: str) -> DataFrame:
    """Counts by kind and time window of a stream, with a watermark for late rows."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), kind).agg(F.count("*").alias("n")).select("window.start", "window.end", kind, "n")
