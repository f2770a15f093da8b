"""Scoring of arriving applications with Structured Streaming.

The reference scores one application at a time in its interactive app.  Here the same
logic (probability, decision, risk class, segment and segment profile) is a stateless
streaming transformation: fitted ``PipelineModel`` stages apply to streaming frames as
they do to batch frames, and the segment profiles (k rows) join as a static broadcast
side.  No state is kept, so no watermark is needed; the sink's checkpoint makes the
query restartable after executor or driver loss.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.score import scored_report
from ..operators.segments import ClusterBundle


def score_stream(model, stream: DataFrame, bundle: ClusterBundle | None = None,
                 key: str = "SK_ID_CURR", threshold: float = 0.5) -> DataFrame:
    """Streaming frame of (id, p, decision, risk class/colour, cluster, profile)."""
    return scored_report(model, bundle, stream, key, threshold)


def start_scoring(stream: DataFrame, model, sink_path: str, checkpoint_location: str,
                  bundle: ClusterBundle | None = None, key: str = "SK_ID_CURR",
                  trigger_seconds: int | None = None) -> StreamingQuery:
    """Append scored rows to a Parquet sink; exactly-once through the checkpoint."""
    writer = (score_stream(model, stream, bundle, key).writeStream
              .format("parquet").option("path", sink_path)
              .option("checkpointLocation", checkpoint_location).outputMode("append"))
    if trigger_seconds:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()
