"""Pass messages on unchanged, and score readings as they arrive."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spindlework.operators.scoring import score
from spindlework.streaming.ingest import start_append


def relay(
    messages: DataFrame, path: str | None, checkpoint: str, fmt: str = "parquet", topics: str = ".*", **options
) -> StreamingQuery:
    """Forward (topic, value) of every matching topic as they are."""
    passed = messages.filter(F.col("topic").rlike(f"^(?:{topics})$")).select("topic", "value")
    return start_append(passed, path, checkpoint, fmt, **options)


def score_stream(
    readings: DataFrame, model: PipelineModel, keep: list[str], path: str, checkpoint: str, **options
) -> StreamingQuery:
    return start_append(score(readings, model, keep), path, checkpoint, **options)
