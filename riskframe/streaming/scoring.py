"""Incremental scoring (K24 over arriving files).

The reference only works on finite files and has no stream operator; the one
place where new data keeps arriving is the scoring of new applications.  This
re-expresses the K24 scoring table as a Structured Streaming query: new
parquet files in ``source_dir`` are imputed with the fitted medians,
assembled, scored by a fitted ``pyspark.ml`` model and appended to
``sink_dir``; the checkpoint (under the cluster's ``spark.checkpoint.dir``
unless given) makes the stream restartable after executor or driver loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.encode import MedianImputer
from ..operators.models import assemble
from ..session import ensure_checkpoint_dir


def score_stream(spark: SparkSession, model, imputer: MedianImputer, feature_cols: Sequence[str],
                 schema: T.StructType, source_dir: str, sink_dir: str, key: str,
                 business_threshold: float, checkpoint: str | None = None, available_now: bool = True):
    """Start the stream; returns the StreamingQuery.  ``available_now``
    processes what is there and stops (batch-like runs); otherwise it keeps
    polling."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/score_stream"
    src = spark.readStream.schema(schema).parquet(source_dir)
    feats = imputer.transform(src).withColumns({c: F.col(c).cast("double") for c in feature_cols})
    scored = model.transform(assemble(feats, feature_cols))
    proba = vector_to_array("probability")[1]
    out = scored.select(
        key, proba.alias("TARGET_PROBA"),
        (proba >= 0.5).cast("int").alias("TARGET_PRED_DEFAULT_0_5"),
        (proba >= F.lit(float(business_threshold))).cast("int").alias("TARGET_PRED_BUSINESS_THRESHOLD"))
    w = out.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", ckpt) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
