"""Score a fitted pipeline over a stream of new rows.

The reference scores a saved model on a new table (evaluate).  With a
streaming source the same ``PipelineModel.transform`` applies to every
micro-batch (feature assembly, scaling and the classifier are row-wise), so
new measurements are scored as they land; the query checkpoints its progress
to the shared checkpoint directory and resumes after a failure.
"""

from __future__ import annotations

import os

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from ..operators.models import predict


def score_stream(model, stream: DataFrame, key: str) -> DataFrame:
    """(key, prediction, probability array) for every streamed row."""
    out = predict(model, stream)
    return out.select(key, "prediction", vector_to_array("probability").alias("probability"))


def start_scoring(model, stream: DataFrame, key: str, sink_path: str, checkpoint: str | None = None,
                  trigger_once: bool = False):
    """Write the scores as Parquet (append); the checkpoint defaults to a
    folder under the session's checkpoint directory."""
    spark = stream.sparkSession
    from ..session import ensure_checkpoint_dir
    ck = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "scoring")
    w = (score_stream(model, stream, key).writeStream.format("parquet").outputMode("append")
         .option("path", sink_path).option("checkpointLocation", ck))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()


