"""Apply fitted (stateless) operators to a file stream.

Imputation rules, encoders and scalers are static DataFrames, so applying
them to a stream is a stream-static join: no state store, no watermark. The
query runs with ``availableNow`` so a batch of landed files is processed to
completion and the query stops; checkpoints go under the shared checkpoint
folder so a restarted driver resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tabforge.sources.files import scratch_path


def run_available(spark: SparkSession, source_path: str, schema: StructType | str,
                  transform: Callable[[DataFrame], DataFrame], out_path: str,
                  checkpoint: str | None = None, fmt: str = "parquet") -> str:
    """Read every file currently in ``source_path`` as a stream, apply
    ``transform`` and append the result to ``out_path``; returns out_path."""
    stream = spark.readStream.schema(schema).format(fmt).load(source_path)
    out = transform(stream)
    q = (out.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path
