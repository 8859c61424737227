"""File sources and sinks: CSV with quoted text, tables, validated prediction
files, JSON summaries and parameters, append-only run records.

Scratch output goes under the shared checkpoint folder named by
``spark.checkpoint.dir`` (never a machine-local temporary folder)."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabforge.session import checkpoint_dir

log = logging.getLogger(__name__)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tabforge-scratch/{uuid.uuid4().hex}/{name}"


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True) -> DataFrame:
    """A1: CSV with a header; quoted fields may contain commas and doubled
    quotes (``escape='"'``). Pass an explicit schema in production."""
    r = spark.read.option("header", header).option("quote", '"').option("escape", '"').option("multiLine", False)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                partition_by: Sequence[str] | None = None) -> None:
    """A2: table / CSV sink."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def prediction_path(path: str, suffix: str = "", stamp: str | None = None) -> str:
    """The target with ``suffix`` (unless it ends so) and, before its last name, a time stamp such as ``20250131_0930``."""
    folder, _, name = path.rstrip("/").rpartition("/")
    name = name if suffix and name.endswith(suffix) else name + suffix
    name = f"{stamp}_{name}" if stamp else name
    return f"{folder}/{name}" if folder else name


def write_predictions(df: DataFrame, path: str, required: Sequence[str], expected_rows: int | None = None,
                      mode: str = "errorifexists", fmt: str = "csv", suffix: str = "", stamp: str | None = None) -> int:
    """A3: validated prediction sink: required columns must exist (error),
    a row-count mismatch is logged as a warning, only the required columns
    are written, and an existing target is refused unless ``mode`` says
    otherwise. The target is ``prediction_path(path, suffix, stamp)``. The plan
    runs once: rows are counted while they are written (a retried task may be
    counted again). Returns the number of rows written."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"prediction frame lacks required columns {missing}")
    counted = Observation()
    out = df.select(*required).observe(counted, F.count(F.lit(1)).alias("n"))
    write_table(out, prediction_path(path, suffix, stamp), fmt=fmt, mode=mode)
    n = counted.get["n"]
    if expected_rows is not None and n != expected_rows:
        log.warning("prediction rows %d differ from the expected %d", n, expected_rows)
    return n


def write_json_summary(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A4: nested summary rows (structs) as JSON lines."""
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              multiline: bool = True) -> DataFrame:
    """A5: JSON parameter source (one document or an array per file)."""
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_model_params(spark: SparkSession, path: str) -> list[dict]:
    """A5: ``[{"model": ..., "kind": ..., "params": {...}, "score": ...}, ...]`` as dicts, by model name. Parameters keep
    their JSON types (a whole number stays an int). A file of a few models: it may be read on the driver."""
    rows = spark.read.option("multiLine", True).option("primitivesAsString", False).json(path)
    missing = {"model", "kind", "params"} - set(rows.columns)
    if missing:
        raise ValueError(f"model parameters lack {sorted(missing)}")
    found = [r.asDict(recursive=True) for r in rows.orderBy("model").limit(1_001).collect()]
    if len(found) > 1_000:
        raise ValueError("more than 1,000 models in a parameter file")
    return [{**r, "params": {k: v for k, v in (r["params"] or {}).items() if v is not None}} for r in found]


def append_run_record(df: DataFrame, path: str, run_id: str) -> None:
    """Append a sweep result table as one partition per run."""
    df.withColumn("run", F.lit(run_id)).write.mode("append").partitionBy("run").parquet(path)
