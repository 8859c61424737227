"""tabforge: Spark-native tabular feature, imputation and evaluation operators.

Every operator takes and returns a ``pyspark.sql.DataFrame``; column names are
parameters. Learnt state (imputation rules, encoders, scalers, bin edges) is
held as small DataFrames so that ``transform`` is a join, never a driver loop.
"""

from tabforge.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
