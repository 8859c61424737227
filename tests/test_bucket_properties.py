"""Property: every bucket function used for distributed ranking is monotone
in its sort key, for arbitrary doubles and hex strings."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabforge.operators.quantiles import value_bucket
from tabforge.operators.ranking import hex_prefix_bucket

DOUBLES = st.floats(allow_nan=False, allow_infinity=False, width=64)


@settings(max_examples=5, deadline=None)
@given(st.lists(DOUBLES, min_size=2, max_size=400))
def test_value_bucket_monotone(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(0.0,), (-0.0,), (5e-324,), (-5e-324,)], "v double")
    rows = df.select("v", value_bucket(F.col("v")).alias("b"), value_bucket(F.col("v"), 64).alias("c")).collect()
    rows.sort(key=lambda r: r["v"])
    for a, b in zip(rows, rows[1:]):
        assert a["b"] <= b["b"] and a["c"] <= b["c"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789abcdef", min_size=4, max_size=32), min_size=2, max_size=300))
def test_hex_prefix_bucket_monotone(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    rows = sorted(df.select("k", hex_prefix_bucket("k").alias("b")).collect(), key=lambda r: r["k"])
    for a, b in zip(rows, rows[1:]):
        assert a["b"] <= b["b"]
