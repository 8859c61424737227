"""Shared primitives keep every row: null keys, infinite values, missing weights, second rows."""

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tabforge.operators.ensemble import soft_vote
from tabforge.operators.folds import stratified_folds
from tabforge.operators.joins import with_scalars
from tabforge.operators.quantiles import value_bucket
from tabforge.operators.ranking import bucketed_row_number, bucketed_running_sum


def test_folds_keep_rows_with_null_labels(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(20)], "id int, label int")
    assert stratified_folds(df, "id", "label", k=5).count() == 20


def test_row_number_keeps_null_order_keys(spark):
    df = spark.createDataFrame([(i, None if i < 3 else float(i)) for i in range(10)], "id int, x double")
    got = bucketed_row_number(df, None, [F.col("x"), F.col("id")], value_bucket(F.col("x")))
    assert sorted(r["rn"] for r in got.collect()) == list(range(1, 11))


def test_running_sum_keeps_null_partitions(spark):
    df = spark.createDataFrame([("a", 1.0, 1), (None, 2.0, 5), (None, 3.0, 7)], "g string, x double, n int")
    got = {(r["g"], r["x"]): r["cum_n"] for r in bucketed_running_sum(df, "g", "x", ["n"]).collect()}
    assert got == {("a", 1.0): 1, (None, 2.0): 5, (None, 3.0): 12}


def test_value_bucket_orders_infinities(spark):
    values = [float("-inf"), -1e308, -1.0, 0.0, 1.0, 1e308, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r["b"] for r in df.select("v", value_bucket(F.col("v")).alias("b")).collect()]
    assert got == sorted(got) and len(set(got)) == len(got)


def test_second_scalar_row_is_an_error(spark):
    df, two = spark.range(3), spark.createDataFrame([(1,), (2,)], "s int")
    with pytest.raises(SparkRuntimeException):
        with_scalars(df, two).collect()
    assert with_scalars(df, two.where("s = 1")).count() == 3


def test_missing_weight_is_an_error(spark):
    df = spark.createDataFrame([(1, "a", 0.2), (1, "b", 0.8), (2, "b", 0.6)], "id int, model string, proba double")
    weights = spark.createDataFrame([("a", 1.0)], "model string, weight double")
    with pytest.raises(SparkRuntimeException):
        soft_vote(df, weights=weights).collect()
    assert [r["id"] for r in soft_vote(df, weights=weights, only_weighted=True).collect()] == [1]
