"""Comparison operators: nulls, ties, empty tables, and flags that the data ask for."""

from pyspark.sql import functions as F

from tabforge.operators.comparison import (agreement, block_correlations, mean_std_differences, selected_missing_flags,
                                           top_differences)


def test_agreement_leaves_out_rows_with_a_null(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (1, 2, 1), (1, 2, None), (None, 3, 1), (3, None, 1)], "a int, b int, y int")
    got = {r["pattern"]: (r["n"], r["share"], r["rate"]) for r in agreement(df, "a", "b", "y").collect()}
    assert got == {"equal": (1, 0.25, 1.0), "above": (1, 0.25, 0.0), "below": (2, 0.5, 1.0)}
    assert agreement(df.where("a > 99"), "a", "b", "y").count() == 0


def test_top_differences_break_ties_by_id(spark):
    df = spark.createDataFrame([(4, 1, 6), (2, 6, 1), (3, 1, 1), (1, 1, 9), (5, None, 3)], "id int, a int, b int")
    rows = [(r["pos"], r["id"], r["diff"]) for r in top_differences(df, "id", "a", "b", 2).orderBy("pos").collect()]
    assert rows == [(1, 1, -8), (2, 2, 5)]
    assert top_differences(df.where("id > 99"), "id", "a", "b", 2).count() == 0


def test_means_apart_in_their_own_unit(spark):
    df = spark.createDataFrame([("t", 1.0, 100.0), ("t", 3.0, 300.0), ("s", 2.05, 201.0), ("s", None, None)], "o string, x double, y double")
    got = {r["feature"]: r for r in mean_std_differences(df, ["x", "y"], F.col("o") == "t", F.col("o") == "s").collect()}
    assert got["x"]["mean_diff"] == 0.05 and got["x"]["shifted"] == 0
    assert got["y"]["mean_diff"] == 1.0 and got["y"]["shifted"] == 1  # 1 % of a deviation, but above 0.1
    assert got["x"]["std_second"] is None and got["x"]["std_diff"] is None


def test_block_correlations_skip_constants(spark):
    df = spark.range(50).select(F.col("id").alias("a"), (F.col("id") * -2).alias("b"), F.lit(1).alias("c"), (F.col("id") % 2).alias("d"))
    got = {(r["block1"], r["block2"], r["f1"], r["f2"]): r["corr"] for r in block_correlations(df, {"p": ["a", "c"], "q": ["b", "d"]}).collect()}
    assert got == {("p", "q", "a", "b"): -1.0}


def test_selected_flags_are_added_to_both_frames(spark):
    train = spark.range(400).select(
        "id", F.when(F.col("id") % 4 > 0, F.col("id")).alias("told"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("noise"),
        F.col("id").alias("full"), F.lit(None).cast("int").alias("empty"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    serve = train.drop("y").where("id < 20")
    flags, (a, b) = selected_missing_flags(train, [serve], ["told", "noise", "full", "empty"], "y")
    assert flags == ["told_missing"]
    assert a.columns == [*train.columns, "told_missing"] and b.columns == [*serve.columns, "told_missing"]
    assert b.where("told_missing = 1").count() == 5
    flags, (a, b) = selected_missing_flags(train, [serve], ["full", "empty"], "y")
    assert flags == [] and b.columns == serve.columns
