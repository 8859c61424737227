"""Ranks from sampled ranges, sparse one-hot codes and balanced group folds on keys that crowd a plain bucket."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabforge.operators.encode import label_encoder, sparse_one_hot
from tabforge.operators.folds import _deal, balanced_group_folds, fold_quotas, group_folds
from tabforge.operators.ranking import range_row_number, sorted_ranges


@pytest.fixture
def whole_ranges(spark):
    """Ranges as cut, not merged again because the test data are small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _even(df):
    n = sorted(r["count"] for r in df.groupBy("_range").count().collect())
    assert len(n) >= 6 and n[-1] <= 2 * float(np.median(n)), n


def test_shared_prefix_keys_spread_over_tasks(whole_ranges):
    df = whole_ranges.range(50_000).select(F.concat(F.lit("Customer#00000000000"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("k"))
    _even(sorted_ranges(df, [F.col("k")]))


def test_groups_of_one_size_spread_over_tasks(whole_ranges):
    df = whole_ranges.range(1_000_000).select(F.lit(1).alias("size"), F.col("id").alias("g"))
    _even(sorted_ranges(df, [F.col("size").desc(), F.col("g")]))


@pytest.mark.parametrize("partition", [None, "p"])
def test_range_row_number_equals_window(spark, partition):
    df = spark.range(4000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("p"),
                                  F.when(F.col("id") % 5 > 0, F.pmod(F.hash("id"), F.lit(50))).alias("x"))
    w = (Window.partitionBy("p") if partition else Window.partitionBy()).orderBy(F.col("x").desc(), "id")
    got = range_row_number(df, [F.col("x").desc(), F.col("id")], "rn", partition)
    want = df.withColumn("want", F.row_number().over(w)).select("id", "want")
    assert got.join(want, "id").where("rn = want").count() == got.count() == 4000


def test_range_row_number_of_an_empty_table(spark):
    df = spark.createDataFrame([], "p int, x int")
    assert range_row_number(df, [F.col("x")], "rn", "p").count() == 0
    assert label_encoder(df, "x").codes.count() == 0
    assert sparse_one_hot(df, "x").n_slots == 0


def test_hundred_thousand_categories(spark):
    df = spark.range(100_000).select("id", F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"))
    m = sparse_one_hot(df, "c")
    assert m.n_slots == 99_999
    assert m.long(df, "id").where("slot = id - 1").count() == 99_999


def test_sparse_one_hot_aligns_the_serve_frame(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, None)], "id int, c string")
    serve = spark.createDataFrame([(1, "c"), (2, "new"), (3, None), (4, "a"), (5, "b")], "id int, c string")
    m = sparse_one_hot(train, "c")
    assert [(r["id"], r["slot"]) for r in m.transform(serve, "slot").orderBy("id").collect()] == [(1, 1), (2, None), (3, None), (4, None), (5, 0)]
    v = {r["id"]: r["c_vector"].toArray().tolist() for r in m.vectors(serve).collect()}
    assert v == {1: [0, 1], 2: [0, 0], 3: [0, 0], 4: [0, 0], 5: [1, 0]}
    full = sparse_one_hot(train, "c", drop_first=False)
    assert {r["id"]: r["slot"] for r in full.long(serve, "id").collect()} == {1: 2, 4: 0, 5: 1}


def test_bulk_dealing_equals_one_by_one():
    rng = np.random.default_rng(3)
    for _ in range(200):
        k, step, count = int(rng.integers(1, 7)), int(rng.integers(1, 9)), int(rng.integers(0, 400))
        loads = [int(x) for x in rng.integers(0, 60, k)]
        now, want = list(loads), [0] * k
        for _ in range(count):
            f = min(range(k), key=lambda i: (now[i], i))
            now[f] += step
            want[f] += 1
        assert _deal(count, loads, step) == want


def test_hot_group_is_filled_up_by_the_others(spark):
    rows = [(0 if i % 3 == 0 else i, int(i % 4 == 0)) for i in range(6000)]  # a third of all rows in one group
    df = spark.createDataFrame([*rows, (None, 1)], "g int, y int")
    f = balanced_group_folds(df, "g", 3, "y")
    assert f.where("g IS NULL AND fold IS NULL").count() == 1 and f.count() == 6001
    per = f.where("fold IS NOT NULL").groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("pos")).collect()
    assert len(per) == 3 and max(r["n"] for r in per) - min(r["n"] for r in per) <= 2
    assert max(r["pos"] for r in per) - min(r["pos"] for r in per) <= 2
    assert f.where("g IS NOT NULL").groupBy("g").agg(F.count_distinct("fold").alias("k")).where("k > 1").isEmpty()
    # the order of the snake can't fill up a huge group
    snake = group_folds(df.where("g IS NOT NULL"), "g", 3, "y").groupBy("fold").count().collect()
    assert max(r["count"] for r in snake) - min(r["count"] for r in snake) > 1000


def test_signatures_beyond_the_bound_are_dealt_in_turn(spark):
    df = spark.range(5000).select(F.floor(F.sqrt("id")).alias("g"), (F.col("id") % 2).cast("int").alias("y"))
    f = balanced_group_folds(df, "g", 5, "y", max_signatures=10)
    assert f.count() == 5000 and f.where("fold IS NULL OR fold < 0 OR fold > 4").isEmpty()


def test_quotas_hold_every_group():
    shapes = [(3, 40, 1), (2, 2, 7), (0, 4, 11), (1, 0, 1000), (0, 1, 3)]
    assert [sum(q) for q in fold_quotas(shapes, 5)] == [c for _, _, c in shapes]
