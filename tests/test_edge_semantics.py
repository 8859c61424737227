"""Hand tables for tie, null and edge semantics (FIXTURES section 4)."""

from pyspark.sql import functions as F

from tabforge.functions.bins import cut, dedupe_edges, qcut, quantile_edges
from tabforge.functions.text import prefix_class, replace_values, title
from tabforge.operators.encode import one_hot, standard_scaler
from tabforge.operators.ensemble import label_mean_vote, pair_diversity
from tabforge.operators.impute import fill_in_frame
from tabforge.operators.joins import dict_lookup
from tabforge.operators.quantiles import group_mode


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([(v,) for v in [2, 1, 1, 2, 3]], "v int")
    assert group_mode(df, "v").first()["mode"] == 1


def test_half_even_vote(spark):
    rows = [(1, "a", 0), (1, "b", 0), (1, "c", 1), (1, "d", 1), (2, "a", 1), (2, "b", 1), (2, "c", 1), (2, "d", 0)]
    df = spark.createDataFrame(rows, "id int, model string, pred int")
    got = {r["id"]: r["vote"] for r in label_mean_vote(df).collect()}
    assert got == {1: 0, 2: 1}


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(0.0,), (12.0,), (12.5,), (100.0,), (101.0,), (None,)], "x double")
    got = [r[0] for r in df.select(cut("x", [0, 12, 18, 40, 100])).collect()]
    assert got == [None, 0, 1, 3, None, None]


def test_left_closed_bins(spark):
    df = spark.createDataFrame([(18.0,), (60.0,), (80.0,)], "x double")
    got = [r[0] for r in df.select(cut("x", [0, 18, 60, 80], right=False)).collect()]
    assert got == [1, 2, None]


def test_quartile_duplicate_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 0, 0, 1, 2]], "x double")
    edges = quantile_edges(df, "x", 4)
    assert edges == dedupe_edges(edges) and len(edges) < 5
    assert edges[0] == 0.0 and edges[-1] == 2.0
    got = [r[0] for r in df.select(qcut("x", edges)).collect()]
    assert got[0] == 0 and got[-1] == len(edges) - 2


def test_regex_without_match_is_null(spark):
    df = spark.createDataFrame([("no title",), ("Smith, Mr. John",)], "s string")
    assert [r[0] for r in df.select(title("s")).collect()] == [None, "Mr"]


def test_unmapped_dictionary_values(spark):
    df = spark.createDataFrame([("Xyz",), ("Mr",)], "t string")
    m = {"Mr": 0}
    assert [r["c"] for r in dict_lookup(df, "t", m, "c").collect()] == [None, 0]
    assert [r["c"] for r in dict_lookup(df, "t", m, "c", default=4).collect()] == [4, 0]
    assert [r[0] for r in df.select(replace_values("t", ["Mr"], "Rare")).collect()] == ["Xyz", "Rare"]


def test_null_group_key_excluded(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 5.0), (3, "a", None), (4, "a", 3.0)],
                               "id int, k string, v double")
    out = {r["id"]: r["v"] for r in fill_in_frame(df, "v", ["k"]).collect()}
    assert out == {1: None, 2: 5.0, 3: 3.0, 4: 3.0}


def test_one_hot_drop_first_alignment(spark):
    train = spark.createDataFrame([("C",), ("Q",), ("S",)], "p string")
    serve = spark.createDataFrame([("C",), ("S",)], "p string")
    m = one_hot(train, "p")
    assert m.columns == ["p_Q", "p_S"]
    got = m.transform(serve).select(*m.columns).collect()
    assert [tuple(r) for r in got] == [(0, 0), (0, 1)]


def test_standardise_population(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    z = standard_scaler(df, ["x"]).transform(df).collect()
    assert abs((z[2]["x"] - z[0]["x"]) - 3.0 / 1.247219128924647) < 1e-9


def test_q_statistic_null_guard(spark):
    rows = [(i, m, 1, 1) for i in range(4) for m in ("a", "b")]
    df = spark.createDataFrame(rows, "id int, model string, pred int, label int")
    r = pair_diversity(df).first()
    assert r["q_stat"] is None and r["both_right"] == 4


def test_prefix_normaliser(spark):
    vals = ["113803", "PC 17599", "SOTON/O.Q. 392", "A/5. 21171", "LINE", ""]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(prefix_class("t")).collect()]
    assert got == ["NUMERIC", "PC", "SOTON_O_Q", "A", "LINE", "OTHER"]
