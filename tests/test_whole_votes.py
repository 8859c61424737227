"""The label vote is over all models with ties; the seed study reaches 30 seeds."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_vote_over_all_models(spark):
    import __spark_entry__ as E
    from tabforge.operators.ensemble import with_pred
    from tabforge.plans.fixtures import scores
    votes = {r["id"]: r["vote"] for r in E.queries()["q_p1_label_mean_vote_all_models"](spark, SF_SMALL).collect()}
    ones = {r["id"]: r["n"] for r in with_pred(scores(spark, SF_SMALL)).groupBy("id").agg(F.sum("pred").alias("n")).collect()}
    assert set(votes) == set(ones)
    # m4 turns a lead of one vote into a tie, never a sure vote
    assert all(votes[i] == (n == 3) for i, n in ones.items() if n in (0, 1, 3))
    assert {votes[i] for i, n in ones.items() if n == 2} == {0, 1}


def test_seed_counts_reach_thirty(spark):
    import __spark_entry__ as E
    rows = E.queries()["q_m25_seed_count_returns_30"](spark, SF_SMALL).collect()
    assert {r["n_seeds"] for r in rows} == {1, 5, 10, 20, 30} and len(rows) == 15
    assert all(r["mean_std"] > 0 for r in rows if r["n_seeds"] > 1)
