"""Steps that read a frame several times write it once."""

from pyspark.sql import functions as F


def test_described_and_recipe_rows_are_written_once(spark):
    from tabforge.operators.groups import describe
    from tabforge.plans.recipes import RECIPES, coded_recipe

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    x = spark.range(101).select(F.col("id").cast("double").alias("a"), (-F.col("id")).alias("b"))
    got = describe(x, ["a", "b"])
    assert "Range" not in plan(got)
    assert [tuple(r) for r in got.orderBy("column").collect()] == [("a", 101, 50.0, 29.300171, 0.0, 25.0, 50.0, 75.0, 100.0),
                                                                  ("b", 101, -50.0, 29.300171, -100.0, -75.0, -50.0, -25.0, 0.0)]
    raw = spark.range(40).selectExpr("id", "concat('A, ', if(id % 2 = 0, 'Mr', 'Mrs'), '. B') AS full_name", "concat(id % 3 + 1, '-X') AS klass", "'O' AS category",
                                     "if(id % 5 = 0, NULL, 'ASIA') AS region", "if(id % 7 = 0, NULL, id * 1.0D) AS amount_a",
                                     "if(id % 4 = 0, NULL, id * 2.0D) AS amount_b", "'D1' AS unit_code", "int(id % 4) AS n_sib", "int(id % 3) AS n_par",
                                     "concat('T', id % 6) AS ticket", "int(id % 2) AS label")
    made = coded_recipe(raw, 11)
    assert "Range" not in plan(made) and made.columns == ["id", *RECIPES[11], "label"]
    assert made.count() == 40 and made.where("amount_a IS NULL").count() == 0
