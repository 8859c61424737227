"""Golden rule values read off the reference's imputed outputs (FIXTURES):
applying the learnt (class, title) and (class, sex) rules must reproduce them."""

from tabforge.operators.impute import GroupImputerModel

# Learnt medians published by the reference's imputed files.
AGE_BY_CLASS_TITLE = [(1, "Mr", 40.0), (1, "Mrs", 40.0), (2, "Mr", 31.0), (2, "Mrs", 32.0), (3, "Master", 4.0),
                      (3, "Miss", 18.0), (3, "Mr", 26.0), (3, "Mrs", 31.0)]
AGE_BY_CLASS_SEX = [(1, "female", 35.0), (1, "male", 40.0), (2, "female", 28.0), (2, "male", 30.0),
                    (3, "female", 21.5), (3, "male", 25.0)]


def test_class_title_rules(spark):
    rules = spark.createDataFrame(AGE_BY_CLASS_TITLE, "cls int, title string, value double")
    rows = [(i, c, t, None) for i, (c, t, _) in enumerate(AGE_BY_CLASS_TITLE)] + [(99, 3, "Mr", 22.0)]
    df = spark.createDataFrame(rows, "id int, cls int, title string, age double")
    m = GroupImputerModel("age", [(["cls", "title"], rules)], None)
    got = {r["id"]: r["age"] for r in m.transform(df).collect()}
    for i, (_, _, v) in enumerate(AGE_BY_CLASS_TITLE):
        assert got[i] == v
    assert got[99] == 22.0


def test_class_sex_rules_and_fare(spark):
    rules = spark.createDataFrame(AGE_BY_CLASS_SEX, "cls int, sex string, value double")
    fare_rules = spark.createDataFrame([(3, "S", 8.05)], "cls int, port string, value double")
    df = spark.createDataFrame([(1044, 3, "male", "S", None, None)],
                               "id int, cls int, sex string, port string, age double, fare double")
    age = GroupImputerModel("age", [(["cls", "sex"], rules)], None)
    fare = GroupImputerModel("fare", [(["cls", "port"], fare_rules)], None)
    r = fare.transform(age.transform(df)).first()
    assert r["age"] == 25.0 and abs(r["fare"] - 8.05) < 0.01
