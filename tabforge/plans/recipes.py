"""Composite feature recipes (I16) built from the library operators.

A recipe learns everything from the train rows (``origin == 'train'``) and
applies it to all rows, returning ``id``, numeric features and the label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.bins import qcut, quantile_edges
from tabforge.functions.text import first_char, title
from tabforge.operators.common import flag
from tabforge.operators.encode import family_features, one_hot_fixed
from tabforge.operators.impute import GroupImputer, missing_flags
from tabforge.operators.joins import count_lookup, dict_lookup, with_scalars
from tabforge.operators.quantiles import group_median
from tabforge.session import cut_lineage

# Ordinal code per title (others -> 4).
TITLE_ORDINAL = {"Mr": 0, "Miss": 1, "Mrs": 2, "Master": 3}

BASIC_FEATURES = ["amount_a", "family_size", "is_alone", "cat_O", "cat_P", "has_unit", "title_code"]


def basic_recipe(b: DataFrame, origin_col: str = "origin", keep: list[str] | None = None) -> DataFrame:
    b = b.withColumn("title", title("full_name"))
    train = b.where(F.col(origin_col) == "train")
    filled = GroupImputer("amount_a", [["klass", "title"]], stat="median").fit(train).transform(b)
    x = filled.withColumns(family_features("n_sib", "n_par"))
    x = x.withColumns(one_hot_fixed("category", ["O", "P"], "cat"))
    x = x.withColumn("has_unit", F.col("unit_code").isNotNull().cast("int"))
    x = dict_lookup(x, "title", TITLE_ORDINAL, "title_code", default=4)
    return x.select("id", *BASIC_FEATURES, "label", *(keep or []))


# Title codes of the survey recipes (no title or another one -> 0) and titles counted as rare, and the
# ordinal of the three-valued category that stands where the survey's recipes have a two-valued column.
TITLE_CODES = {"Mr": 1, "Miss": 2, "Mrs": 3, "Master": 4, "Rare": 5}
RARE_TITLES = ["Lady", "Countess", "Capt", "Col", "Don", "Dr", "Major", "Rev", "Sir", "Jonkheer", "Dona"]
CATEGORY_CODES = {"O": 0, "F": 1, "P": 2}
SAFE_DECKS = ["D", "E", "B"]

RECIPES = {
    9: ["klass_num", "category_code", "title_code", "amount_a", "is_alone", "amount_bin", "small_family", "amount_a_missing", "region_missing"],
    10: ["klass_num", "category_code", "title_code", "amount_a", "is_alone", "amount_bin", "small_family", "amount_a_missing",
         "region_missing", "deck_safe"],
    11: ["klass_num", "category_code", "title_code", "amount_a", "is_alone", "amount_bin", "small_family", "amount_a_missing",
         "region_missing", "ticket_group", "deck_safe"],
    20: ["klass_num", "is_first_category", "amount_a", "n_sib", "n_par", "family_size", "is_alone", "amount_b", "region_AFRICA",
         "region_AMERICA", "region_ASIA", "title_Mr", "title_Miss", "title_Mrs", "title_Master", "title_Rare", "amount_per_person",
         "ticket_group", "amount_a_x_klass", "amount_b_per_klass"],
}


def _merged_title(b: DataFrame) -> DataFrame:
    t = title("full_name")
    return b.withColumn("title", F.when(t.isin(RARE_TITLES), "Rare").when(t.isin("Mlle", "Ms"), "Miss").when(t == "Mme", "Mrs").otherwise(t))


#: Columns that the coded and the wide recipe read.
RAW_COLUMNS = ["id", "full_name", "klass", "category", "region", "amount_a", "amount_b", "unit_code", "n_sib", "n_par", "ticket", "label"]


def _written(b: DataFrame, learn: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The raw rows and those to learn from, written once: every step of a recipe that learns something reads them again."""
    b = cut_lineage(b.select(RAW_COLUMNS))
    return b, b if learn is None else cut_lineage(learn.select(RAW_COLUMNS))


def coded_recipe(b: DataFrame, n_features: int, learn: DataFrame | None = None) -> DataFrame:
    """I16, 9 to 11 columns: coded title and category, amount_a by the median of (title, class) and else of what is
    filled by then, amount_b by the median of the class and cut at its quartiles, flags, group size of the ticket.
    Everything is learnt from ``learn`` (default: all rows of ``b``, as the survey's recipes do)."""
    def coded(df):
        x = _merged_title(df).withColumn("klass_num", F.substring("klass", 1, 1).cast("int"))
        x = dict_lookup(x, "title", TITLE_CODES, "title_code", default=0)
        return dict_lookup(x, "category", CATEGORY_CODES, "category_code")

    b, source = _written(b, learn)
    fit = coded(source)
    by_group = GroupImputer("amount_a", [["title_code", "klass"]], overall=False).fit(fit)
    rest = group_median(by_group.transform(fit), "amount_a", None, "_rest")
    by_class = GroupImputer("amount_b", [["klass"]], overall=False).fit(fit)
    edges = quantile_edges(by_class.transform(fit), "amount_b", 4)
    x = missing_flags(coded(b), ["amount_a", "region"])
    x = by_class.transform(by_group.transform(x))
    x = with_scalars(x, rest).withColumn("amount_a", F.coalesce("amount_a", "_rest"))
    x = x.withColumns(family_features("n_sib", "n_par")).withColumn("amount_bin", qcut("amount_b", edges))
    x = x.withColumn("deck_safe", flag(first_char("unit_code").isin(SAFE_DECKS)))
    x = count_lookup(x, "ticket", "ticket_group", source)
    return x.select("id", *RECIPES[n_features], "label")


def wide_recipe(b: DataFrame, learn: DataFrame | None = None) -> DataFrame:
    """I16, 20 columns: one-hot title and region, amount_a by the median of its title, amount_b by its median where it
    is missing or zero, amounts per person and per class, group size of the ticket."""
    def titled(df):
        return _merged_title(df).withColumn("title", F.when(F.col("title").isin(list(TITLE_CODES)), F.col("title")).otherwise("Rare"))

    b, source = _written(b, learn)
    fit = titled(source)
    by_title = GroupImputer("amount_a", [["title"]], overall=False).fit(fit)
    median = group_median(fit, "amount_b", None, "_median")
    x = with_scalars(by_title.transform(titled(b)), median)
    x = x.withColumn("amount_b", F.when(F.col("amount_b") == 0, F.col("_median")).otherwise(F.coalesce("amount_b", "_median")))
    x = x.fillna({"region": "ASIA"}).withColumn("klass_num", F.substring("klass", 1, 1).cast("int"))
    x = x.withColumns(family_features("n_sib", "n_par")).withColumn("is_first_category", flag(F.col("category") == "O"))
    x = x.withColumns({**one_hot_fixed("region", ["AFRICA", "AMERICA", "ASIA"]), **one_hot_fixed("title", list(TITLE_CODES))})
    x = count_lookup(x, "ticket", "ticket_group", source)
    x = x.withColumns({"amount_per_person": F.col("amount_b") / F.col("family_size"), "amount_a_x_klass": F.col("amount_a") * F.col("klass_num"),
                       "amount_b_per_klass": F.col("amount_b") / F.col("klass_num")})
    return x.select("id", *RECIPES[20], "label")


MODEL_FEATURES = BASIC_FEATURES + ["amount_b"]
_FRAMES: dict = {}


def model_frame(spark, sf_dir: str, k: int = 5) -> DataFrame:
    """Train rows of the basic recipe plus the (train-median filled) amount_b
    and a stratified fold column; materialised once per session and scale in
    the shared checkpoint folder, so every model query reuses it and the
    lineage stays short."""
    from tabforge.operators.folds import stratified_folds
    from tabforge.operators.impute import GroupImputer
    from tabforge.plans.fixtures import base

    key = (id(spark), sf_dir, k)
    if key not in _FRAMES:
        # the fits, the fold ranking and the final write each read the input:
        # keep it for the duration of the build, then release it
        raw = base(spark, sf_dir).persist()
        # one lineage: fill amount_b in place, then build the recipe on that frame
        b = GroupImputer("amount_b", [["klass"]]).fit(raw.where(F.col("origin") == "train")).transform(raw)
        x = basic_recipe(b, keep=["amount_b", "origin", "ticket"])
        x = stratified_folds(x, "id", "label", k)
        _FRAMES[key] = cut_lineage(x)
        raw.unpersist()
    return _FRAMES[key]
