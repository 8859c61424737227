"""Corpus pipeline: five stages over ``documents``, each judged on what the one before kept.

``STAGES`` names the stages in order; every function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import language, mixing, near_dups, pieces, substrings
from tabforge.llm.queries import TOKENIZER, table
from tabforge.session import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents below this calibrated probability have no clear language.
MIN_LANGUAGE_SCORE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those of no clear language; the label stays as it is."""
    model = language.train(docs)
    return language.predict(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one with the smallest id."""
    return near_dups.keep_first(docs).select(COLUMNS)


def cut_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages that a document with a smaller id holds; other texts stay as they are."""
    found = substrings.dedup_substrings(docs, keep=["text", "lang", "source", "n_chars"])
    text = F.when(F.col("changed"), F.col("kept_text")).otherwise(F.col("text"))
    return found.select("doc_id", text.alias("text"), "lang", "source",
                        F.when(F.col("changed"), F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document appears as often as the mix takes its words, to the nearest whole pass (none, once or twice), in the
    order of the mix: each pass where the schedule's slots first read the document."""
    taken = mixing.mix_sources(docs, keep=["text", "lang", "n_chars"])
    passes = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(F.lit(0))
    return (taken.withColumn("_passes", passes).where("_passes > 0")
            .select(*COLUMNS, "_passes", F.posexplode("slots").alias("_turn", "_place")).where("_turn < _passes")
            .orderBy("_place.slot", "_place.at", "doc_id").select(COLUMNS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids with byte spans; ``round_trip`` tells whether the ids decode to the text."""
    coded = pieces.encode(docs, TOKENIZER, decoded=True, keep=["source", "text"])
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "begins", "ends",
                        F.coalesce(F.col("decoded") == F.col("text"), F.col("text").isNull()).alias("round_trip"))


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_substrings),
    ("mixing sources to target weights", mix_to_weights),
    ("SentencePiece encoding and decoding", tokenize),
]
#: Trained models, signatures and piece merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared checkpoint folder and read again."""
    import uuid

    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        path = f"{base}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
