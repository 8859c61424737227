"""The mix has an order: slots of all sources are interleaved by weight, and the pipeline stage keeps it."""

import collections

from pyspark.sql import functions as F

from tabforge.llm import mixing
from tests.llm.conftest import SF

BLOCK = 64


def test_slots_interleave_sources_by_weight(spark):
    df = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"),
                                 F.array_join(F.array_repeat(F.lit("word"), 30), " ").alias("text"))
    rows = mixing.mix_pieces(df, weights=(2, 1), share="0.9", block=BLOCK).orderBy("slot", "at").collect()
    taken = collections.Counter()
    for r in rows:
        taken[r["doc_id"]] += r["words"]
        assert 0 < r["words"] <= BLOCK and 0 <= r["begin"] and r["begin"] + r["words"] <= 30
    said = {r["doc_id"]: r for r in mixing.mix_sources(df, weights=(2, 1), share="0.9", block=BLOCK).collect()}
    assert {i: r["taken"] for i, r in said.items() if r["taken"]} == dict(taken)
    assert len({(r["slot"], r["source"], r["block"]) for r in rows}) == len({r["slot"] for r in rows})
    # a reader that stops after any third of the mix has both sources near their weights
    target = {r["source"]: r["target"] for r in said.values()}
    third = len(rows) // 3
    for part in (rows[:third], rows[third:2 * third], rows[2 * third:]):
        words = collections.Counter()
        for r in part:
            words[r["source"]] += r["words"]
        assert abs(words["a"] / sum(words.values()) - target["a"] / sum(target.values())) < 0.1
    begins = {}
    for r in rows:
        begins.setdefault((r["doc_id"], r["turn"]), (r["slot"], r["at"]))
    assert {(i, t): tuple(p) for i, r in said.items() for t, p in enumerate(r["slots"]) if p} == begins


def test_pipeline_stage_emits_the_order(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    place = []
    for r in mixing.mix_sources(docs, keep=["text"]).collect():
        passes = int(r["taken"] / r["size"] + 0.5) if r["size"] else 0
        place += [(p["slot"], p["at"], r["doc_id"]) for p in r["slots"][:passes]]
    got = [r["doc_id"] for r in corpus_pipeline.mix_to_weights(spark, docs, SF).select("doc_id").collect()]
    assert got == [i for _, _, i in sorted(place)] and len(got) > docs.count()
