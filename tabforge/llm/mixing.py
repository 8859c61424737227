"""Mixing sources to target weights by a low-discrepancy schedule.

The schedule has one slot per block of ``block`` words. Slot n is the point
frac((n + 1) * golden ratio); the source whose cumulative weight interval holds
the point owns the slot, and the slots of a source are ranked in order. Each
source's documents, shuffled by a seeded hash, form one stream of words cut
into equal blocks; the slot of rank r reads block ``r mod blocks`` (a second
pass repeats the stream). Slots beyond a source's need are left out, the few
that the sequence leaves short follow at the end, and the last one is cut, so
that a source gives exactly ``floor(target)`` words.

``mix_pieces`` is the mix itself, slot by slot; ``mix_sources`` sums it by document and says at which slot each pass
of a document begins. The need of a source follows from its target alone; which slot reads a block, and so the
order of the mix, follows from the schedule.

Targets: sources by code point, null last, weigh ``weights`` in turn and share
``share`` times all sizes; a target stops at ``max_passes`` times its source's
size, and what is over is shared anew by weight until none is above.

Scale: sizes are counted once; a hot source is spread over hash buckets whose
offsets come from a small (source, bucket) table; slots are ranked by chunk of
the schedule, again with offsets from a small table. Only one row per source
reaches the driver. Documents join slots on (source, block), so that no key
holds more than a block's documents.

Defined results: a null text or one without words has size 0 and takes nothing;
repeated rows are documents of their own; a null source is a source; an empty
table gives no rows. Equal rows (same id, size, and source) are interchangeable:
ties in the shuffle are broken by id and size, and rows that still tie share
one place after another.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = (math.sqrt(5) - 1) / 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: list[int], share: Fraction, max_passes: int) -> dict[str | None, Fraction]:
    """Exact water filling of ``share`` times all sizes."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), list(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > max_passes * sizes[s]]
        if not over:
            return out | {s: unit * weight[s] for s in free}
        for s in over:
            out[s] = Fraction(max_passes * sizes[s])
            left -= out[s]
            free.remove(s)
    return out


def _ranked(df: DataFrame, group: list[str], coarse: str, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Exclusive running sum of ``amount`` in a group, by ``coarse`` bucket, then ``order``.

    Rows of a hot group are summed bucket by bucket; the bucket totals are a
    small table of their own.
    """
    totals = df.groupBy(*group, coarse).agg(F.sum(amount).alias("_t"))
    ahead = Window.partitionBy(*group).orderBy(coarse).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col(coarse).alias("_c"),
                            F.coalesce(F.sum("_t").over(ahead), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(*group, coarse).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    on = F.col(coarse) == F.col("_c")
    for i, g in enumerate(group):
        on &= F.col(g) == F.col(f"_g{i}")
    return (df.withColumn("_in", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
            .join(offsets, on).withColumn(name, F.col("_in") + F.col("_off"))
            .drop("_in", "_off", "_c", *[f"_g{i}" for i in range(len(group))]))


def _schedule(spark, plan: list[tuple], total_slots: int) -> DataFrame:
    """(source index, rank, slot) for every slot that the plan needs; slots ascend with the mix, with gaps.

    plan: (index, upper end of its interval, needed slots) in index order.
    """
    point = F.expr(f"pmod((id + 1) * {GOLDEN!r}D, 1.0D)")
    owner = F.coalesce(*[F.when(point < F.lit(float(up)), F.lit(i)) for i, up, _ in plan], F.lit(plan[-1][0]))
    chunks = 1 << 12
    slots = spark.range(total_slots).select("id", owner.alias("src"), F.floor(F.col("id") / chunks).alias("chunk"))
    slots = _ranked(slots, ["src"], "chunk", [F.col("id")], F.lit(1), "rank")
    need = F.coalesce(*[F.when(F.col("src") == i, F.lit(n)) for i, _, n in plan])
    slots = slots.withColumn("need", need)
    had = slots.groupBy("src").agg(F.count("*").alias("had"))
    short = (spark.createDataFrame([(i, n) for i, _, n in plan], "src int, need long").join(had, "src", "left")
             .select("src", F.explode(F.when(F.coalesce("had", F.lit(0)) < F.col("need"),
                                             F.sequence(F.coalesce("had", F.lit(0)), F.col("need") - 1))).alias("rank")))
    late = F.lit(total_slots) + F.col("rank") * len(plan) + F.col("src")  # after all others, sources in turn
    return (slots.where("rank < need").select("src", "rank", F.col("id").alias("slot"))
            .unionByName(short.select("src", "rank", late.alias("slot"))))


def _pieces(df: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], share: str,
            max_passes: int, block: int, seed: int) -> tuple[DataFrame, DataFrame | None]:
    """Documents that give nothing, and the stretches of the others by slot (one without slot where none reads it)."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias(id_col), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    # texts are read once; what follows works on a few bytes a document
    docs = cut_lineage(docs)
    sizes = {r["source"]: r["n"] for r in docs.groupBy("source").agg(F.sum("size").alias("n")).collect()}  # one row per source
    if not sizes:
        return docs.withColumn("source_size", F.lit(0).cast("long")).withColumn("target", F.lit(0.0)), None
    goal = targets(sizes, list(weights), Fraction(share), max_passes)
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    rows, plan, acc, whole = [], [], Fraction(0), sum(goal.values())
    for i, s in enumerate(order):
        words, blocks = math.floor(goal[s]), -(-sizes[s] // block)
        acc += goal[s]
        passes, rest = divmod(words, max(1, sizes[s]))  # the last block of a pass is short
        rows.append((i, s, sizes[s], float(goal[s]), words, max(1, blocks)))
        plan.append((i, acc / whole if whole else 0, passes * blocks - (-rest // block)))
    table = spark.createDataFrame(rows, "src int, _source string, source_size long, target double, words long, blocks long")
    docs = docs.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    if not whole:
        return docs, None

    place = F.xxhash64(F.lit(seed), F.col(id_col), F.col("size"))
    bucket_words = max(1 << 16, 8 * math.isqrt(sum(sizes.values())))  # documents in a bucket and buckets grow alike
    buckets = F.ceil(F.greatest(F.col("source_size"), F.lit(1)) / bucket_words)
    docs = docs.withColumn("_h", place).withColumn("_b", F.pmod("_h", buckets))
    docs = _ranked(docs, ["src"], "_b", [F.col("_h"), F.col(id_col).asc_nulls_last(), F.col("size")], F.col("size"), "start")
    # a document's stretch of the stream, cut where blocks begin
    piece = (docs.where("size > 0")
             .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))))
             .withColumn("lo", F.greatest("start", F.col("block") * block))
             .withColumn("hi", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block))).drop("words", "blocks")
    total = sum(n for _, _, n in plan)
    slot = (_schedule(spark, plan, total).join(F.broadcast(table.select("src", "source_size", "words", "blocks")), "src")
            .select("src", "slot", F.pmod("rank", "blocks").alias("block"), F.floor(F.col("rank") / F.col("blocks")).alias("turn"),
                    "source_size", "words"))
    # the words of the stream that this turn may still read: all but in the last
    until = F.greatest(F.lit(0), F.col("words") - F.col("turn") * F.col("source_size"))
    slot = slot.groupBy("src", "block").agg(F.collect_list(F.struct("slot", "turn", until.alias("until"))).alias("_reads"))  # one entry a pass
    reads = F.filter("_reads", lambda r: F.least(F.col("hi"), r["until"]) > F.col("lo"))
    piece = (piece.join(slot, ["src", "block"], "left").withColumn("_read", F.explode_outer(reads))
             .withColumn("slot", F.col("_read.slot")).withColumn("turn", F.col("_read.turn"))
             .withColumn("words", F.coalesce(F.least("hi", "_read.until") - F.col("lo"), F.lit(0)).cast("long")))
    return docs.where("size = 0"), piece.drop("_reads").withColumn("words", F.when(F.col("slot").isNull(), 0).otherwise(F.col("words")))


def mix_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = (5, 2, 1), share: str = "1.5", max_passes: int = 2,
               block: int = 16384, seed: int = 17) -> DataFrame:
    """The mix: one row per stretch of a document that a slot reads.

    slot (its place in the mix), source, block, turn (pass over the source, from 0), at (first word in the source's
    stream), id, begin (first word in the document), words. In the order of (slot, at) the rows are the mix.
    """
    idle, piece = _pieces(df, id_col, text_col, source_col, weights, share, max_passes, block, seed)
    if piece is None:
        zero = F.lit(0).cast("long")
        return idle.limit(0).select(zero.alias("slot"), "source", zero.alias("block"), zero.alias("turn"), zero.alias("at"),
                                    id_col, zero.alias("begin"), zero.alias("words"))
    return piece.where("slot IS NOT NULL").select("slot", "source", "block", "turn", F.col("lo").alias("at"), id_col,
                                                  (F.col("lo") - F.col("start")).alias("begin"), "words")


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (5, 2, 1), share: str = "1.5", max_passes: int = 2,
                block: int = 16384, seed: int = 17, keep: list[str] | None = None) -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken (words the mix takes) and slots, which has
    for each pass the place where the document begins in it, (slot, at) as in ``mix_pieces``, or null.

    Columns named in ``keep`` come back by a join on a hash of id, source and text; rows that agree in all three
    get the mean of what they take and the first of their places.
    """
    if keep is not None:
        return _kept(df, id_col, text_col, source_col, keep, weights, share, max_passes, block, seed)
    idle, piece = _pieces(df, id_col, text_col, source_col, weights, share, max_passes, block, seed)
    nowhere = F.array(*[F.lit(None).cast("struct<slot:bigint,at:bigint>")] * max_passes)
    idle = idle.select(id_col, "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"), nowhere.alias("slots"))
    if piece is None:
        return idle
    taken = (piece.groupBy("src", "start").agg(
        F.first(id_col).alias(id_col), F.first("source").alias("source"), F.first("size").alias("size"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sum("words").alias("taken"),
        F.array(*[F.min(F.when(F.col("turn") == t, F.struct("slot", F.col("lo").alias("at")))) for t in range(max_passes)]).alias("slots")))
    return taken.select(id_col, "source", "size", "source_size", "target", "taken", "slots").unionByName(idle)


def _kept(df: DataFrame, id_col: str, text_col: str, source_col: str, keep: list[str], *settings) -> DataFrame:
    weights, share, max_passes, block, seed = settings
    key = F.xxhash64(id_col, source_col, text_col)
    keyed = df.select(key.alias("_key"), F.col(source_col).alias("_src"), F.col(text_col).alias("_txt"))
    mixed = mix_sources(keyed, "_key", "_txt", "_src", weights, share, max_passes, block, seed)
    mixed = (mixed.groupBy("_key").agg(F.first("source").alias("source"), F.first("size").alias("size"), F.first("source_size").alias("source_size"),
                                       F.first("target").alias("target"), F.floor(F.avg("taken") + 0.5).cast("long").alias("taken"),
                                       F.array(*[F.min(F.col("slots")[t]) for t in range(max_passes)]).alias("slots")))
    rows = df.select(F.col(id_col).alias(id_col), key.alias("_key"), *map(F.col, keep))
    return rows.join(mixed, "_key").drop("_key")
