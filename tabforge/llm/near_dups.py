"""Near-duplicate classes by BagMinHash signatures over word shingles.

A text is the multiset of its ``size``-word shingles (lower-cased words; a
shorter text is one shingle). BagMinHash draws, for every shingle, Poisson
processes over the pieces [0,1), [1,2), [2,4), ... of its weight axis; points
come in order of time, each has a register and a height, and counts if the
height lies below the weight (the hierarchical split of the last piece). The
earliest time in a register is the signature: registers of two texts agree with
probability equal to the weighted Jaccard similarity. Points beyond a text's
latest register are never drawn, so that long texts cost about one each shingle.

128 registers give 25 bands of 5: a pair of similarity 0.8 shares a band with
probability 1 - (1 - 0.8**5)**25 > 0.9999. Four bits of every register estimate
the similarity; pairs estimated below 0.62 (over 4.5 standard deviations off at
0.8) are not read again. 512 parity bits (every shingle flips one) differ in at
most as many places as two multisets differ in shingles, which proves most pairs
of shorter texts just below the threshold apart before they are read. All others
are verified on their exact multisets.

Hot groups: equal multisets are one text (a partial aggregate); in a band bucket
every text meets a pivot only, over several rounds of bands. The pivot is the text
with the fullest buckets over all bands, as the texts nearest to the middle of a
group have the most links; buckets whose texts are of one component are done. What is left are texts of different
components in one bucket. Shingles that only one of them holds bound what it can
share: a text of n shingles, u of them its own, overlaps another by n - u at most,
which proves most of them apart without a pair. The rest is compared pair by
pair, so no link that a band found is lost.
Verification reads texts again (one scan a round, those in a bitmap of fixed size).

Defined results: texts without a word (null, empty, blank) are classes of their
own, one a row; rows with equal text are of one class whatever their ids; a
class's id is its smallest id (null if all are null); ``keep`` marks the rows
with the class's smallest id and text (equal repeated rows are all marked, see
``keep_first``); an empty table gives no rows.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.words import mix, powers, shingle_hashes, word_hashes
from tabforge.session import checkpoint_dir

REGISTERS, BANDS, BAND_ROWS, NIBBLES = 128, 25, 5, 8
PARITIES = 8  # words of 64 bits
_MAX_MISMATCH = 45  # of 128 four-bit codes
_ONES = 0x1111111111111111
_MASK = 2 ** 64 - 1


def bag_signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int = REGISTERS) -> np.ndarray:
    """(texts, m) registers as int64; bags: (distinct hashes, weights from 1)."""
    doc = np.repeat(np.arange(len(bags)), [len(e) for e, _ in bags])
    element = np.concatenate([e for e, _ in bags]) if bags else np.zeros(0, dtype=np.uint64)
    weight = np.concatenate([w for _, w in bags]).astype(np.int64) if bags else np.zeros(0, dtype=np.int64)
    parts = []
    piece = 0
    while True:  # piece 0 is [0, 1), piece j is [2**(j-1), 2**j)
        start = 0 if piece == 0 else 1 << (piece - 1)
        on = np.flatnonzero(weight > start)
        if not len(on):
            break
        parts.append((doc[on], mix(element[on], seed=100 + piece), weight[on] - start, np.full(len(on), max(1, start), dtype=np.float64)))
        piece += 1
    best = np.full(len(bags) * m, np.inf)
    if parts:
        d, key, room, width = (np.concatenate(x) for x in zip(*parts, strict=True))
        time, point = np.zeros(len(d)), 0
        while len(d):
            point += 1
            r = mix(key ^ np.uint64(point * 0x9E3779B97F4A7C15 & _MASK), seed=41)
            time = time - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53) / width
            s = mix(r, seed=42)
            register = (s >> np.uint64(57)).astype(np.int64) % m
            height = (s & np.uint64(0xFFFFFFFFFFFF)).astype(np.float64) / 2.0 ** 48 * width
            inside = height < room
            np.minimum.at(best, (d * m + register)[inside], time[inside])
            latest = best.reshape(-1, m).max(axis=1)
            on = time < latest[d]
            d, key, room, width, time = d[on], key[on], room[on], width[on], time[on]
    return best.reshape(-1, m).view(np.int64)


def text_shingles(text: str | None, size: int) -> np.ndarray:
    return shingle_hashes(word_hashes((text or "").lower().encode()), size)


def numbered(shingles: np.ndarray) -> np.ndarray:
    """A multiset as a sorted set: the nth copy of a hash becomes a hash of both."""
    return np.sort(_numbered(*np.unique(shingles, return_counts=True)))


def _numbered(value: np.ndarray, count: np.ndarray) -> np.ndarray:
    again = np.repeat(value, count)
    nth = np.arange(len(again)) - np.repeat(np.cumsum(count) - count, count)
    return mix(again + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), seed=9)


def parity(value: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(PARITIES,) int64: each member of the multiset flips one bit."""
    cells = (_numbered(value, count) >> np.uint64(33)).astype(np.int64) % (64 * PARITIES)
    odd = (np.bincount(cells, minlength=64 * PARITIES) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


def _sketch(size: int, names: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                all_ = [text_shingles(t, size) for t in part.column(2).to_pylist()]
                n = np.array([len(s) for s in all_], dtype=np.int64)
                prints = np.array([[int(mix(s, seed=21).sum()), int(mix(s, seed=22).sum())] for s in all_], dtype=np.uint64).reshape(-1, 2).view(np.int64)
                full = np.flatnonzero(n)
                signature = np.zeros((len(n), REGISTERS), dtype=np.uint64)
                bags = [np.unique(all_[i], return_counts=True) for i in full]
                signature[full] = bag_signatures(bags).view(np.uint64)
                odd = np.zeros((len(n), PARITIES), dtype=np.int64)
                for i, bag in zip(full, bags, strict=True):
                    odd[i] = parity(*bag)
                grouped = mix(signature[:, :BANDS * BAND_ROWS]).reshape(len(n), BANDS, BAND_ROWS)
                bands = mix((grouped * powers(0x9E3779B97F4A7C15, BAND_ROWS)).sum(axis=2) + np.arange(BANDS, dtype=np.uint64))
                code = (mix(signature, seed=77) & np.uint64(15)).reshape(len(n), NIBBLES, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
                code = np.bitwise_or.reduce(code, axis=2)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
                     _fixed(bands.view(np.int64)), *(pa.array(code[:, i].view(np.int64)) for i in range(NIBBLES)),
                     *(pa.array(odd[:, i]) for i in range(PARITIES))], names=names)
    return work


def _fixed(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.reshape(-1))


def _bitmap(keys: DataFrame, log2: int) -> np.ndarray:
    """Bits of the keys' low ``log2`` bits; its size is fixed, and a full one lets every text through."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            cell = batch.column(0).to_numpy()
            for chunk in np.unique(cell >> 16):
                own = cell[cell >> 16 == chunk] & 0xFFFF
                bits = held.setdefault(int(chunk), np.zeros(1 << 13, dtype=np.uint8))
                np.bitwise_or.at(bits, own >> 3, (1 << (own & 7)).astype(np.uint8))
        for chunk, bits in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([bits.tobytes()], pa.binary())], names=["chunk", "bits"])

    cells = keys.select(F.col("key").bitwiseAND(F.lit((1 << log2) - 1)).alias("cell")).distinct()
    packed = cells.repartition(32, F.shiftright("cell", 16)).mapInArrow(pack, "chunk long, bits binary")
    out = np.zeros(1 << (log2 - 3), dtype=np.uint8)
    for row in packed.collect():  # at most 2**(log2 - 16) rows of 8 KB
        out[row["chunk"] << 13:(row["chunk"] + 1) << 13] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def _sets(docs: DataFrame, keys: DataFrame, size: int, log2: int) -> tuple[DataFrame, Broadcast]:
    """(key, set): numbered shingles of the texts with these keys, and of few others; the bitmap to free after use."""
    wanted = docs.sparkSession.sparkContext.broadcast(_bitmap(keys, log2))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column(0).to_numpy() & ((1 << log2) - 1)
            take = np.flatnonzero(wanted.value[cell >> 3] >> (cell & 7).astype(np.uint8) & 1)
            for at in range(0, len(take), 256):
                part = batch.take(pa.array(take[at:at + 256]))
                sets = [numbered(text_shingles(t, size)).view(np.int64) for t in part.column(1).to_pylist()]
                edge = np.zeros(len(sets) + 1, dtype=np.int32)
                np.cumsum([len(s) for s in sets], out=edge[1:])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(edge, np.concatenate(sets))], names=["key", "set"])

    return docs.select("_key", "_text").mapInArrow(read, "key long, set array<long>"), wanted


def _own_shingles(docs: DataFrame, keys: DataFrame, size: int, log2: int) -> DataFrame:
    """(key, own): how many shingles of each text no other of these texts holds (or fewer)."""
    sets, bitmap = _sets(docs, keys, size, log2)
    alone = sets.select("key", F.explode("set").alias("s")).groupBy("s").agg(F.count("*").alias("k"), F.min("key").alias("key")).where("k = 1")
    own = _written(alone.groupBy("key").agg(F.count("*").alias("own")))
    bitmap.unpersist()
    return own


def _verified(docs: DataFrame, pairs: DataFrame, size: int, threshold: float, log2: int) -> DataFrame:
    """The pairs (a, b; keys ka, kb) whose multisets overlap by ``threshold`` or more."""
    pairs = _written(pairs)
    sets, bitmap = _sets(docs, pairs.select(F.explode(F.array("ka", "kb")).alias("key")), size, log2)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            left, right = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                same.append(both >= threshold * (len(x) + len(y) - both) - 1e-9)
            hit = np.flatnonzero(same)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(hit)), batch.column(1).take(pa.array(hit))], names=["a", "b"])

    joined = (pairs.join(sets.select(F.col("key").alias("ka"), F.col("set").alias("x")), "ka")
              .join(sets.select(F.col("key").alias("kb"), F.col("set").alias("y")), "kb").select("a", "b", "x", "y"))
    found = _written(joined.mapInArrow(compare, "a long, b long").distinct())
    bitmap.unpersist()
    return found


def _release(spark: SparkSession) -> None:
    """Executors delete shuffle files only once the driver has collected what refers to them, which a calm driver puts off."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _written(df: DataFrame) -> DataFrame:
    """A table in the shared folder, read again: later phases scan the columns they use, and small files of many tasks
    share a task. What the phase left on the driver (plans, task records, map outputs) goes before the next one begins."""
    spark, schema = df.sparkSession, df.schema
    path = f"{checkpoint_dir(spark).rstrip('/')}/near-dups-{uuid.uuid4().hex}"
    df.write.parquet(path)
    del df
    _release(spark)
    return spark.read.schema(schema).parquet(path)


def components(links: DataFrame, known: DataFrame | None = None, whole: bool = True) -> DataFrame:
    """(v, c): the smallest vertex of each linked vertex's component; ``known`` is an earlier answer for some links.

    Without ``whole`` one step is taken: vertices of one name are linked, but linked ones may still differ.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    names = both.select(F.col("a").alias("v")).distinct()
    if known is not None:
        names = names.join(known, "v", "left").select("v", F.coalesce("c", "v").alias("c"))
    else:
        names = names.select("v", F.col("v").alias("c"))
    names = _written(names)
    while True:
        near = (both.join(names, both["b"] == names["v"]).groupBy(F.col("a").alias("n")).agg(F.min("c").alias("m")))
        low = names.join(near, names["v"] == near["n"], "left").select("v", F.col("c").alias("was"), F.least("c", F.coalesce("m", "c")).alias("c"))
        # a whole component moves with its lowest member, then names are followed once
        roots = low.groupBy(F.col("was").alias("r")).agg(F.min("c").alias("rc"))
        low = low.join(roots, low["was"] == roots["r"]).select("v", "was", F.least("c", "rc").alias("c"))
        hop = low.select(F.col("v").alias("h"), F.col("c").alias("hc"))
        low = low.join(hop, low["c"] == hop["h"], "left").select("v", "was", F.coalesce("hc", "c").alias("c"))
        new = _written(low)
        if not whole or new.where("c <> was").isEmpty():
            return new.select("v", "c")
        names = new.select("v", "c")


def _mismatches(a: str, b: str):
    total = F.lit(0)
    for i in range(NIBBLES):
        x = F.col(f"{a}s{i}").bitwiseXOR(F.col(f"{b}s{i}"))
        any_ = x.bitwiseOR(F.shiftright(x, 1)).bitwiseOR(F.shiftright(x, 2)).bitwiseOR(F.shiftright(x, 3))
        total = total + F.bit_count(any_.bitwiseAND(F.lit(_ONES)))
    return total


def _odd_places(a: str, b: str):
    total = F.lit(0)
    for i in range(PARITIES):
        total = total + F.bit_count(F.col(f"{a}o{i}").bitwiseXOR(F.col(f"{b}o{i}")))
    return total


def _likely(threshold: float):
    """Sizes and parities that allow the similarity, and enough equal register codes."""
    differ = (F.col("n") + F.col("pn")) * F.lit((1 - threshold) / (1 + threshold))  # shingles of one text only, at most
    return ((F.least("pn", "n") >= F.lit(threshold) * F.greatest("pn", "n"))
            & (_odd_places("", "p") <= differ + 1e-6) & (_mismatches("", "p") <= _MAX_MISMATCH))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.8,
                    rounds: int = 2, bitmap_log2: int = 23) -> DataFrame:
    """One row per document: id, class_id, class_size (rows), keep, text_key, linked (the text has a near copy)."""
    _release(df.sparkSession)
    docs = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    docs = docs.withColumn("_key", F.xxhash64("_id", "_text"))
    id_type = docs.schema["_id"].dataType.simpleString()
    codes = [f"s{i}" for i in range(NIBBLES)] + [f"o{i}" for i in range(PARITIES)]
    names = ["_id", "_key", "n", "f", "g", "bands", *codes]
    sketched = _written(docs.select("_id", "_key", "_text").mapInArrow(
        _sketch(size, names), f"_id {id_type}, _key long, n long, f long, g long, bands array<long>, " + ", ".join(f"{c} long" for c in codes)))
    texts = (sketched.where("n > 0").groupBy("f", "g", "n")
             .agg(F.min(F.struct(F.col("_id").isNull().alias("x"), "_id", "_key")).alias("_first"), F.count("*").alias("copies"),
                  F.first("bands").alias("bands"), *[F.first(c).alias(c) for c in codes])
             .select(F.monotonically_increasing_id().alias("v"), "f", "g", "n", F.col("_first._id").alias("rep"),
                     F.col("_first._key").alias("key"), "copies", "bands", *codes))
    texts = _written(texts)  # from here the numbers v are fixed
    band = texts.select("v", F.posexplode("bands").alias("i", "band"))
    crowded = band.groupBy(F.col("band").alias("_b")).agg(F.count("*").alias("k")).where("k > 1")
    multi = band.join(crowded, F.col("band") == F.col("_b")).select("v", "i", "band", "k")
    crowd = multi.groupBy(F.col("v").alias("_v")).agg(F.sum("k").alias("crowd"))
    multi = _written(multi.join(crowd, F.col("v") == F.col("_v")).select("v", "i", "band", "crowd"))
    codes_of = texts.select("v", "key", "n", *codes)
    pivot_codes = codes_of.select(F.col("v").alias("p"), F.col("key").alias("pkey"), F.col("n").alias("pn"), *[F.col(c).alias(f"p{c}") for c in codes])

    links: DataFrame | None = None
    comp: DataFrame | None = None

    def members() -> DataFrame:
        if comp is None:
            return multi.withColumn("c", F.col("v"))
        return multi.join(comp, "v", "left").select("v", "i", "band", "crowd", F.coalesce("c", "v").alias("c"))

    def settle(pairs: DataFrame, last: bool = False) -> None:
        nonlocal links, comp
        new = _verified(docs, pairs.select(F.col("v").alias("a"), F.col("p").alias("b"), F.col("key").alias("ka"), F.col("pkey").alias("kb")),
                        size, threshold, bitmap_log2)
        links = new if links is None else links.unionByName(new)
        comp = components(links, comp, last)

    for r in range(rounds):  # each round takes its share of the bands: most copies are linked by the first
        rows = members().where(F.col("i") % rounds == r)
        pivot = (rows.groupBy(F.col("band").alias("_b"))
                 .agg(F.min(F.struct((-F.col("crowd")).alias("h"), "v", "c")).alias("p"), F.min("c").alias("lo"), F.max("c").alias("hi"))
                 .where("lo < hi").select("_b", F.col("p.v").alias("p"), F.col("p.c").alias("pc")))
        star = rows.join(pivot, F.col("band") == F.col("_b")).where("c <> pc").select("v", "p").distinct()
        settle(star.join(codes_of, "v").join(pivot_codes, "p").where(_likely(threshold)))
    rows = _written(members())
    apart = rows.groupBy(F.col("band").alias("_b")).agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("_b")
    rows = _written(rows.join(apart, F.col("band") == F.col("_b")).select("v", "band", "c").join(codes_of, "v"))
    own = _own_shingles(docs, rows.select("key"), size, bitmap_log2).withColumnRenamed("key", "_k")
    rows = rows.join(own, F.col("key") == F.col("_k"), "left").drop("_k").withColumn("u", F.col("n") - F.coalesce("own", F.lit(0)))
    rows = rows.where(F.col("u") >= F.lit(threshold) * F.col("n") - 1e-9)
    other = rows.select(F.col("v").alias("p"), F.col("band").alias("pband"), F.col("c").alias("pc"), F.col("key").alias("pkey"), F.col("n").alias("pn"),
                        F.col("u").alias("pu"), *[F.col(c).alias(f"p{c}") for c in codes])
    most = F.least("u", "pu")  # the overlap is never larger
    able = most >= F.lit(threshold) * (F.col("n") + F.col("pn") - most) - 1e-9
    settle(rows.join(other, (F.col("band") == F.col("pband")) & (F.col("v") < F.col("p")) & (F.col("c") != F.col("pc")) & able & _likely(threshold))
           .select("v", "p", "key", "pkey").distinct(), last=True)

    named = texts.select("v", "f", "g", "n", "rep", "key", "copies").join(comp, "v", "left").withColumn("linked", F.col("c").isNotNull())
    named = named.withColumn("c", F.coalesce("c", "v"))
    classes = (named.groupBy("c").agg(F.min(F.struct(F.col("rep").isNull().alias("x"), "rep", "key")).alias("_first"), F.sum("copies").alias("class_size"))
               .select(F.col("c").alias("_c"), F.col("_first.rep").alias("class_id"), F.col("_first.key").alias("class_key"), "class_size"))
    named = (named.join(classes, F.col("c") == F.col("_c"))
             .select(F.col("f").alias("_f"), F.col("g").alias("_g"), F.col("n").alias("_n"), "class_id", "class_key", "class_size", "linked"))
    full = (sketched.where("n > 0").select("_id", "_key", "f", "g", "n")
            .join(named, (F.col("f") == F.col("_f")) & (F.col("g") == F.col("_g")) & (F.col("n") == F.col("_n")))
            .select(F.col("_id").alias(id_col), "class_id", "class_size", (F.col("_key") == F.col("class_key")).alias("keep"),
                    F.col("_key").alias("text_key"), "linked"))
    empty = (sketched.where("n = 0").select(F.col("_id").alias(id_col), F.col("_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
                                            F.lit(True).alias("keep"), F.col("_key").alias("text_key"), F.lit(False).alias("linked")))
    return full.unionByName(empty)


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` with one document of each class; texts without a word all stay."""
    found = near_duplicates(df, id_col, text_col, **options)
    stay = found.where("keep").select(F.col("text_key").alias("_stay")).distinct()
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    blank = ~F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = df.withColumn("_stay", key)
    kept = rows.where(~blank).join(stay, "_stay", "left_semi").dropDuplicates(["_stay"])
    return kept.select(df.columns).unionByName(rows.where(blank).select(df.columns))
