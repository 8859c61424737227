"""Substring dedup over windows of ``window`` words with a count-min prefilter.

A word goes if a window that covers it also starts in a document with a smaller
id; windows are judged on the input. The count of a window is overestimated by
the count of its *anchor*: the gram of ``gram`` words with the smallest hash
among those inside the window (ties: the leftmost). Equal windows have equal
anchors, and neighbouring windows share one, so a sketch of anchors holds about
one item for 16 words.

Pass 1: every task adds its anchors to a count-min sketch saturated at two,
held as bit planes (once, twice) of ``1 << cells_log2`` cells a row; planes
merge by AND/OR, chunk by chunk, and their size is fixed by the parameter.
Pass 2: anchors that the merged sketch holds as repeated (never fewer than are)
become rows; with 128 bits of hash they are grouped exactly. If all stretches of
text around an anchor are the same, the anchor decides all its windows at once;
otherwise its windows are grouped one by one. A saturated sketch lets more rows
through and loses none: at most one row for each 16 words and eight bytes a
window. Marks join the texts on a hash of id and text.

Every group is a partial aggregate (min and max), and the join back has no
group in one task: a hot passage is a hot join key, which adaptive execution
splits. The driver holds the merged planes alone (``cells_log2`` bits a row).

Defined results: a null or empty text has no word and keeps the empty string;
rows with a null id are neither changed nor count for others; rows with the same
id never remove from each other; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.words import mix, window_hashes, word_hashes
from tabforge.session import cut_lineage

CHUNK = 1 << 16  # bytes of a plane that merge together
ROWS = 2


def anchors(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, windows) of each run of windows that share an anchor place."""
    if len(words) < window:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    grams = window_hashes(words, gram, seed=3)
    reach = window - gram + 1
    n = len(words) - window + 1
    place = np.arange(n)
    step = 1 << 13  # bounds the scratch of long texts: argmin copies (step, reach) hashes
    for at in range(0, n, step):
        end = min(n, at + step)
        place[at:end] += np.lib.stride_tricks.sliding_window_view(grams[at:end + reach - 1], reach).argmin(axis=1)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return grams[place[first]], first, np.diff(np.append(first, n))


def _cells(hashes: np.ndarray, log2: int) -> list[np.ndarray]:
    return [(mix(hashes, seed=11 + r) >> np.uint64(64 - log2)).astype(np.int64) for r in range(ROWS)]


class Planes:
    """Bit planes of a count-min sketch whose counts stop at two."""

    def __init__(self, log2: int):
        self.log2 = log2
        self.once = np.zeros((ROWS, 1 << (log2 - 3)), dtype=np.uint8)
        self.twice = np.zeros_like(self.once)

    def add(self, hashes: np.ndarray) -> None:
        for r, cells in enumerate(_cells(hashes, self.log2)):
            cell, count = np.unique(cells, return_counts=True)
            byte, bit = cell >> 3, (1 << (cell & 7)).astype(np.uint8)
            again = (self.once[r][byte] & bit).astype(bool) | (count > 1)
            np.bitwise_or.at(self.twice[r], byte[again], bit[again])
            np.bitwise_or.at(self.once[r], byte, bit)

    def chunks(self) -> Iterator[tuple[int, bytes]]:
        per = max(1, self.once.shape[1] // CHUNK)
        size = self.once.shape[1] // per
        for r in range(ROWS):
            for c in range(per):
                part = slice(c * size, (c + 1) * size)
                if self.once[r][part].any():
                    yield r * per + c, zlib.compress(self.once[r][part].tobytes() + self.twice[r][part].tobytes(), 1)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for key, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            new = np.frombuffer(zlib.decompress(blob), dtype=np.uint8).reshape(2, -1)
            if key in held:
                once, twice = held[key]
                held[key] = np.stack([once | new[0], twice | new[1] | (once & new[0])])
            else:
                held[key] = new
    for key, (_, twice) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())],
                                         names=["chunk", "plane"])


def repeated_cells(docs: DataFrame, window: int, gram: int, log2: int) -> np.ndarray:
    """The merged plane of cells that count two or more, (ROWS, bytes)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            for start in range(0, batch.num_rows, 256):  # bounds what is unpacked at once; the worker stays alive for later stages
                found = [anchors(word_hashes(t), window, gram)[0] for t in batch.column(0).slice(start, 256).to_pylist() if t]
                if found:
                    planes = planes or Planes(log2)
                    planes.add(np.concatenate(found))
        for key, blob in planes.chunks() if planes else ():
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([blob], pa.binary())], names=["chunk", "plane"])

    merged = (docs.select("_text").mapInArrow(sketch, "chunk int, plane binary")
              .repartition(32, "chunk").mapInArrow(_merge, "chunk int, plane binary"))
    plane = np.zeros((ROWS, 1 << (log2 - 3)), dtype=np.uint8)
    per = max(1, plane.shape[1] // CHUNK)
    size = plane.shape[1] // per
    for row in merged.collect():  # at most ROWS * per chunks
        r, c = divmod(row["chunk"], per)
        plane[r, c * size:(c + 1) * size] = np.frombuffer(zlib.decompress(row["plane"]), dtype=np.uint8)
    return plane


def _key(id_col: Column, text: Column) -> Column:
    return F.xxhash64(id_col, text)


def repeated_stretches(docs: DataFrame, window: int, gram: int, log2: int) -> DataFrame:
    """(key, first, windows): runs of windows that also start in a document with a smaller id."""
    plane = docs.sparkSession.sparkContext.broadcast(repeated_cells(docs, window, gram, log2))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                keys, ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()
                out: list[list] = [[] for _ in range(7)]
                for key, doc, text in zip(keys, ids, texts, strict=True):
                    words = word_hashes(text or b"")
                    anchor, first, count = anchors(words, window, gram)
                    if not len(anchor):
                        continue
                    held = np.ones(len(anchor), dtype=bool)
                    for r, cell in enumerate(_cells(anchor, log2)):
                        held &= (plane.value[r][cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
                    if not held.any():
                        continue
                    anchor, first, count = anchor[held], first[held], count[held]
                    one = window_hashes(words, window, seed=5)
                    last = first + count - 1
                    # the stretch: its first and last window (they overlap) and its length
                    stretch = mix(one[first], seed=7) ^ mix(one[last], seed=8) * (count.astype(np.uint64) * np.uint64(2) + np.uint64(1))
                    edge = np.concatenate([[0], np.cumsum(count)])
                    flat = one[np.repeat(first - edge[:-1], count) + np.arange(edge[-1])]
                    out[0].append(np.full(len(anchor), key, dtype=np.int64))
                    out[1].append(np.full(len(anchor), doc, dtype=np.int64))
                    for i, x in ((2, anchor), (3, stretch), (4, first), (5, count), (6, flat)):
                        out[i].append(x)
                if out[0]:
                    key, doc, anchor, stretch, first, count, flat = map(np.concatenate, out)
                    edge = np.zeros(len(count) + 1, dtype=np.int32)
                    np.cumsum(count, out=edge[1:])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(doc), pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64)),
                         pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32)),
                         pa.ListArray.from_arrays(edge, flat.view(np.int64))],
                        names=["key", "doc", "anchor", "stretch", "first", "count", "windows"])

    found = (docs.where("_id is not null").select("_key", "_id", "_text")
             .mapInArrow(candidates, "key long, doc long, anchor long, stretch long, first int, count int, windows array<long>"))
    found = cut_lineage(found)
    group = (found.groupBy("anchor").agg(F.min("doc").alias("least"), F.max("doc").alias("most"),
                                         (F.min("stretch") == F.max("stretch")).alias("same"))
             .where("least < most").drop("most").withColumnRenamed("anchor", "_anchor"))
    shared = found.join(group, F.col("anchor") == F.col("_anchor")).drop("_anchor")
    whole = shared.where("same and doc > least").select("key", "first", F.col("count").alias("n"))
    single = (shared.where("not same").select("key", "doc", "anchor", "first", F.posexplode("windows").alias("i", "w"))
              .select("key", "doc", "anchor", "w", (F.col("first") + F.col("i")).alias("at")))
    least = single.groupBy(F.col("anchor").alias("_a"), F.col("w").alias("_w")).agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    least = least.where("least < most").drop("most")
    marked = (single.join(least, (F.col("anchor") == F.col("_a")) & (F.col("w") == F.col("_w")))
              .where("doc > least").select("key", F.col("at").alias("first"), F.lit(1).alias("n")))
    return whole.unionByName(marked)


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = 20,
                     cells_log2: int = 25, keep: list[str] | None = None) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_text (kept words joined by a space), changed boolean,
    and the columns of ``df`` named in ``keep``."""
    if not 0 < gram <= window:
        raise ValueError("gram must be between 1 and window")
    along = df.select(*map(F.col, keep or ())).schema
    docs = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"), *[F.col(f.name).alias(f"_k{i}") for i, f in enumerate(along)])
    extra = [f"_k{i}" for i in range(len(along))]
    docs = docs.withColumn("_key", _key(F.col("_id"), F.col("_text")))
    id_type = docs.schema["_id"].dataType.simpleString()
    # one row per text with marks: runs of windows, a few bytes for each repeated passage
    marks = (repeated_stretches(docs, window, gram, cells_log2)
             .groupBy("key").agg(F.collect_set(F.struct("first", "n")).alias("runs")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                total, gone, kept, changed = [], [], [], []
                for text, runs in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    words = (text or b"").split()  # splits at the six ASCII blanks alone
                    n = len(words)
                    if runs:
                        cover = np.zeros(n + 1, dtype=np.int64)
                        first = np.array([r["first"] for r in runs])
                        np.add.at(cover, first, 1)
                        np.add.at(cover, first + np.array([r["n"] for r in runs]) + window - 1, -1)
                        stay = np.cumsum(cover[:n]) == 0
                        words = [w for w, s in zip(words, stay, strict=True) if s]
                    total.append(n)
                    gone.append(n - len(words))
                    changed.append(len(words) < n)
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()),
                     pa.array(changed, pa.bool_()), *part.columns[3:]],
                    names=[id_col, "n_words", "n_removed", "kept_text", "changed", *along.names])

    joined = docs.join(marks, F.col("_key") == F.col("key"), "left").select("_id", "_text", "runs", *extra)
    schema = f"`{id_col}` {id_type}, n_words long, n_removed long, kept_text string, changed boolean"
    return joined.mapInArrow(cut, ", ".join([schema, *[f"`{f.name}` {f.dataType.simpleString()}" for f in along]]))


