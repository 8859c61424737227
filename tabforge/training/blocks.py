"""Rows packed into blocks that every joint training step reads.

The frame is binned once. A block is one row holding the arrays of up to
``BLOCK_ROWS`` rows: ids, sampling keys, labels, split columns, raw
features and bin codes. A fold is not a filtered copy but a condition on a split
column: a model trains on the rows that meet none of its conditions.

Rows of equal bins, splits and label are one cell; trees count cells with their
numbers of rows. Rows are ranged by their bins, so that a cell's rows meet in a block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.operators.quantiles import group_quantiles
from tabforge.session import cut_lineage

BLOCK_ROWS = 65_536
#: Rows below which another partition is not worth its task.
LEAST_ROWS = 1_024

#: (split column, value): rows with that value are held out.
Condition = tuple[str, int]

#: What tree counting reads of a block; the row columns only where rows are drawn.
CELL_COLUMNS = ("cell_labels", "cell_splits", "cell_bins", "cell_counts")
ROW_COLUMNS = ("keys", "cell_of")
#: What linear models read of a block.
RAW_COLUMNS = ("labels", "splits", "raw")


def _trains(splits: dict[str, np.ndarray], n: int, conditions: Sequence[Condition]) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for column, value in conditions:
        out &= splits[column] != value
    return out


@dataclass
class Cells:
    """Distinct rows of a block with their numbers; ``keys`` and ``cell_of`` (the cell of each row) only where rows are drawn."""

    labels: np.ndarray
    splits: dict[str, np.ndarray]
    bins: np.ndarray
    counts: np.ndarray
    keys: np.ndarray | None = None
    cell_of: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.counts)

    def trains(self, conditions: Sequence[Condition]) -> np.ndarray:
        """Cells that a model with these conditions is fitted on."""
        return _trains(self.splits, len(self), conditions)


@dataclass
class Block:
    """Arrays of one block, row by row; only those whose columns were selected."""

    ids: pa.Array | None
    keys: np.ndarray | None
    labels: np.ndarray
    splits: dict[str, np.ndarray]
    raw: np.ndarray
    bins: np.ndarray | None
    cell_of: np.ndarray | None
    cell_bins: np.ndarray | None

    def __len__(self) -> int:
        return len(self.labels)

    @cached_property
    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct bins of the block, and which of them each row has. Cells are ordered by their bins."""
        new = np.concatenate([[True], (self.cell_bins[1:] != self.cell_bins[:-1]).any(axis=1)])
        return self.cell_bins[new], (np.cumsum(new) - 1)[self.cell_of]

    def trains(self, conditions: Sequence[Condition]) -> np.ndarray:
        """Rows that a model with these conditions is fitted on."""
        return _trains(self.splits, len(self), conditions)

    def held_out(self, conditions: Sequence[Condition]) -> np.ndarray:
        """Rows that the last condition holds out of what the earlier ones leave; all rows without conditions."""
        if not conditions:
            return np.ones(len(self), dtype=bool)
        column, value = conditions[-1]
        return self.trains(conditions[:-1]) & (self.splits[column] == value)


@dataclass
class Packed:
    """Blocks of a frame: ``frame`` has one row per block; ``edges`` cut each feature, bin 0 is for nulls."""

    frame: DataFrame
    features: list[str]
    splits: list[str]
    edges: list[np.ndarray]
    id_col: str
    id_type: str
    n_rows: int
    n_parts: int
    drawn: DataFrame | None = None
    table: object = None  # ``whole.Table``, made when trees first ask for it; False where it is too large
    sent: object = None  # the table as a broadcast
    kept: bool = False  # by ``packed_once``, which releases it

    def release(self) -> None:
        """Drops the cached copies; the written blocks stay."""
        if self.kept:
            return
        self.frame.unpersist()
        if self.drawn is not None:
            self.drawn.unpersist()
        if self.sent is not None:
            self.sent.unpersist()

    def part(self, rows: int) -> Packed:
        """About ``rows`` rows, drawn by their keys, with what linear models read; drawn once and kept in memory until ``release``."""
        if self.drawn is None:
            share, splits, d = rows / self.n_rows, self.splits, len(self.features)

            def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for block in unpacked(batches, splits, d):
                    own = np.flatnonzero(uniform(block.keys, 0) < share)
                    if len(own):
                        s = np.column_stack([*(block.splits[c][own] for c in splits), np.zeros(len(own), dtype=np.int32)])
                        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in (block.labels[own], s.astype(np.int32), block.raw[own])],
                                                         names=list(RAW_COLUMNS))

            drawn = self.frame.select("keys", *RAW_COLUMNS).mapInArrow(work, ", ".join(f"{c} binary" for c in RAW_COLUMNS))
            self.drawn = drawn.coalesce(self.frame.sparkSession.sparkContext.defaultParallelism).persist()
        return replace(self, frame=self.drawn, n_rows=rows)

    @property
    def n_bins(self) -> int:
        return max(1, *(len(e) for e in self.edges)) + 2


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> list[np.ndarray]:
    """Upper bounds of the bins but the last: halfway points between a feature's exact quantiles."""
    probs = [i / max_bins for i in range(max_bins + 1)]
    names = [f"q{i}" for i in range(max_bins + 1)]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f).cast("double").alias("v")) for j, f in enumerate(features)])).alias("c"))
    found = {r["j"]: np.unique([x for x in r[1:] if x is not None])
             for r in group_quantiles(long.select("c.j", "c.v"), "v", probs, ["j"], names).select("j", *names).collect()}
    values = [found.get(j, np.zeros(0)) for j in range(len(features))]
    return [(v[1:] + v[:-1]) / 2 for v in values]


def bin_codes(raw: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of each value: 0 for nulls, else 1 + the number of edges below it."""
    out = np.zeros(raw.shape, dtype=np.uint8)
    for j, e in enumerate(edges):
        known = ~np.isnan(raw[:, j])
        out[known, j] = 1 + np.searchsorted(e, raw[known, j], side="left")
    return out


@dataclass
class _Shared:
    df: DataFrame
    features: list[str]
    splits: list[str]
    label: str
    id_col: str
    max_bins: int
    known: bool | None = None  # no null among features and labels
    packed: Packed | None = None

    def serves(self, df: DataFrame, features: Sequence[str], splits: Sequence[str], label: str | None, id_col: str, max_bins: int) -> bool:
        return (df is self.df and list(features) == self.features and set(splits) <= set(self.splits)
                and (label, id_col, max_bins) == (self.label, self.id_col, self.max_bins))


_SHARED: list[_Shared] = []


@contextmanager
def packed_once(df: DataFrame, features: Sequence[str], splits: Sequence[str] = (), label: str = "label", id_col: str = "id", max_bins: int = 64) -> Iterator[None]:
    """Within it, all that packs the frame object ``df`` by these features shares one packing, made when first asked for."""
    own = _Shared(df, list(features), list(splits), label, id_col, max_bins)
    _SHARED.append(own)
    try:
        yield
    finally:
        _SHARED.remove(own)
        if own.packed is not None:
            own.packed.kept = False
            own.packed.release()


def shared_pack(df: DataFrame, features: Sequence[str], splits: Sequence[str], label: str | None, id_col: str, max_bins: int, strict: bool) -> Packed | None:
    """The packing of ``packed_once``; nothing where there is none, or where ``strict`` finds nulls (packing then says so)."""
    own = next((x for x in _SHARED if x.serves(df, features, splits, label, id_col, max_bins)), None)
    if own is None:
        return None
    if strict and own.known is None:
        missing = [F.col(f).isNull() | F.isnan(F.col(f).cast("double")) for f in own.features] + [F.col(label).isNull()]
        own.known = not df.agg(F.max(F.greatest(F.lit(0), *[c.cast("int") for c in missing])).alias("n")).first()["n"]
    if strict and not own.known:
        return None
    if own.packed is None:
        held, own.features = own.features, []  # not served while it is made
        own.packed = pack(df, held, own.splits, label, id_col, max_bins)
        own.packed.kept, own.features = True, held
    return own.packed


def pack(df: DataFrame, features: Sequence[str], splits: Sequence[str] = (), label: str | None = "label", id_col: str = "id",
         max_bins: int = 64, edges: list[np.ndarray] | None = None, strict: bool = False) -> Packed:
    """Bins and packs ``df``; ``edges`` of another frame may be reused. Without a label it reads as 0. ``strict``: a
    feature that is null or NaN, or a null label, is an error."""
    if not 2 <= max_bins <= 254:
        raise ValueError("max_bins must be from 2 to 254")
    features, splits = list(features), list(splits)
    if edges is None and (held := shared_pack(df, features, splits, label, id_col, max_bins, strict)) is not None:
        return held
    edges = bin_edges(df, features, max_bins) if edges is None else edges
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(id_col).alias("key"),
                     (F.col(label) if label else F.lit(0)).cast("int").alias("y"),
                     F.array(*[F.coalesce(F.col(s).cast("int"), F.lit(-1)) for s in splits], F.lit(0)).alias("s"),
                     F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features]).alias("x"))
    n = rows.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, n // LEAST_ROWS + 1), -(-(n // BLOCK_ROWS) // cores) * cores)  # whole rounds of the cores
    id_type = rows.schema["id"].dataType.simpleString()

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = _wide(batch.column(batch.schema.get_field_index("x")), batch.num_rows).astype(np.float64)
                if strict and (np.isnan(raw).any() or batch.column(batch.schema.get_field_index("y")).null_count):
                    raise ValueError("features must not be null or NaN, labels must not be null")
                codes = bin_codes(raw, edges)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tobytes() for r in codes], pa.binary())], names=[*batch.schema.names, "bins"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if held and size + batch.num_rows > BLOCK_ROWS:
                yield _packed(pa.Table.from_batches(held))
                held, size = [], 0
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
        if held:
            yield _packed(pa.Table.from_batches(held))

    coded = rows.mapInArrow(binned, f"id {id_type}, key long, y int, s array<int>, x array<double>, bins binary")
    # the key last: a cell of many rows may go to several tasks
    ranged = coded.repartitionByRange(parts, "bins", "y", "key") if parts > 1 else coded.coalesce(1)
    blocks = ranged.mapInArrow(work, f"n int, ids array<{id_type}>, " + ", ".join(f"{c} binary" for c in _COLUMNS))
    blocks = blocks.withColumn("block", F.monotonically_increasing_id())  # written with them, so it stays
    return Packed(cut_lineage(blocks).persist(), features, splits, edges, id_col, id_type, n, parts)


_COLUMNS = ("keys", "labels", "splits", "raw", "bins", "cell_of", *CELL_COLUMNS)


def _wide(lists: pa.Array, n: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _packed(t: pa.Table) -> pa.RecordBatch:
    t = t.combine_chunks()
    n = t.num_rows
    column = lambda c: t.column(c).chunk(0)
    labels, splits = column("y").to_numpy().astype(np.uint8), _wide(column("s"), n).astype(np.int32)
    raw = _wide(column("x"), n).astype(np.float64)
    bins = np.frombuffer(b"".join(column("bins").to_pylist()), dtype=np.uint8).reshape(n, -1)
    whole = np.ascontiguousarray(np.concatenate([bins, labels[:, None], splits.view(np.uint8).reshape(n, -1)], axis=1))
    _, first, cell_of, counts = np.unique(whole.view(np.dtype((np.void, whole.shape[1]))).ravel(), return_index=True, return_inverse=True, return_counts=True)
    cols = {"keys": column("key").to_numpy().astype(np.int64), "labels": labels, "splits": splits, "raw": raw, "bins": bins,
            "cell_of": cell_of.astype(np.int32), "cell_labels": labels[first], "cell_splits": splits[first], "cell_bins": bins[first],
            "cell_counts": counts.astype(np.int64)}
    return pa.RecordBatch.from_arrays(
        [pa.array([n], pa.int32()), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), column("id")),
         *(pa.array([np.ascontiguousarray(cols[c]).tobytes()]) for c in _COLUMNS)], names=["n", "ids", *_COLUMNS])


def _read(batch: pa.RecordBatch, i: int, name: str, dtype, width: int = 0) -> np.ndarray:
    out = np.frombuffer(batch.column(batch.schema.get_field_index(name))[i].as_buffer(), dtype=dtype)
    return out.reshape(-1, width) if width else out


def unpacked(batches: Iterator[pa.RecordBatch], splits: Sequence[str], n_features: int) -> Iterator[Block]:
    """The blocks of a task."""
    for batch in batches:
        has = set(batch.schema.names)
        for i in range(batch.num_rows):
            s = _read(batch, i, "splits", np.int32, len(splits) + 1)
            yield Block(batch.column(batch.schema.get_field_index("ids"))[i].values if "ids" in has else None,
                        _read(batch, i, "keys", np.int64).view(np.uint64) if "keys" in has else None,
                        _read(batch, i, "labels", np.uint8), {c: s[:, j] for j, c in enumerate(splits)},
                        _read(batch, i, "raw", np.float64, n_features), _read(batch, i, "bins", np.uint8, n_features) if "bins" in has else None,
                        _read(batch, i, "cell_of", np.int32) if "cell_of" in has else None,
                        _read(batch, i, "cell_bins", np.uint8, n_features) if "cell_bins" in has else None)


def cells_of(batch: pa.RecordBatch, splits: Sequence[str], n_features: int) -> Cells:
    """The cells of a batch of one block, with its row columns if they were selected."""
    s = _read(batch, 0, "cell_splits", np.int32, len(splits) + 1)
    drawn = "keys" in batch.schema.names
    return Cells(_read(batch, 0, "cell_labels", np.uint8), {c: s[:, j] for j, c in enumerate(splits)}, _read(batch, 0, "cell_bins", np.uint8, n_features),
                 _read(batch, 0, "cell_counts", np.int64), _read(batch, 0, "keys", np.int64).view(np.uint64) if drawn else None,
                 _read(batch, 0, "cell_of", np.int32) if drawn else None)


def uniform(keys: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) per key that depends on key and seed alone."""
    h = keys ^ np.uint64(seed & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h ^ (h >> np.uint64(31))) / 18446744073709551616.0


def seed_of(*parts) -> int:
    """A 63-bit seed from names and numbers."""
    import hashlib
    return int.from_bytes(hashlib.blake2b(":".join(map(str, parts)).encode(), digest_size=8).digest(), "big") >> 1
