"""SentencePiece encoding and decoding that keeps offsets into the source text.

``Normaliser`` applies the model's own rules: the compiled character map (a
double-array trie over UTF-8 and a pool of replacements) by longest prefix, the
dummy prefix, white-space folding and escaping. It records for each byte of the
normalised text the source byte that it comes from, so that every piece is
projected to a span of original bytes.

No piece of the vocabulary has the escape character behind another one, so
merges never cross a word start: the normalised text is cut there, and each
distinct stretch is encoded once and kept in a bounded cache. The constructor
proves that property on the vocabulary and otherwise encodes whole texts.

Work is one pass over the texts inside each task (no shuffle); a task holds the
model, the cache (``CACHE`` stretches) and one Arrow batch.

Defined results: a null or empty text gives the end id alone and decodes to the
empty string; repeated rows are encoded alike; an empty table gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

ESCAPE = "▁"
CACHE = 200_000
_BYTES = [f"<0x{i:02X}>" for i in range(256)]


class CharacterMap:
    """The compiled map: 4-byte size, double array (uint32 units), replacements split by NUL."""

    def __init__(self, blob: bytes):
        self.units: tuple[int, ...] = ()
        self.pool = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.pool = blob[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes read, replacement) of the longest key at ``at``."""
        if not self.units:
            return None
        units, found = self.units, None
        node = _offset(units[0])
        for i in range(at, len(text)):
            byte = text[i]
            node ^= byte
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                value = units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.pool[value:self.pool.index(b"\0", value)]
        return found


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & (1 << 9)) >> 6)


class Normaliser:
    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.fold, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) a source byte offset."""
        raw = text.encode()
        if not self.map.units and not self.fold:
            return self._identity(text, raw)
        out, origin, at, blank = bytearray(), [], 0, self.fold
        while at < len(raw):
            found = self.map.longest(raw, at)
            if found:
                n, new = found
            else:
                first = raw[at]
                n = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                new = raw[at:at + n]
            if self.fold and blank:
                new = new.lstrip(b" ")
            if new:
                blank = self.fold and new.endswith(b" ")
                out += new
                origin += [at] * len(new)
            at += n
        end = len(raw)
        if self.fold:
            while out.endswith(b" "):
                del out[-1:]
                end = origin.pop()
        if not out:
            return "", np.zeros(1, dtype=np.int64)
        if self.dummy:
            out[:0] = b" "
            origin.insert(0, origin[0])
        if not self.escape:
            return out.decode(), np.array([*origin, end], dtype=np.int64)
        wide = np.where(np.frombuffer(bytes(out), dtype=np.uint8) == 0x20, 3, 1)
        return out.decode().replace(" ", ESCAPE), np.append(np.repeat(np.array(origin, dtype=np.int64), wide), end)

    def _identity(self, text: str, raw: bytes) -> tuple[str, np.ndarray]:
        if not raw:
            return "", np.zeros(1, dtype=np.int64)
        data = np.frombuffer(raw, dtype=np.uint8)
        wide = np.where((data == 0x20) & self.escape, 3, 1)
        origin = np.repeat(np.arange(len(data)), wide)
        blank = ESCAPE if self.escape else " "
        if self.dummy:
            origin = np.concatenate([np.zeros(len(blank.encode()), dtype=np.int64), origin])
            text = " " + text
        return text.replace(" ", ESCAPE) if self.escape else text, np.append(origin, len(raw))


class PieceCoder:
    """Encodes with spans and decodes; made once in each Python worker."""

    def __init__(self, model: bytes):
        self.lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        proto = model_pb2.ModelProto.FromString(model)
        self.normalise = Normaliser(proto.normalizer_spec)
        names = [p.piece for p in proto.pieces]
        byte = {n: i for i, n in enumerate(_BYTES)}
        self.width = np.array([1 if n in byte else len(n.encode()) for n in names], dtype=np.int64)
        spec = proto.normalizer_spec
        # 3 = user defined pieces are matched before merges; 2 = the BPE model type
        self.by_stretch = (spec.add_dummy_prefix and spec.escape_whitespaces and not spec.precompiled_charsmap
                           and not spec.remove_extra_whitespaces and proto.trainer_spec.model_type == 2
                           and not proto.trainer_spec.treat_whitespace_as_suffix and proto.trainer_spec.byte_fallback
                           and not any(p.type == 4 for p in proto.pieces)
                           and not any(ESCAPE in n.lstrip(ESCAPE) for n in names))
        self.blank = [self.lib.piece_to_id(ESCAPE)]
        self.end = self.lib.eos_id()
        self.cache: dict[str, np.ndarray] = {}

    def _stretch(self, word: str) -> np.ndarray:
        ids = self.cache.get(word)
        if ids is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            # the library puts the first blank back
            ids = np.array(self.lib.encode(word) if word else self.blank, dtype=np.int32)
            self.cache[word] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        """Piece ids without the end id."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        if not self.by_stretch:
            return np.array(self.lib.encode(text), dtype=np.int32)
        parts = text.replace(ESCAPE, " ").split(" ")
        if "" in parts[1:] or not parts[0]:
            parts = list(_stretches(parts))
        cache, stretch = self.cache, self._stretch
        found = [cache.get(p) for p in parts]
        return np.concatenate([f if f is not None else stretch(p) for f, p in zip(found, parts, strict=True)])

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each piece in the bytes of ``text``."""
        _, origin = self.normalise(text)
        edge = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(self._widths(text, ids), out=edge[1:])
        if edge[-1] != len(origin) - 1:
            raise ValueError("pieces do not cover the normalised text")
        return origin[edge[:-1]], origin[edge[1:]]

    def _widths(self, text: str, ids: np.ndarray) -> np.ndarray:
        if (ids == self.lib.unk_id()).any():
            raise ValueError("spans need a model with byte fallback: an unknown piece does not tell what it covers")
        return self.width[ids]

    def decode(self, ids: list[int]) -> str:
        return self.lib.decode(ids)


def _stretches(parts: list[str]) -> Iterator[str]:
    """Runs of blanks go with the word behind them; what ends the text stands alone."""
    blanks = 0
    for i, part in enumerate(parts):
        if part:
            yield " " * blanks + part
            blanks = 0
        elif i + 1 < len(parts):
            blanks += 1
        else:
            yield " " * blanks


_coders: dict[bytes, PieceCoder] = {}


def _coder(model: bytes) -> PieceCoder:
    if model not in _coders:
        _coders[model] = PieceCoder(model)
    return _coders[model]


def _read_model(model) -> bytes:
    with open(model, "rb") as f:  # on the driver; tasks get the bytes
        return f.read()


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False,
           spans: bool = True, keep: list[str] | None = None) -> DataFrame:
    """One row per document: id, ids array<int> (end id last), begins and ends array<int>
    (bytes of the text that each piece covers; the end id has an empty span at the end),
    with ``decoded`` the text that the library decodes from the ids, and the columns named in ``keep``."""
    spark = df.sparkSession
    data = spark.sparkContext.broadcast(_read_model(model))  # a vocabulary: half a megabyte
    fields = ["ids array<int>"] + ["begins array<int>", "ends array<int>"] * spans + ["decoded string"] * decoded
    along = df.select(*map(F.col, keep or ())).schema
    rows = df.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"), *[F.col(f.name).alias(f"_k{i}") for i, f in enumerate(along)])
    id_type = rows.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(data.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                out: list[list] = [[] for _ in range(1 + 2 * spans + decoded)]
                for text in part.column(1).to_pylist():
                    text = text or ""
                    ids = coder.ids(text)
                    full = np.append(ids, np.int32(coder.end))
                    out[0].append(full)
                    if spans:
                        begin, end = coder.spans(text, ids)
                        size = len(text.encode())
                        out[1].append(np.append(begin, size).astype(np.int32))
                        out[2].append(np.append(end, size).astype(np.int32))
                    if decoded:
                        out[-1].append(coder.decode(full.tolist()))
                cols = [_lists(x) for x in out[:1 + 2 * spans]] + ([pa.array(out[-1], pa.string())] if decoded else [])
                yield pa.RecordBatch.from_arrays([part.column(0), *cols, *part.columns[2:]],
                                                 names=[id_col, *(f.split()[0] for f in fields), *along.names])

    return rows.mapInArrow(work, ", ".join([f"`{id_col}` {id_type}", *fields, *[f"`{f.name}` {f.dataType.simpleString()}" for f in along]]))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int32))


def decode(df: DataFrame, model: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for; null ids give null."""
    data = df.sparkSession.sparkContext.broadcast(_read_model(model))

    @F.pandas_udf("string")
    def decoded(batches):
        coder = _coder(data.value)
        for ids in batches:
            yield ids.map(lambda x: None if x is None else coder.decode([int(i) for i in x]))

    return df.withColumn(out_col, decoded(F.col(ids_col)))
