"""Line-first quality rules.

Each line is judged on its own: navigation (separators between short entries,
or calls such as "read more"), boilerplate (rights notices, cookie and script
notices), symbol noise, shouting, and lines without end punctuation among
short ones. Failing lines are removed; a document that loses more than
``max_loss`` of its words, or that fails the base rules, is rejected.

Base rules use the whole text: fewer than ``min_words`` words, or more than
half of the words in three-word windows that occur twice or more.

One pass inside each task, no shuffle; memory is one document's word hashes.

Defined results: a null or empty text has no words and no lines, fails the base
rules and is rejected, with an empty cleaned text; repeated rows are judged
alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.words import window_hashes, word_hashes

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_END = tuple(".!?\"')]:;”»…。")
#: Fixed phrases of page furniture; a short line that holds one is removed.
FURNITURE = ("read more", "click here", "sign in", "log in", "subscribe", "share this", "next page", "previous page",
             "back to top", "all rights reserved", "privacy policy", "terms of use", "terms of service",
             "cookie policy", "we use cookies", "enable javascript", "skip to content")
_FURNITURE = re.compile("|".join(map(re.escape, FURNITURE)))
_NO_LETTER = re.compile(r"[\W\d_]+")
_BARS = re.compile(r"\s[|·•»>]\s")


def line_fault(line: str) -> str | None:
    """The rule that a line fails, or None. A line without a word passes (nothing is lost with it)."""
    words = line.split()
    if not words:
        return None
    n = len(words)
    if len(_BARS.findall(line)) * 3 >= n:
        return "navigation"
    if n <= 20 and _FURNITURE.search(line.lower()):
        return "boilerplate"
    letters = len(_NO_LETTER.sub("", line))
    if sum(map(line.count, "#*$%&|<>{}")) * 10 > len(line) or letters * 2 < len(line) - line.count(" "):
        return "symbols"
    if letters >= 20 and sum(len(w) for w in words if w.isupper()) * 2 > sum(map(len, words)):
        return "shouting"
    if n < 3 and not line.rstrip().endswith(_END):
        return "punctuation"
    return None


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = np.frombuffer(text, dtype=np.uint8)
    hashes = word_hashes(text)
    n = len(hashes)
    blanks = int(((data == 0x20) | ((data >= 0x09) & (data <= 0x0D))).sum())
    points = int(((data & 0xC0) != 0x80).sum())  # bytes that begin a code point
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.split():
            seen.add(line)
    repeat = 0
    if n >= 3:
        windows = window_hashes(hashes, 3)
        _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
        again = np.zeros(n + 1, dtype=np.int32)
        at = np.flatnonzero(count[which] > 1)
        np.add.at(again, at, 1)
        np.add.at(again, at + 3, -1)
        repeat = int((np.cumsum(again[:n]) > 0).sum())
    return n, points - blanks, int(_SYMBOLS[data].sum()), dup, repeat


def clean_lines(text: str) -> tuple[str, int, dict[str, int]]:
    """The text without failing lines, the words they held, and lines removed by rule."""
    kept, lost, faults = [], 0, {}
    for line in text.split("\n"):
        fault = line_fault(line)
        if fault is None:
            kept.append(line)
        else:
            lost += len(line.encode().split())
            faults[fault] = faults.get(fault, 0) + 1
    return "\n".join(kept), lost, faults


def judge_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50,
                  max_loss: float = 0.3) -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, n_lost_words, faults (lines removed by rule), cleaned (text without failing lines)."""
    rows = df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("binary").alias("_text"))
    id_type = rows.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                counts, failed, kept, losses, faults, texts = [], [], [], [], [], []
                for text in part.column(1).to_pylist():
                    text = text or b""
                    c = base_counts(text)
                    cleaned, lost, fault = clean_lines(text.decode())
                    bad = c[0] < min_words or 100 * c[4] > 50 * c[0]
                    counts.append(c)
                    failed.append(bad)
                    kept.append(not bad and lost <= max_loss * c[0])
                    losses.append(lost)
                    faults.append(list(fault.items()))
                    texts.append(cleaned)
                table = np.array(counts, dtype=np.int64).reshape(-1, 5)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(table[:, i]) for i in range(5)), pa.array(failed, pa.bool_()),
                     pa.array(kept, pa.bool_()), pa.array(losses, pa.int64()),
                     pa.array(faults, pa.map_(pa.string(), pa.int32())), pa.array(texts, pa.string())],
                    names=[id_col, *names, "base_failed", "kept", "n_lost_words", "faults", "cleaned"])

    return rows.mapInArrow(work, f"`{id_col}` {id_type}, " + ", ".join(f"{n} long" for n in names)
                           + ", base_failed boolean, kept boolean, n_lost_words long, faults map<string,int>, cleaned string")
