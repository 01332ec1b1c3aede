"""Counts and shape statistics of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import words
from shelfspark.llm.storage import text_batches

WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHAPES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "stops", "bars",
    "distinct", "words_per_line", "short_words", "wide_letters", "long_word",
)
TYPE = "struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ", shapes: array<double>>"


def _in(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_SYMBOLS = _in(b"#*$%&|<>")
_CLASSES = {
    "upper": _in(bytes(range(65, 91))),
    "digits": _in(bytes(range(48, 58))),
    "marks": _in(b"!?\"'()[]{};:@^_~`\\/=+"),
    "stops": _in(b".,"),
    "bars": _in(b"|<>"),
    "wide_letters": _in(bytes(range(0xC0, 256))),
}
_INNER = np.ones(256, bool)
_INNER[0x80:0xC0] = False  # continuation bytes do not begin a code point


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that the text holds twice or more, the first of them included."""
    grams = words.runs_of(hashes, window)
    if len(grams) < 2:
        return 0
    _, back, counts = np.unique(grams, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[back] > 1)
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + window, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and all lines with a word."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines)), len(lines)


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Integer counts (rows, COUNTS) and shapes (rows, SHAPES); nulls count as empty texts."""
    counts = np.zeros((len(column), len(COUNTS)), np.int64)
    shapes = np.zeros((len(column), len(SHAPES)))
    at = {name: i for i, name in enumerate(SHAPES)}
    for first, data, offsets in words.chunks(column):
        rows = slice(first, first + len(offsets) - 1)
        starts, ends, bounds = words.spans(data, offsets)
        hashes = words.word_hashes(data, starts, ends)
        begins = words.IS_WORD[data] & _INNER[data]
        n = np.diff(bounds)
        chars = _per_row(begins, offsets)
        counts[rows, 0], counts[rows, 1], counts[rows, 2] = n, chars, _per_row(_SYMBOLS[data], offsets)
        lines = np.zeros(len(n), np.int64)
        distinct = np.zeros(len(n), np.int64)
        longest = np.zeros(len(n), np.int64)
        lengths = ends - starts
        for i in range(len(n)):
            own = hashes[bounds[i] : bounds[i + 1]]
            counts[first + i, 3], lines[i] = repeated_lines(data[offsets[i] : offsets[i + 1]].tobytes())
            counts[first + i, 4] = repeated_words(own)
            distinct[i] = len(np.unique(own))
            longest[i] = lengths[bounds[i] : bounds[i + 1]].max(initial=0)
        some, letters = np.maximum(n, 1), np.maximum(chars, 1)
        shape = shapes[rows]
        shape[:, at["log_words"]] = np.log1p(n)
        shape[:, at["word_length"]] = chars / some
        shape[:, at["symbols"]] = counts[rows, 2] / letters
        shape[:, at["dup_lines"]] = counts[rows, 3] / np.maximum(lines, 1)
        shape[:, at["repeats"]] = counts[rows, 4] / some
        for name, table in _CLASSES.items():
            shape[:, at[name]] = _per_row(table[data], offsets) / letters
        # Longer texts repeat words anyway; the exponent takes that growth out.
        shape[:, at["distinct"]] = distinct / some**0.8
        shape[:, at["words_per_line"]] = np.log1p(n / np.maximum(lines, 1))
        short = np.concatenate(([0], np.cumsum(lengths <= 3)))[bounds]
        shape[:, at["short_words"]] = np.diff(short) / some
        shape[:, at["long_word"]] = np.log1p(longest)
    return counts, shapes


def _column(texts: pa.Array) -> pa.Array:
    counts, shapes = statistics(texts)
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(len(shapes) + 1, dtype=np.int32) * len(SHAPES)), pa.array(shapes.ravel(), pa.float64())
    )
    return pa.StructArray.from_arrays([*(pa.array(c) for c in counts.T), lists], names=[*COUNTS, "shapes"])


def measured(text: Column) -> Column:
    """A struct of COUNTS and the array ``shapes`` in the order of SHAPES."""
    return F.arrow_udf(_column, TYPE)(text.cast("string"))


def labels_of(labels: DataFrame, where: Column | None = None) -> DataFrame:
    """(doc_id, quality), one row a document. Labels that are neither 0 nor 1 are left out; of both, 0 counts."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    ids = ids.where("doc_id is not null and quality in (0, 1)" if where is None else where & F.expr("doc_id is not null and quality in (0, 1)"))
    return ids.groupBy("doc_id").agg(F.min("quality").alias("quality"))


def labelled_shapes(documents: DataFrame, labels: DataFrame, where: Column | None = None) -> DataFrame:
    """(doc_id, quality, COUNTS, shapes) of all labelled documents. Statistics are joined with labels, texts stay where they are."""
    rows = text_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), measured(F.col("text")).alias("m"))
    return rows.select("doc_id", "m.*").join(labels_of(labels, where), "doc_id")


def labelled(documents: DataFrame, labels: DataFrame, most: int, where: Column | None = None) -> DataFrame:
    """(doc_id, quality, text) of at most ``most`` labelled documents: those whose doc_id has the least hashes.

    Only ids are sorted, and only they are sent to the tasks: 16 bytes each. Labels that are neither 0 nor 1 are left
    out; of a document with both, 0 counts.
    """
    ids = labels_of(labels, where).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = text_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(F.broadcast(ids), "doc_id")
