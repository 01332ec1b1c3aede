"""Benchmark decontamination by a broadcast set of normalised test n-grams.

Words are lower-cased runs of letters, digits and all that lies beyond ASCII. A window is ``n_words`` consecutive words of
a test item; a shorter item is one window as a whole.

1. Windows of all items become rows (hash, second hash, words, item), made and deduplicated by Spark.
2. They are broadcast in slices of at most ``slice_bytes``, so that what is sent at once has a fixed size however many items
   there are. Each slice is one more pass over the documents' batches.
3. A pass hashes the windows at every place of whole texts, looks them up in a bit table first and in the sorted hashes
   then, and verifies each hit by a second hash that is made from the bytes of its words with another seed.
4. Hits are runs of words and items; each pass adds its own to those of the passes before.

``decontaminated`` removes the hit words or the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm import words
from shelfspark.llm.storage import stored, text_batches

IS_WORD = np.zeros(256, bool)
IS_WORD[list(range(0x30, 0x3A)) + list(range(0x41, 0x5B)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True
TABLE_BITS = 20


@dataclass(frozen=True)
class Windows:
    n_words: int = 10
    slice_bytes: int = 16_000_000

    def __post_init__(self):
        if self.n_words < 1 or self.slice_bytes < 1:
            raise ValueError("n_words and slice_bytes must be at least 1")


WINDOW = pa.schema([("item", pa.string()), ("size", pa.int32()), ("first", pa.int64()), ("second", pa.int64())])
WINDOW_SQL = "item string, size int, first long, second long"


def _words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, bytes, word starts, word ends, first word of each row) of runs of rows."""
    for first, data, offsets in words.chunks(column):
        yield first, data, *words.spans(data, offsets, IS_WORD)


def _windows(how: Windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column("item").to_pylist()
            for row, data, starts, ends, bounds in _words(batch.column("text")):
                one, two = (words.word_hashes(data, starts, ends, True, seed) for seed in (0, 1))
                for i in range(len(bounds) - 1):
                    own = slice(bounds[i], bounds[i + 1])
                    size = int(min(how.n_words, bounds[i + 1] - bounds[i]))
                    if size:
                        runs = [words.signed(words.runs_of(h[own], size)) for h in (one, two)]
                        n = len(runs[0])
                        columns = [pa.array([items[row + i]] * n, pa.string()), pa.array(np.full(n, size, np.int32)), *map(pa.array, runs)]
                        yield pa.RecordBatch.from_arrays(columns, schema=WINDOW)

    return run


def item_windows(benchmark: DataFrame, how: Windows = Windows()) -> DataFrame:
    """(item, size, first, second): the distinct windows of every row of ``benchmark`` (item_id, text).

    ``item`` is item_id as text. Null, empty and wordless texts and rows without an item_id have no windows. Rows that
    share an item_id give their windows to the same item.
    """
    rows = text_batches(benchmark).select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return rows.where("item is not null").mapInArrow(_windows(how), WINDOW_SQL).distinct()


def _slices(windows: DataFrame, how: Windows) -> Iterator[pa.Table]:
    """The rows of ``windows`` in parts of at most about ``slice_bytes``; a window of many items may be cut."""
    size = windows.agg(F.sum(F.octet_length("item") + F.lit(24)).alias("n")).first().n or 0
    parts = -(-size // how.slice_bytes)
    dealt = windows.withColumn("part", F.pmod(F.xxhash64("first", "item"), F.lit(max(1, parts))))
    for part in range(parts):
        yield dealt.where(F.col("part") == part).select("item", "size", "first", "second").toArrow()


class Lookup:
    """The windows of a slice that have one size, sorted by their first hash."""

    def __init__(self, size: int, firsts: np.ndarray, seconds: np.ndarray, items: np.ndarray):
        order = np.argsort(firsts, kind="stable")
        self.size, self.firsts, self.seconds, self.items = size, firsts[order], seconds[order], items[order]
        self.low = np.uint64((1 << TABLE_BITS) - 1)
        self.bits = np.zeros(1 << TABLE_BITS, bool)
        self.bits[(firsts & self.low).astype(np.int64)] = True

    def candidates(self, hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words of windows whose first hash is known, and the place of the first such hash. ``row``: of each word."""
        grams = words.runs_of(hashes, self.size)
        at = np.flatnonzero(self.bits[(grams & self.low).astype(np.int64)])
        at = at[row[at] == row[at + self.size - 1]]
        lo = np.searchsorted(self.firsts, grams[at])
        same = lo < len(self.firsts)
        same[same] = self.firsts[lo[same]] == grams[at[same]]
        return at[same], lo[same]

    def verified(self, at: np.ndarray, lo: np.ndarray, proof: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(first words, items) of the candidates whose second hash agrees. Equal first hashes stand side by side."""
        firsts = self.firsts[lo]
        while len(at):
            right = self.seconds[lo] == proof
            yield at[right], self.items[lo[right]]
            more = lo + 1 < len(self.firsts)
            more[more] = self.firsts[lo[more] + 1] == firsts[more]
            at, lo, proof, firsts = at[more], lo[more] + 1, proof[more], firsts[more]


def _lookups(table: pa.Table) -> tuple[list[str], list[Lookup]]:
    if not table.num_rows:
        return [], []
    items = pc.dictionary_encode(table.column("item").combine_chunks())
    names, numbers = items.dictionary.to_pylist(), items.indices.to_numpy()
    sizes, firsts, seconds = (table.column(c).to_numpy() for c in ("size", "first", "second"))
    firsts, seconds = firsts.view(np.uint64), seconds.view(np.uint64)
    return names, [Lookup(k, *(x[sizes == k] for x in (firsts, seconds, numbers))) for k in np.unique(sizes).tolist()]


RUNS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
ADDED = {"n_words": pa.int64(), "hits": RUNS, "n_hit": pa.int64(), "items": pa.list_(pa.string())}
ADDED_SQL = "n_words long, hits array<struct<first: int, last: int>>, n_hit long, items array<string>"


def _chunk_hits(data, starts, ends, bounds, names: list[str], lookups: list[Lookup]) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Which words of a run of rows are hit, and the items of each row that has any."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    hashes = words.word_hashes(data, starts, ends, True)
    seconds = None
    cover = np.zeros(len(hashes) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for known in lookups:
        at, lo = known.candidates(hashes, row)
        if not len(at):
            continue
        if seconds is None:
            seconds = words.word_hashes(data, starts, ends, True, seed=1)
        for first, numbers in known.verified(at, lo, words.runs_of(seconds, known.size)[at]):
            np.add.at(cover, first, 1)
            np.add.at(cover, first + known.size, -1)
            pairs = np.unique(row[first] * len(names) + numbers)
            for r, n in zip((pairs // len(names)).tolist(), (pairs % len(names)).tolist()):
                items.setdefault(r, set()).add(names[n])
    return np.cumsum(cover)[:-1] > 0, items


def _scan(table, names: list[str], first_pass: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_names, lookups = _lookups(table.value)
        for batch in batches:
            out: list[list] = [[] for _ in ADDED]
            before = None if first_pass else {c: batch.column(c).to_pylist() for c in ("hits", "items")}
            for first, data, starts, ends, bounds in _words(batch.column("__text")):
                hit, items = _chunk_hits(data, starts, ends, bounds, item_names, lookups)
                some = np.diff(np.concatenate(([0], np.cumsum(hit)))[bounds])
                for i, n in enumerate(np.diff(bounds).tolist()):
                    runs, n_hit, own = [], 0, items.get(i, set())
                    earlier = before["hits"][first + i] if before else []
                    if some[i] or earlier:
                        mask = np.zeros(n + 2, bool)
                        mask[1:-1] = hit[bounds[i] : bounds[i + 1]]
                        for x in earlier:
                            mask[x["first"] + 1 : x["last"] + 2] = True
                        edges = np.flatnonzero(mask[1:] != mask[:-1]).tolist()
                        runs, n_hit = [{"first": a, "last": b - 1} for a, b in zip(edges[::2], edges[1::2])], int(mask.sum())
                    if before:
                        own = own.union(before["items"][first + i])
                    for column, x in zip(out, (n, runs, n_hit, sorted(own))):
                        column.append(x)
            columns = [batch.column(c) for c in names] + [pa.array(c, t) for c, t in zip(out, ADDED.values())]
            fields = [batch.schema.field(c) for c in names] + [pa.field(c, t) for c, t in ADDED.items()]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    return run


def contaminated(df: DataFrame, benchmark: DataFrame, how: Windows = Windows(), keep: list[str] | None = None) -> DataFrame:
    """``df`` with n_words, hits (runs of words, first to last), n_hit and items (item_ids as text, sorted).

    A word is hit if it lies in an occurrence of a window of any row of ``benchmark`` (item_id, text). Null, empty and
    wordless texts have no words and no hits. Repeated rows are scanned each; doc_id is not read. Columns named like the
    four are replaced; of the others all stay, or those in ``keep``. Empty tables: without documents no rows, without
    items no hits.
    """
    spark: SparkSession = df.sparkSession
    windows = stored(item_windows(benchmark, how), "windows")
    names = [c for c in (df.columns if keep is None else keep) if c not in ADDED and c != "__text"]
    rows = text_batches(df).select(*names, F.col("text").cast("string").alias("__text"))
    kinds = rows.schema
    slices = list(_slices(windows, how)) or [windows.select("item", "size", "first", "second").limit(0).toArrow()]
    for i, table in enumerate(slices):
        held = names if i == len(slices) - 1 else [*names, "__text"]
        schema = T.StructType([kinds[c] for c in held] + T.StructType.fromDDL(ADDED_SQL).fields)
        rows = rows.mapInArrow(_scan(spark.sparkContext.broadcast(table), held, not i), schema)
    return rows


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the hit runs out of the texts; all other bytes stay."""
    for batch in batches:
        texts, hits = batch.column("text"), batch.column("hits").to_pylist()
        out: list[bytes] = []
        for first, data, offsets in words.chunks(texts):
            starts, ends, bounds = words.spans(data, offsets, IS_WORD)
            for i in range(len(offsets) - 1):
                at, parts = offsets[i], []
                for run in hits[first + i]:
                    parts.append(data[at : starts[bounds[i] + run["first"]]].tobytes())
                    at = ends[bounds[i] + run["last"]]
                out.append(b"".join([*parts, data[at : offsets[i + 1]].tobytes()]))
        cut = pa.array([y.decode() if x.is_valid else None for x, y in zip(texts, out)], pa.string())
        columns = [cut if f.name == "text" else batch.column(f.name) for f in batch.schema]
        yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([pa.field("text", pa.string()) if f.name == "text" else f for f in batch.schema]))


def decontaminated(df: DataFrame, benchmark: DataFrame, how: Windows = Windows(), documents: bool = False) -> DataFrame:
    """``df`` without contaminated rows (``documents``), or with the hit words cut out of ``text``; columns as in ``contaminated``.

    What stands between the first and the last word of a run goes with it; all other bytes stay. A null text stays null.
    """
    found = contaminated(df.withColumn("text", F.col("text").cast("string")), benchmark, how)
    return found.where("n_hit = 0") if documents else found.mapInArrow(_without, found.schema)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of all benchmark items in all documents."""
    documents, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = contaminated(documents, benchmark, keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.concat_ws(",", "items"), "UTF-8"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP13_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS words FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS words FROM benchmark
), begins AS (
  SELECT item, words, least(len(words), 10) AS size, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM b WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item, size, array_to_string(words[i : i + size - 1], ' ') AS seq FROM begins
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT row, size, words, unnest(range(1, len(words) - size + 2)) AS i FROM d, sizes WHERE len(words) >= size
), hits AS (
  SELECT row, p.size, i, item FROM places p JOIN windows w ON w.size = p.size AND w.seq = array_to_string(words[i : i + p.size - 1], ' ')
), covered AS (
  SELECT row, count(DISTINCT j) AS n FROM (SELECT row, unnest(range(i, i + size)) AS j FROM hits) GROUP BY row
), found AS (
  SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(f.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (row) LEFT JOIN found f USING (row)
"""
