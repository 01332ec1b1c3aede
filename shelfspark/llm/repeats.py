"""Substring dedup by de Bruijn compaction.

Windows of ``window`` words are the edges of a de Bruijn graph over all documents.

1. Every window contains one least ``anchor_words``-gram in a fixed random order, its anchor. Consecutive windows with the
   same anchor form a path without branches inside, compacted to one row (anchor, path hash, document, start, windows). So
   the graph is sent in about a fifth of its edges.
2. Equal windows have equal anchors, so paths whose anchor no other document holds are dropped by a Spark join.
3. Within an anchor, equal paths compact to one, with the coordinates of its source: the least document that holds it. A
   path in any later document is repeated as a whole.
4. Where an anchor has several paths the graph branches. The sources of these paths are cut into their edges again, and
   the least document of each edge decides it.
5. Sources are read at their coordinates for a second hash, made from the bytes of the words with another seed; a
   document's words are removed only where the second hash of its own words agrees. Equality rests on 128 bits and more.

A document's list of runs is bounded by its own length; nothing else is gathered per key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm import words
from shelfspark.llm.storage import dropped, stored, text_batches

PATH = pa.schema([("anchor", pa.int64()), ("path", pa.int64()), ("doc", pa.int64()), ("start", pa.int32()), ("edges", pa.int32())])
PATH_SQL = "anchor long, path long, doc long, start int, edges int"


@dataclass(frozen=True)
class Repeats:
    window: int = 13
    anchor_words: int = 5

    def __post_init__(self):
        if not 0 < self.anchor_words <= self.window <= self.anchor_words + 61:
            raise ValueError("the windows of a path, at most window - anchor_words + 1, must fit 62 bits")


def _span_hashes(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray, salt: int) -> np.ndarray:
    """A hash for each span of words lo to hi - 1."""
    own = words.mixed(hashes, salt)
    sums = np.zeros(len(own) + 1, np.uint64)
    np.cumsum(own * words.powers(len(own)), out=sums[1:])
    return words.mixed((sums[hi] - sums[lo]) * words.powers(len(sums), back=True)[lo], salt + 1)


def compacted(hashes: np.ndarray, how: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, path hashes, starts and numbers of windows of the paths of one document."""
    if len(hashes) < how.window:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = words.runs_of(hashes, how.anchor_words)
    order = words.mixed(grams, 3)
    per_window = how.window - how.anchor_words + 1
    place = np.lib.stride_tricks.sliding_window_view(order, per_window).argmin(axis=1) + np.arange(len(hashes) - how.window + 1)
    cut = np.flatnonzero(place[1:] != place[:-1]) + 1
    lo = np.concatenate(([0], cut))
    hi = np.concatenate((cut, [len(place)]))
    # The words before the anchor count into the hash, so equal hashes mean equal places of the anchor as well.
    paths = _span_hashes(hashes, lo, hi + how.window - 1, 5)
    return grams[place[lo]], paths, lo, hi - lo


def _paths(how: Repeats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc").to_numpy(zero_copy_only=False)
            parts: list[list[np.ndarray]] = [[], [], [], [], []]
            held = 0
            for row, hashes in words.rows_of_words(batch.column("text")):
                found = compacted(hashes, how)
                anchors, paths, lo, edges = found
                for part, values in zip(parts, (words.signed(anchors), words.signed(paths), np.full(len(lo), docs[row]), lo, edges)):
                    part.append(values)
                held += len(lo)
                if held >= 100_000:
                    yield _records(parts)
                    parts, held = [[], [], [], [], []], 0
            if held:
                yield _records(parts)

    return run


def _records(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)).cast(f.type) for p, f in zip(parts, PATH)], schema=PATH)


def _proofs(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A hash for each span, from the words' second hashes, which share nothing with the first but the bytes."""
    return words.signed(_span_hashes(hashes, lo, hi, 11))


SOURCE = pa.schema(
    [("anchor", pa.int64()), ("path", pa.int64()), ("doc", pa.int64()), ("edge", pa.int64()), ("place", pa.int32()), ("proof", pa.int64())]
)
SOURCE_SQL = "anchor long, path long, doc long, edge long, place int, proof long"


def _sources(how: Repeats):
    """Of each source path its proof (place -1), and if its anchor branches, its edges with their places."""

    def run(batches):
        for batch in batches:
            docs = batch.column("doc").to_pylist()
            lists = batch.column("paths").to_pylist()
            out: list[list] = [[] for _ in SOURCE]
            texts = batch.column("text")
            for (row, hashes), (_, seconds) in zip(words.rows_of_words(texts), words.rows_of_words(texts, seed=1)):
                lo = np.array([p["start"] for p in lists[row]], np.int64)
                hi = lo + np.array([p["edges"] for p in lists[row]], np.int64)
                fits = hi + how.window - 1 <= len(hashes)  # not so if one doc_id stands for different texts
                proofs = _proofs(seconds, lo[fits], hi[fits] + how.window - 1).tolist()
                edges = words.runs_of(hashes, how.window)
                kept = [p for p, ok in zip(lists[row], fits) if ok]
                for p, proof in zip(kept, proofs):
                    out_rows = [(None, -1, proof)]
                    if p["branches"]:
                        part = words.signed(edges[p["start"] : p["start"] + p["edges"]]).tolist()
                        out_rows += [(e, i, None) for i, e in enumerate(part)]
                    for edge, place, value in out_rows:
                        for column, x in zip(out, (p["anchor"], p["path"], docs[row], edge, place, value)):
                            column.append(x)
                if len(out[0]) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, SOURCE)], schema=SOURCE)
                    out = [[] for _ in SOURCE]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, SOURCE)], schema=SOURCE)

    return run


SPAN = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
ADDED = {"kept_text": pa.string(), "n_words": pa.int64(), "n_removed": pa.int64(), "removed": SPAN}
ADDED_SQL = "kept_text string, n_words long, n_removed long, removed array<struct<first: int, last: int>>"


def _gone(how: Repeats, hashes: np.ndarray, start: np.ndarray, edges: np.ndarray, mask: np.ndarray, proof: np.ndarray) -> np.ndarray:
    """Which words of a document go, from its words' second hashes and its runs: a bit of ``mask`` for each window of a run."""
    end = start + edges + how.window - 1
    fits = end <= len(hashes)
    agreed = np.zeros(len(start), bool)
    agreed[fits] = _proofs(hashes, start[fits], end[fits]) == proof[fits]
    run, place = np.nonzero(mask[agreed, None] >> np.arange(how.window) & 1)
    window = start[agreed][run] + place
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, window, 1)
    np.add.at(cover, window + how.window, -1)
    return np.cumsum(cover)[:-1] > 0


def _rewritten(how: Repeats, names: list[str]):
    def run(batches):
        for batch in batches:
            lists = pc.fill_null(batch.column("__runs"), [])
            edge = np.asarray(lists.offsets)
            edge = edge - edge[0]
            runs = lists.flatten()
            fields = [runs.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "edges", "mask", "proof")]
            kept, n_words, n_removed, spans = [], [], [], []
            for first, data, offsets in words.chunks(batch.column("text")):
                if edge[first] < edge[first + len(offsets) - 1]:
                    starts, ends, bounds = words.spans(data, offsets)
                    hashes = words.word_hashes(data, starts, ends, seed=1)
                for i in range(len(offsets) - 1):
                    parts = data[offsets[i] : offsets[i + 1]].tobytes().split()
                    n_words.append(len(parts))
                    own = slice(edge[first + i], edge[first + i + 1])
                    if own.start < own.stop:
                        gone = _gone(how, hashes[bounds[i] : bounds[i + 1]], *(f[own] for f in fields))
                        parts = list(compress(parts, (~gone).tolist()))
                        at = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0])))).tolist()
                        spans.append([{"first": a, "last": b - 1} for a, b in zip(at[::2], at[1::2])])
                    else:
                        spans.append([])
                    n_removed.append(n_words[-1] - len(parts))
                    kept.append(b" ".join(parts).decode())
            added = [pa.array(c, t) for c, t in zip((kept, n_words, n_removed, spans), ADDED.values())]
            schema = [batch.schema.field(n) for n in names] + [pa.field(n, t) for n, t in ADDED.items()]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + added, schema=pa.schema(schema))

    return run


def without_repeats(df: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """``df`` with kept_text, n_words, n_removed and removed (word spans, first to last).

    Removed is each word covered by a window whose word sequence also starts in a document with a smaller doc_id, judged
    on the input. kept_text has the other words joined by one space. Null, empty and blank texts have no words and an
    empty kept_text; a null doc_id loses nothing and is no source. Rows that share a doc_id are no source of each other.
    Columns named like the four are replaced; all others stay. An empty table gives no rows.
    """
    rows = text_batches(df).select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    paths = rows.mapInArrow(_paths(how), PATH_SQL)
    anchors = paths.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("anchor")
    # Written first: the join then reads both sides from plain exchanges, whose hot keys adaptive execution splits.
    anchors = stored(anchors, "anchors")
    repeated = stored(paths.join(anchors, "anchor", "left_semi"), "paths")
    dropped(anchors)

    compact = repeated.groupBy("anchor", "path", "edges").agg(F.min(F.struct("doc", "start")).alias("source"))
    compact = stored(compact.select("anchor", "path", "edges", "source.doc", "source.start"), "compact")
    branching = compact.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor", F.lit(True).alias("branches"))
    origins = compact.join(branching, "anchor", "left").withColumn("branches", F.coalesce("branches", F.lit(False)))
    origins = origins.groupBy("doc").agg(F.collect_list(F.struct("anchor", "path", "start", "edges", "branches")).alias("paths"))
    read = stored(origins.join(rows, "doc").mapInArrow(_sources(how), SOURCE_SQL), "sources")

    edges = read.where("place >= 0").select("anchor", "path", "doc", "edge", "place")
    least = edges.groupBy("anchor", "edge").agg(F.min("doc").alias("least"))
    earlier = edges.join(least, ["anchor", "edge"]).where("least < doc").select("anchor", "path", "place").distinct()
    masks = earlier.groupBy("anchor", "path").agg(F.sum(F.expr("shiftleft(1L, place)")).alias("own_mask"))
    proofs = read.where("place = -1").groupBy("anchor", "path").agg(F.first("proof").alias("proof"))
    known = compact.select("anchor", "path", F.col("doc").alias("source")).join(proofs, ["anchor", "path"]).join(masks, ["anchor", "path"], "left")
    known = stored(known, "known")
    dropped(compact, read)
    whole = F.expr("shiftleft(1L, edges) - 1")
    mask = F.when(F.col("doc") > F.col("source"), whole).otherwise(F.coalesce("own_mask", F.lit(0)))
    runs = repeated.join(known, ["anchor", "path"]).withColumn("mask", mask).where("mask != 0")
    runs = runs.groupBy("doc").agg(F.collect_list(F.struct("start", "edges", "mask", "proof")).alias("__runs"))
    runs = stored(runs.withColumnRenamed("doc", "__run_doc"), "runs")
    dropped(repeated, known)

    names = [c for c in df.columns if c not in ADDED]
    df = df.withColumn("text", F.col("text").cast("string"))
    keyed = df.select(*names, F.col("doc_id").cast("long").alias("__key"))
    keyed = keyed.join(runs, keyed["__key"] == runs["__run_doc"], "left").select(*names, "__runs")
    schema = T.StructType([df.schema[n] for n in names] + T.StructType.fromDDL(ADDED_SQL).fields)
    return keyed.mapInArrow(_rewritten(how, names), schema)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13-word windows over all documents."""
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13
), windows AS (
  SELECT s.doc_id, s.i, array_to_string(w.words[s.i : s.i + 12], ' ') AS seq FROM starts s JOIN w USING (doc_id)
), least AS (
  SELECT seq, min(doc_id) AS least FROM windows GROUP BY seq
), hit AS (
  SELECT windows.doc_id, i FROM windows JOIN least USING (seq) WHERE least < windows.doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM hit
), lists AS (
  SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id
), each AS (
  SELECT w.doc_id, words, unnest(range(1, len(words) + 1)) AS j FROM w
), left_over AS (
  SELECT e.doc_id, string_agg(e.words[e.j], ' ' ORDER BY e.j) AS kept, count(*) AS n
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.j = g.j GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_over USING (doc_id)
"""
