"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A document's set holds its distinct word n-grams, lower-cased, as 64-bit hashes; a shorter text is one n-gram as a whole.

1. Documents with equal sets form a class; only a class is compared, so copies cost nothing further. A class is known by
   a 64-bit sum over its set and the set's size.
2. Sets are ordered rare first. Frequencies come from a count of all documents over a fixed number of hash slots: any
   total order gives right results, and this one keeps frequent n-grams out of the prefixes at a bounded size.
3. Prefix rows (n-gram, set, size, position) whose n-gram no other row holds are dropped.
4. Star round: each n-gram's rows are compared with the row in which it stands earliest, the most typical set. Pairs pass
   the length filter, the positional filter (neither set may have more n-grams before the shared one than a link allows)
   and the suffix filter (hash ranges cut the sets at fixed pivots; the smaller counts of each range bound the overlap).
   Each pair left is verified once, on the whole texts, by hashes of their words' bytes that the search does not use.
5. Rest round: only pairs whose sets are still in different components can add anything. Within an n-gram, rows of its
   largest component meet the other rows only, never each other.

So no group is expanded into all its pairs, and no link that could join two components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import words
from shelfspark.llm.components import components
from shelfspark.llm.storage import dropped, stored, text_batches

SLOT_BITS = 18
SLOT_PARTS = 16
RANGES = 16


@dataclass(frozen=True)
class Similarity:
    """Sets link when ``of * intersection >= at_least * union``."""

    n_words: int = 5
    at_least: int = 80
    of: int = 100

    def overlap(self, a, b):
        """The least intersection of linked sets of sizes a and b; for numbers and for columns."""
        total = (a + b) * self.at_least + (self.of + self.at_least - 1)
        divisor = self.of + self.at_least
        return F.floor(total / divisor) if isinstance(total, Column) else total // divisor

    def prefix(self, n: int) -> int:
        return n - (n * self.at_least + self.of - 1) // self.of + 1


def _sets(batches: Iterator[pa.RecordBatch], n_words: int):
    """(doc_id, set) of every row."""
    for batch in batches:
        ids = batch.column("doc_id")
        for row, hashes in words.rows_of_words(batch.column("text"), lower=True):
            yield ids[row].as_py(), words.shingle_set(hashes, n_words)


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of columns (arrays or lists) gathered to batches."""
    kept: list[tuple] = []
    size = 0
    for row in rows:
        kept.append(row)
        size += len(row[0])
        if size >= most:
            yield _batch(kept, schema)
            kept, size = [], 0
    if kept:
        yield _batch(kept, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c), f.type) if isinstance(c[0], np.ndarray) else pa.array([x for y in c for x in y], f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


def _key(shingles: np.ndarray) -> int:
    """A hash of a set, whatever its order."""
    with np.errstate(over="ignore"):
        return int(words.signed(words.mixed(np.array([words.mixed(shingles, 1).sum(dtype=np.uint64)], np.uint64), 2))[0])


MARK = "doc_id long, n int, node long, ranges array<int>"


def _marks(similarity: Similarity):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("ranges", pa.list_(pa.int32()))])

    def rows(batches):
        shift = np.uint64(64 - int(np.log2(RANGES)))
        for doc_id, shingles in _sets(batches, similarity.n_words):
            n = len(shingles)
            ranges = np.bincount((shingles >> shift).astype(np.int64), minlength=RANGES).tolist() if n else None
            yield [doc_id], [n], [_key(shingles) if n else None], [ranges]

    return lambda batches: _batches(rows(batches), schema, 10_000)


def _slot_counts(similarity: Similarity):
    schema = pa.schema([("part", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for _, shingles in _sets(batches, similarity.n_words):
            np.add.at(counts, (shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64), 1)
        parts = [x.tobytes() for x in np.split(counts, SLOT_PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLOT_PARTS), pa.int32()), pa.array(parts, pa.binary())], schema=schema)

    return run


def _added(batches):
    """Sums the counts of each part; one array a part is held."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
            values = np.frombuffer(counts.as_buffer(), np.int64)
            if part in sums:
                sums[part] += values
            else:
                sums[part] = values.copy()
    schema = pa.schema([("part", pa.int32()), ("counts", pa.binary())])
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], schema=schema)


def frequencies(texts: DataFrame, similarity: Similarity) -> np.ndarray:
    """Documents per hash slot of n-grams, over all documents: 2 MB whatever the input."""
    schema = "part int, counts binary"
    parts = texts.mapInArrow(_slot_counts(similarity), schema).repartition(SLOT_PARTS, "part").mapInArrow(_added, schema)
    got = {r.part: np.frombuffer(r.counts, np.int64) for r in parts.collect()}
    return np.concatenate([got[i] for i in range(SLOT_PARTS)]) if got else np.zeros(1 << SLOT_BITS, np.int64)


def _prefixes(similarity: Similarity, counts):
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])

    def rows(batches):
        slots = counts.value
        seen: set[int] = set()
        for batch in batches:
            if len(seen) > 100_000:
                seen.clear()
            for _, shingles in _sets([batch], similarity.n_words):
                n = len(shingles)
                node = _key(shingles) if n else None
                if not n or node in seen:
                    continue
                seen.add(node)
                p = similarity.prefix(n)
                frequency = slots[(shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                first = shingles[np.argsort(frequency, kind="stable")[:p]]
                yield words.signed(first), np.full(p, node, np.int64), np.full(p, n, np.int32), np.arange(p, dtype=np.int32)

    return lambda batches: _batches(rows(batches), schema, 100_000)


def _passing(similarity: Similarity, left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
    """Distinct pairs (a, b, a_ranges.. by id) of rows that share an n-gram and pass the length and positional filters."""
    short, long = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    needed = similarity.overlap(F.col("x.n"), F.col("y.n"))
    fits = (short * similarity.of >= long * similarity.at_least) & (F.col("x.n") - F.col("x.pos") >= needed) & (F.col("y.n") - F.col("y.pos") >= needed)
    pairs = left.alias("x").join(right.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.id") != F.col("y.id")) & fits & on)
    return pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def _close(similarity: Similarity, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The suffix filter."""
    a = nodes.select(F.col("id").alias("a"), F.col("n").alias("a_n"), F.col("ranges").alias("a_ranges"))
    b = nodes.select(F.col("id").alias("b"), F.col("n").alias("b_n"), F.col("ranges").alias("b_ranges"))
    both = pairs.join(a, "a").join(b, "b")
    most = F.aggregate(F.zip_with("a_ranges", "b_ranges", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    return both.where(most >= similarity.overlap(F.col("a_n"), F.col("b_n"))).select("a", "b")


def _verified(similarity: Similarity):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        last_id, last = None, None
        for batch in batches:
            ids_a, ids_b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            for i, (row, hashes) in enumerate(words.rows_of_words(batch.column("b_text"), lower=True, seed=1)):
                # Rows of the same a follow each other, so its set is made once.
                if ids_a[i] != last_id:
                    last_id = ids_a[i]
                    last = words.shingle_set(next(words.rows_of_words(batch.column("a_text").slice(i, 1), lower=True, seed=1))[1], similarity.n_words)
                other = words.shingle_set(hashes, similarity.n_words)
                shared = len(np.intersect1d(last, other, assume_unique=True))
                keep.append(similarity.of * shared >= similarity.at_least * (len(last) + len(other) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], schema=schema)

    return run


def _links(similarity: Similarity, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    whole = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text")), "b")
    whole = whole.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text")), "a")
    return whole.select("a", "b", "a_text", "b_text").mapInArrow(_verified(similarity), "u long, v long")


def near_duplicates(df: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``df`` (doc_id, text; other columns are not read).

    component_id is the smallest doc_id that links reach. Null, empty and blank texts have no set, n_shingles 0 and are
    their own component; a text with fewer words than an n-gram is one n-gram. Repeated rows give repeated results. A
    null doc_id gives a null component and takes no part in linking. An empty table gives no rows. A doc_id names one
    text: of rows that share it with different texts, one text is verified for all of them.
    """
    spark: SparkSession = df.sparkSession
    rows = text_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = stored(rows.mapInArrow(_marks(similarity), MARK), "marks")
    texts = rows.where("doc_id is not null")
    nodes = stored(
        marks.where("doc_id is not null and n > 0").groupBy("node", "n").agg(F.min("doc_id").alias("id"), F.first("ranges").alias("ranges")), "nodes"
    )
    counts = spark.sparkContext.broadcast(frequencies(texts, similarity))
    prefixes = texts.mapInArrow(_prefixes(similarity, counts), "token long, node long, n int, pos int")
    repeated = prefixes.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1").select("token")
    shared = prefixes.join(repeated, "token", "left_semi").distinct()
    shared = stored(shared.join(nodes.select("node", "n", "id"), ["node", "n"]).select("token", "id", "n", "pos"), "shared")
    some = shared.select(F.col("id").alias("doc_id")).distinct()
    whole = stored(texts.join(some, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")

    first = shared.groupBy("token").agg(F.min(F.struct("pos", "n", "id")).alias("first")).select("token", "first.*")
    stars = _close(similarity, _passing(similarity, shared, first, F.lit(True)), nodes)
    stars = stored(stars, "stars")
    links = stored(_links(similarity, stars, whole), "star-links")

    joined = components(links)
    placed = shared.join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = stored(placed, "placed")
    sizes = placed.groupBy("token", "component").agg(F.count("*").alias("rows")).groupBy("token")
    split = sizes.agg(F.max(F.struct("rows", "component")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    open_ = stored(placed.join(split.select("token", F.col("main.component").alias("main")), "token"), "open")
    rest = _passing(similarity, open_.where("component != main"), open_, F.col("x.component") != F.col("y.component"))
    rest = _close(similarity, rest, nodes).join(stars, ["a", "b"], "left_anti")
    rest = stored(_links(similarity, rest, whole), "rest-links")

    joined = stored(components(links.union(rest)), "components")
    dropped(shared, whole, stars, links, placed, open_, rest)
    placed = nodes.select("node", "n", "id").join(joined.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("node", "n", F.coalesce("component", "id").alias("component_id"))
    found = marks.select("doc_id", "node", "n").join(placed, ["node", "n"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-word shingles, Jaccard 0.85, over all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), Similarity(4, 85, 100))


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), grams AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) >= 4
    THEN list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' '))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END)) AS gram FROM w
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT u, v FROM pairs JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v WHERE 100 * shared >= 85 * (a.n + b.n - shared)
), reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT v, root FROM reach JOIN links ON node = u
)
SELECT w.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id
FROM w LEFT JOIN sizes USING (doc_id) JOIN reach ON node = w.doc_id GROUP BY w.doc_id
"""
