"""Cross-tokenizer alignment of two vocabularies over the bytes of whole texts.

1. A batch of texts is encoded by both tokenizers; tokens of both sides are rows (document, byte start, byte end).
2. ``pandas.merge_asof``, keyed by the document, gives each token start the other side's covering token; the union of both
   directions is all overlapping token pairs. Where two overlapping tokens end at the same byte, a group ends.
3. Links are all pairs of one group. Of a document its distinct id pairs with their numbers of links are kept.
4. Corpus-wide counts: documents are dealt into blocks of about ``BLOCK_PAIRS`` distinct pairs of documents. A block counts
   its pairs by itself, so only its distinct pairs are shuffled, not those of every document. Spark sums them up.
5. Each block gets the counts of its own pairs back, and meets its documents in a co-grouped pass. A block is bounded, and
   a pair that all documents hold is one row a block.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import bpe
from shelfspark.llm.storage import dropped, stored, text_batches

BYTE_LEVEL = "byte_bpe_50k"
PIECES = "piece_bpe_32k.model"
BATCH_BYTES = 1 << 20
BLOCK_PAIRS = 2_000_000
EXPANDED = 4_000_000
# Longest run without white space, in characters, for the library that takes quadratic time on such a run.
LONG_RUN = 2000
SPACE = "▁"


class Pair:
    """The two tokenizers of a worker, with the bytes and the decimal digits of their ids."""

    def __init__(self, byte_level: str, pieces: str):
        import public_tokenizers
        import regex
        import sentencepiece
        import tiktoken

        with open(public_tokenizers.path(f"{byte_level}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.name = f"{byte_level}.json"
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces))
        spelt = [b""] * (max(ranks.values()) + 1)
        for x, i in ranks.items():
            spelt[i] = x
        self.sizes_a = np.array([len(x) for x in spelt], np.int64)
        own = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        own = [bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace(SPACE, " ").encode() for i, x in enumerate(own)]
        self.sizes_b = np.array([len(x) for x in own], np.int64)
        self.n_b = len(own)
        most = max(len(spelt), len(own))
        # Entry 3 * id + k: the id and what stands behind it, a comma, a bar or a semicolon.
        self.digits = bpe.Offsets([b"%d%c" % (i, c) for i in range(most) for c in b",|;"])
        self.long_run = regex.compile(rf"\S{{{LONG_RUN}}}")
        self.slow: bpe.Encoder | None = None

    def ids_a(self, text: str) -> np.ndarray:
        if len(text) < LONG_RUN or not self.long_run.search(text):
            return self.a.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        if self.slow is None:
            import public_tokenizers

            self.slow = bpe.Encoder(public_tokenizers.path(self.name))
        return np.array(self.slow.plain(text), np.int64)

    def ids_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        lists = self.b.encode(texts, num_threads=1)
        return np.fromiter(chain.from_iterable(lists), np.int64), np.fromiter(map(len, lists), np.int64, len(lists))


_workers: dict[tuple[str, str], Pair] = {}


def worker(names: tuple[str, str]) -> Pair:
    if names not in _workers:
        _workers[names] = Pair(*names)
    return _workers[names]


def _ranges(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def overlaps(doc_a, start_a, end_a, doc_b, start_b, end_b) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i, j) of tokens of one document whose byte ranges overlap, in no order, each once.

    Starts increase over the whole batch and the tokens of a document leave no gap, so the last start at or before a
    place is that of the token that covers it.
    """
    a = pd.DataFrame({"at": start_a, "doc": doc_a, "i": np.arange(len(start_a))})
    b = pd.DataFrame({"at": start_b, "doc": doc_b, "j": np.arange(len(start_b))})
    down = pd.merge_asof(a, b, on="at", by="doc")
    up = pd.merge_asof(b, a, on="at", by="doc", allow_exact_matches=False)  # equal starts are in ``down``
    down, up = down[down["j"].notna()], up[up["i"].notna()]
    return (np.concatenate([x["i"].to_numpy(np.int64) for x in (down, up)]), np.concatenate([x["j"].to_numpy(np.int64) for x in (down, up)]))


def _group_of(last: np.ndarray) -> np.ndarray:
    """Group number of each token; ``last`` marks those that end one."""
    return np.cumsum(last) - last


def linked_pairs(group_a, ids_a, group_b, ids_b, doc_of_group, n_b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document << 32 | id pair, links) over all groups: the product of each group's distinct ids, in bounded parts."""
    groups = len(doc_of_group)
    n_a, m_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(m_b) - m_b
    size = n_a * m_b
    lo = 0
    edges = np.cumsum(size)
    while lo < groups:
        hi = max(lo + 1, int(np.searchsorted(edges, (edges[lo - 1] if lo else 0) + EXPANDED, "right")))
        if hi == lo + 1 and size[lo] > EXPANDED:
            # One group beyond the bound: each distinct id of one side against the distinct ids of the other.
            one, times = np.unique(ids_a[first_a[lo] : first_a[lo] + n_a[lo]], return_counts=True)
            two, number = np.unique(ids_b[first_b[lo] : first_b[lo] + m_b[lo]], return_counts=True)
            for x, n in zip(one.tolist(), times.tolist()):
                yield (doc_of_group[lo] << 32) | (x * n_b + two), n * number
        else:
            own = np.repeat(np.arange(lo, hi), size[lo:hi])
            place = np.arange(len(own)) - np.repeat(edges[lo:hi] - size[lo:hi] - (edges[lo] - size[lo]), size[lo:hi])
            i, j = first_a[own] + place // m_b[own], first_b[own] + place % m_b[own]
            yield np.unique((doc_of_group[own] << 32) | (ids_a[i] * n_b + ids_b[j]), return_counts=True)
        lo = hi


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their numbers."""
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, numbers = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, numbers = keys[order], numbers[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(numbers, first)


def aligned(texts: list[str | None], pair: Pair) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups_sha256, id pairs, links of each) of every text.

    An id pair is a * (size of B's vocabulary) + b; pairs are distinct and sorted.
    """
    out: list[tuple] = [(0, 0, 0, 0, "", np.zeros(0, np.int32), np.zeros(0, np.int32))] * len(texts)
    rows = [i for i, t in enumerate(texts) if t]
    some = [texts[i] for i in rows]
    if not some:
        return out
    lists = [pair.ids_a(" " + t) for t in some]
    ids_a, counts_a = np.concatenate(lists), np.array([len(x) for x in lists], np.int64)
    ids_b, counts_b = pair.ids_b(some)
    n_bytes = np.array([len(t.encode()) + 1 for t in some], np.int64)
    doc_a, doc_b = (np.repeat(np.arange(len(some)), n) for n in (counts_a, counts_b))
    size_a, size_b = pair.sizes_a[ids_a], pair.sizes_b[ids_b]
    # Bytes can differ only where a text holds B's sign for a space, which takes three bytes and stands for one.
    whole = (np.bincount(doc_a, size_a, len(some)).astype(np.int64) == n_bytes) & (np.bincount(doc_b, size_b, len(some)).astype(np.int64) == n_bytes)
    keep_a, keep_b = whole[doc_a], whole[doc_b]
    ids_a, doc_a, size_a = ids_a[keep_a], doc_a[keep_a], size_a[keep_a]
    ids_b, doc_b, size_b = ids_b[keep_b], doc_b[keep_b], size_b[keep_b]
    if not len(ids_a):
        return out
    start_a, end_a = _ranges(size_a)
    start_b, end_b = _ranges(size_b)
    i, j = overlaps(doc_a, start_a, end_a, doc_b, start_b, end_b)
    even = end_a[i] == end_b[j]
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[i[even]], last_b[j[even]] = True, True
    group_a, group_b = _group_of(last_a), _group_of(last_b)
    doc_of_group = doc_a[last_a].astype(np.int64)
    groups = len(doc_of_group)
    keys, links = _summed(list(linked_pairs(group_a, ids_a, group_b, ids_b, doc_of_group, pair.n_b)))
    # Where the tokens stand in the listing: groups in order, in each first A's ids and then B's.
    n_a, m_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    at_a = np.arange(len(ids_a)) + (np.cumsum(m_b) - m_b)[group_a]
    at_b = np.arange(len(ids_b)) + np.cumsum(n_a)[group_b]
    listed = np.empty(len(ids_a) + len(ids_b), np.int64)
    listed[at_a], listed[at_b] = 3 * ids_a + last_a, 3 * ids_b + 2 * last_b
    edge_a = np.searchsorted(doc_a, np.arange(len(some) + 1))
    edge_b = np.searchsorted(doc_b, np.arange(len(some) + 1))
    edge_keys = np.searchsorted(keys >> 32, np.arange(len(some) + 1))
    edge_groups = np.searchsorted(doc_of_group, np.arange(len(some) + 1))
    pairs = (keys & 0xFFFFFFFF).astype(np.int32)
    links = links.astype(np.int64)
    for k in np.flatnonzero(whole).tolist():
        own = slice(edge_keys[k], edge_keys[k + 1])
        text = pair.digits.joined(listed[edge_a[k] + edge_b[k] : edge_a[k + 1] + edge_b[k + 1]])[:-1]
        out[rows[k]] = (
            int(edge_a[k + 1] - edge_a[k]), int(edge_b[k + 1] - edge_b[k]), int(edge_groups[k + 1] - edge_groups[k]), int(links[own].sum()),
            hashlib.sha256(text).hexdigest(), pairs[own], links[own],
        )
    return out


ROW = pa.schema(
    [("doc_id", pa.int64()), ("block", pa.int64()), ("is_block", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64())]
    + [("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int32())), ("numbers", pa.list_(pa.int32()))]
)
ROW_SQL = "doc_id long, block long, is_block boolean, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, numbers array<int>"


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)))


def _record(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(c, f.type) for c, f in zip(columns[:-2], ROW)] + [_lists(c) for c in columns[-2:]]
    return pa.RecordBatch.from_arrays(arrays, schema=ROW)


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of rows of about BATCH_BYTES."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= BATCH_BYTES:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _documents(names: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = worker(names)
        block = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def counted() -> pa.RecordBatch:
            keys, numbers = _summed(held)
            return _record([(None, block, True, 0, 0, 0, 0, "", keys, numbers)])

        for batch in batches:
            docs, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for lo, hi in _parts(texts):
                found = aligned(texts[lo:hi], pair)
                yield _record([(d, block, False, *x) for d, x in zip(docs[lo:hi], found)])
                pairs = [x[5] for x in found if len(x[5])]
                if pairs:
                    held.append(np.unique(np.concatenate(pairs), return_counts=True))
                    size += len(held[-1][0])
                if size >= BLOCK_PAIRS:
                    yield counted()
                    held, size, block = [], 0, block + 1
        if held:
            yield counted()

    return run


OUT = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [("groups_sha256", pa.string())])
OUT_SQL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _with_counts(documents: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of each document of a block; ``counts`` holds every pair of the block."""
    order = np.argsort(counts.column("pair").to_numpy())
    pairs = counts.column("pair").to_numpy()[order]
    n, best = counts.column("n").to_numpy()[order], counts.column("best").to_numpy()[order]
    sums, bests = [], []
    for batch in documents.select(["pairs", "numbers"]).to_batches():
        lists = batch.column("pairs")
        edges = np.asarray(lists.offsets) - np.asarray(lists.offsets)[0]
        numbers = batch.column("numbers").flatten().to_numpy().astype(np.int64)
        at = np.searchsorted(pairs, lists.flatten().to_numpy())
        for out, values in ((sums, numbers * n[at] if len(at) else numbers), (bests, numbers * best[at] if len(at) else numbers)):
            out.append(np.diff(np.concatenate(([0], np.cumsum(values)))[edges]))
    added = {"n_best": np.concatenate(bests), "count_sum": np.concatenate(sums)} if sums else {"n_best": [], "count_sum": []}
    columns = [pa.chunked_array([pa.array(added[f.name], f.type)]) if f.name in added else documents.column(f.name).cast(f.type) for f in OUT]
    return pa.Table.from_arrays(columns, schema=OUT)


def alignments(df: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) of ``df`` (doc_id, text; other columns are not read).

    Documents, one row for each of ``df``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Pairs: a_id,
    b_id, n (documents that hold it linked) and best (0 or 1: no pair of its A id has more). Rows count as documents of
    their own, also if they share a doc_id or have none. Null and empty texts, and texts whose bytes a tokenizer does not
    give back, have no tokens: zeros and ''. Empty tables give no rows.
    """
    spark: SparkSession = df.sparkSession
    import public_tokenizers
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces)).vocab_size()
    rows = text_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(rows.mapInArrow(_documents((byte_level, pieces)), ROW_SQL), "aligned")
    by_block = found.where("is_block").select("block", F.explode(F.arrays_zip("pairs", "numbers")).alias("x"))
    by_block = by_block.select("block", F.col("x.pairs").alias("pair"), F.col("x.numbers").cast("long").alias("n"))
    total = by_block.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a_id", F.floor(F.col("pair") / n_b).cast("int"))
    total = stored(total, "totals")
    most = total.groupBy("a_id").agg(F.max("n").alias("most"))
    counts = stored(total.join(most, "a_id").select("a_id", "pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best")), "counts")
    dropped(total)
    own = by_block.select(F.col("block").alias("of_block"), "pair").join(counts.select("pair", "n", "best"), "pair")
    documents = found.where("not is_block").drop("is_block")
    summed = documents.groupBy("block").cogroup(own.groupBy("of_block")).applyInArrow(_with_counts, OUT_SQL)
    return summed, counts.select("a_id", (F.col("pair") - F.col("a_id") * n_b).alias("b_id"), "n", "best")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, byte-level BPE against pieces."""
    return alignments(spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]
