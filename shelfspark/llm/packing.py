"""Best-fit packing with a swap-based local search, on the counts of piece lengths.

Pieces of one length are interchangeable, so the packing is planned on how many pieces each length has: numbers for at
most ``capacity`` lengths, whatever the input. A plan is a set of patterns (which lengths share a bin) with the number of
bins of each. Best fit decreasing makes the first plan. The local search then takes the emptiest underfull bins and moves
a piece out of them, swaps one of theirs for a smaller one, or two of theirs for a smaller one, into fuller bins: each
step raises the sum of squared fills, until bins are empty or no step is left. A step is applied to all bins of the two
patterns at once.

Pieces find their places by their rank within their length. Ranks are counted in salted parts, so that a length that a
third of all pieces have is spread over many tasks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.llm import tokens
from shelfspark.llm.storage import stored, text_batches

CAPACITY = 2048
END = 0
VOCABULARY = "word_bpe_49k.json"
# Fixed value: a special token of the vocabulary, which cuts a text and never stands in a word's ids.
SEPARATOR = b"<|endoftext|>"
RANK_ROWS = 200_000

Pattern = tuple[int, ...]


# ------------------------------------------------------------------ the plan
def best_fit(counts: dict[int, int], capacity: int) -> Counter[Pattern]:
    """Best fit decreasing. Bins of one pattern are filled together; a length opens at most three patterns."""
    by_room: dict[int, Counter[Pattern]] = {}
    rooms: list[int] = []

    def put(pattern: Pattern, bins: int) -> None:
        room = capacity - sum(pattern)
        if room not in by_room:
            by_room[room] = Counter()
            insort(rooms, room)
        by_room[room][pattern] += bins

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                pattern, bins = by_room[room].popitem()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            else:
                room, pattern, bins = capacity, (), left
            each = room // length
            used = min(bins, left // each)
            if used:
                put(pattern + (length,) * each, used)
                left -= used * each
                bins -= used
            if bins and left and left < each:
                put(pattern + (length,) * left, 1)
                left, bins = 0, bins - 1
            if bins and pattern:
                put(pattern, bins)
    return sum(by_room.values(), Counter())


@lru_cache(maxsize=1 << 18)
def _step(low: Pattern, high: Pattern, room: int) -> tuple[int, Pattern, Pattern] | None:
    """The exchange that fills ``high`` most: (gain, pieces out of ``low``, pieces out of ``high``)."""
    best: tuple[int, Pattern, Pattern] | None = None
    singles = sorted(set(low), reverse=True)
    pairs = {tuple(sorted((low[i], low[j]))) for i in range(len(low)) for j in range(i)}
    for back in [()] + [(y,) for y in set(high)]:
        given = sum(back)
        for out in [(x,) for x in singles] + (list(pairs) if back else []):
            gain = sum(out) - given
            if 0 < gain <= room and (best is None or gain > best[0]):
                best = gain, out, back
                if gain == room:
                    return best
    return best


def _replaced(pattern: Pattern, out: Pattern, into: Pattern) -> Pattern:
    left = list(pattern)
    for x in out:
        left.remove(x)
    return tuple(sorted(left + list(into), reverse=True))


def improved(plan: Counter[Pattern], capacity: int) -> Counter[Pattern]:
    """The local search. It ends when the number of bins is the least possible, or no step raises the squared fill.

    Every step raises the sum of squared fills, which is bounded, so the search ends by itself. Underfull patterns are kept
    in order of their fill; the emptiest that is not known to be stuck comes first. A pattern that has no step with any
    fuller one is tried again only with patterns that are new since then.
    """
    plan = Counter({tuple(sorted(p, reverse=True)): m for p, m in plan.items()} if plan else {})
    least = -(-sum(sum(p) * m for p, m in plan.items()) // capacity)
    bins = sum(plan.values())
    open_ = sorted((sum(p), p) for p in plan if sum(p) < capacity)
    born = {p: 0 for _, p in open_}
    tried: dict[Pattern, int] = {}
    clock = 0

    def add(pattern: Pattern, times: int) -> None:
        if pattern not in plan and sum(pattern) < capacity:
            insort(open_, (sum(pattern), pattern))
            born[pattern] = clock
        plan[pattern] += times

    def take(pattern: Pattern, times: int) -> None:
        plan[pattern] -= times
        if not plan[pattern]:
            del plan[pattern]
            if sum(pattern) < capacity:
                del open_[bisect_left(open_, (sum(pattern), pattern))], born[pattern]
                tried.pop(pattern, None)

    waiting = [p for _, p in open_]  # in the order in which they are tried; sorted by fill
    place = 0
    while bins > least and place < len(waiting):
        low = waiting[place]
        if low not in born:
            place += 1
            continue
        clock += 1
        since, fill = tried.get(low, -1), sum(low)
        best = None
        for size, high in reversed(open_):
            if size < fill:
                break
            if born[high] <= since or (high == low and plan[low] < 2):
                continue
            step = _step(low, high, capacity - size)
            # A gain must leave the fuller bin fuller than before; among steps the tightest fit wins.
            if step and (best is None or capacity - size - step[0] < best[0]):
                best = capacity - size - step[0], high, step
                if best[0] == 0:
                    break
        if best is None:
            tried[low] = clock
            place += 1
            continue
        _, high, (_, out, back) = best
        times = plan[low] // 2 if high == low else min(plan[low], plan[high])
        for p in (low, high):
            take(p, times)
        emptied, filled = _replaced(low, out, back), _replaced(high, back, out)
        add(filled, times)
        if emptied:
            add(emptied, times)
        else:
            bins -= times
        # What is new may be a partner for any pattern that is no fuller: they wait again, from the emptiest on.
        waiting, place = [p for _, p in open_], 0
    return plan


def planned(counts: dict[int, int], capacity: int = CAPACITY) -> Counter[Pattern]:
    return improved(best_fit(counts, capacity), capacity)


def layout(plan: Counter[Pattern]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, pieces a bin, first bin, offset in the bin), by first rank."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter[int] = Counter()
    first_bin = 0
    for pattern, bins in sorted(plan.items()):
        offset = 0
        for length, each in sorted(Counter(pattern).items(), reverse=True):
            rows.setdefault(length, []).append((ranks[length], each, first_bin, offset))
            ranks[length] += each * bins
            offset += each * length
        first_bin += bins
    return {k: np.array(v, np.int64) for k, v in rows.items()}


# ------------------------------------------------------------------ the work on all pieces
_units: dict[str, tokens.Units] = {}


def _vocabulary(name: str) -> tokens.Units:
    """The tokenizer of this worker, with the units it has encoded."""
    if name not in _units:
        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        mark = SEPARATOR.decode()
        cut = tokenizer.token_to_id(mark)
        if cut is None:
            raise ValueError(f"the vocabulary has no {mark}")

        def encode(spelt: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            # One call for all units, each between two marks; a unit that holds a mark itself goes by itself.
            alone = [i for i, x in enumerate(spelt) if SEPARATOR in x.lower()]
            joined = [b"" if SEPARATOR in x.lower() else x for x in spelt] if alone else spelt
            ids = np.array(tokenizer.encode_batch_fast([SEPARATOR.join(joined).decode()], add_special_tokens=False)[0].ids, np.int64)
            ends = np.append(np.flatnonzero(ids == cut), len(ids))
            counts = np.diff(ends, prepend=-1) - 1
            flat = ids[ids != cut]
            if alone:
                parts = np.split(flat, np.cumsum(counts)[:-1])
                for i in alone:
                    parts[i] = np.array(tokenizer.encode(spelt[i].decode(), add_special_tokens=False).ids, np.int64)
                counts, flat = np.array([len(x) for x in parts]), np.concatenate(parts)
            return flat, counts

        _units[name] = tokens.Units(encode, kind=np.uint16 if tokenizer.get_vocab_size() <= 1 << 16 else np.int32)
    return _units[name]


def _cut(name: str, capacity: int, with_ids: bool):
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _vocabulary(name)
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            out: list[list] = [[] for _ in schema]
            for row, ids in tokens.word_ids(batch.column("text"), units):
                ids = np.append(ids, END).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    values = [docs[row], piece, start, len(part), zlib.crc32(part.tobytes())] + ([part.astype(np.int32)] if with_ids else [])
                    for column, x in zip(out, values):
                        column.append(x)
                if with_ids and len(out[0]) > 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
                    out = [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return run


def pieces(df: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row of ``df`` (doc_id, text; others are not read).

    Null, empty and blank texts are the end id alone. A null doc_id stays null. Repeated rows give repeated pieces.
    """
    rows = text_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(_cut(vocabulary, capacity, with_ids), schema)


def _placed(places, names: list[str]):
    def run(batches):
        by_length = places.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("__rank").to_numpy()
            bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                here = np.flatnonzero(lengths == length)
                table = by_length[length]
                row = table[np.searchsorted(table[:, 0], ranks[here], "right") - 1]
                within = ranks[here] - row[:, 0]
                bins[here] = row[:, 2] + within // row[:, 1]
                offsets[here] = row[:, 3] + within % row[:, 1] * length
            fields = [batch.schema.field(n) for n in names] + [pa.field("sequence_id", pa.int64()), pa.field("offset", pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(bins), pa.array(offsets)], schema=pa.schema(fields))

    return run


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (rows with a ``length`` of 1 to ``capacity``) with sequence_id and offset.

    Offsets of a sequence are gapless from 0; which of the pieces of one length goes where is arbitrary. Columns named
    sequence_id and offset are replaced. An empty table gives no rows.
    """
    spark = cut.sparkSession
    names = [c for c in cut.columns if c not in ("sequence_id", "offset", "__salt")]
    salted = stored(cut.select(*names, F.spark_partition_id().alias("__salt")), "pieces")
    rows = salted.groupBy("length").agg(F.count("*").alias("n")).collect()  # one row a length at most
    parts = max(16, sum(r.n for r in rows) // RANK_ROWS)
    salted = salted.withColumn("__salt", F.pmod(F.xxhash64(*names), F.lit(parts)))
    sizes = salted.groupBy("length", "__salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "__salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    ranked = salted.withColumn("__own", F.row_number().over(Window.partitionBy("length", "__salt").orderBy(*names)))
    ranked = ranked.join(sizes, ["length", "__salt"]).withColumn("__rank", F.col("__before") + F.col("__own") - 1)
    places = spark.sparkContext.broadcast(layout(planned({r.length: r.n for r in rows}, capacity)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in salted.schema if f.name in names)
    return ranked.select(*names, "__rank").mapInArrow(_placed(places, names), f"{schema}, sequence_id long, offset long")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packed(pieces(spark.read.parquet(f"{sf_dir}/documents.parquet")))
