"""The trie of conversations that share their first turns, by composable fingerprints.

A run of turns has a fingerprint (number of turns, sum of each turn's value times a power of a base by its place), modulo
four primes. Fingerprints form a monoid: (n, x)(m, y) = (n + m, x + base**n * y). A part of a run follows from two of its
prefixes, so a rebuilt conversation, the head of one and the rest of another, gets the fingerprints of all its prefixes
from numbers that are already there; no rebuilt text is made and no turn is sent again.

1. Turns are sorted by range, so one conversation may spread over many tasks. Each task sums up its own turns; the sums of
   a conversation's tasks are then combined in order, one row a task.
2. A rebuilt conversation is (base, number of head turns) and (itself, turns after its own head). Each prefix is a row that
   refers to a stored turn by its place and its SHA-256.
3. Prefixes with equal fingerprints are one node. Every node is verified: all its rows must refer to equal last turns and
   have one parent, which by induction makes the sequences equal. If any fails, all is done again with other bases.
4. Each node belongs to its smallest member, so the nodes of a member are the end of its path. Sums over subtrees are then
   sums over members: what all members of a node own, less what its owner owns above it. No level is visited after another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.llm.storage import dropped, stored

# The largest primes below 2**31, so that a product fits a long.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
LANES = range(len(PRIMES))
GROUP = 5
MOST_HEAD = 8
DEPTH_BLOCK = 4096
CHUNK_IDS = 4096


def bases(seed: int) -> list[int]:
    """A base for each prime."""
    return [int.from_bytes(hashlib.sha256(b"%d %d" % (seed, i)).digest()[:8], "big") % (p - 3) + 2 for i, p in enumerate(PRIMES)]


def _lanes(letter: str) -> list[str]:
    return [f"{letter}{i}" for i in LANES]


def _powers(base: int, prime: int, count: int) -> np.ndarray:
    """base**0 to base**(count - 1), by doubling."""
    out = np.ones(1, np.int64)
    while len(out) < count:
        out = np.concatenate((out, out * pow(base, len(out), prime) % prime))
    return out[:count]


def _power_column(seed: int):
    def run(exponents: pa.Array) -> pa.Array:
        left = exponents.to_numpy(zero_copy_only=False).astype(np.int64)
        out = np.ones((len(left), len(PRIMES)), np.int64)
        factors = np.array(bases(seed), np.int64)
        primes = np.array(PRIMES, np.int64)
        while left.any():
            odd = (left & 1).astype(bool)
            out[odd] = out[odd] * factors % primes
            factors, left = factors * factors % primes, left >> 1
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * len(PRIMES)), pa.array(out.ravel()))

    return F.arrow_udf(run, "array<bigint>")


TURN = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("local", pa.int64()), ("ends_run", pa.bool_()), ("n_bytes", pa.int64())]
    + [(c, pa.int64()) for x in "dpq" for c in _lanes(x)]
)
TURN_SQL = "conv_id long, part int, local long, ends_run boolean, n_bytes long, " + ", ".join(f"{c} long" for x in "dpq" for c in _lanes(x))


def _summed(seed: int):
    """Places and fingerprints before (p) and after (q) each turn within a task's sorted rows; d: the turn's SHA-256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        base = bases(seed)
        held: list[np.ndarray] | None = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = batch.column("conv_id").to_numpy()
            digest = np.frombuffer(b"".join(batch.column("digest").to_pylist()), ">u8").reshape(n, 4)
            new = np.ones(n, bool)
            new[1:] = conv[1:] != conv[:-1]
            follows = held is not None and held[0][-1] == conv[0]
            new[0] = not follows
            begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            first_run = np.cumsum(new) == 0  # rows that go on with the run of the batch before
            offset = int(held[2][-1]) + 1 if follows else 0
            local = np.arange(n) - begin
            columns = [conv, np.full(n, part, np.int32), local + np.where(first_run, offset, 0), np.append(new[1:], True), batch.column("n_bytes").to_numpy()]
            after, before = [], []
            for i, prime in enumerate(PRIMES):
                term = (digest[:, i] % np.uint64(prime - 1)).astype(np.int64) + 1
                weight = _powers(base[i], prime, n)[local]
                if follows:
                    weight = np.where(first_run, weight * pow(base[i], offset, prime) % prime, weight)
                term = term * weight % prime
                total = np.cumsum(term)
                ahead = np.where(begin > 0, total[begin - 1], 0)
                own = total - ahead + (np.where(first_run, held[13 + i][-1], 0) if follows else 0)
                after.append(own % prime)
                before.append((own - term) % prime)
            columns += [np.ascontiguousarray(digest[:, i]).astype(np.uint64).view(np.int64) for i in LANES] + before + after
            if held is not None:
                held[3][-1] = not follows
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], schema=TURN)
            held = columns
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], schema=TURN)

    return run


def _times(a: Column | str, b: Column | str, lane: int) -> Column:
    return (F.col(a) if isinstance(a, str) else a) * (F.col(b) if isinstance(b, str) else b) % F.lit(PRIMES[lane])


def _turns(conversations: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(placed turns, runs): every turn with its place and its fingerprints in its conversation, and the tasks' shares."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "n_bytes", "digest")
    turns = stored(sorted_.mapInArrow(_summed(seed), TURN_SQL), "turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = turns.where("ends_run").select("conv_id", "part", (F.col("local") + 1).alias("n"), *_lanes("q"))
    runs = runs.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long"))).withColumn("power", _power_column(seed)("start"))
    for i in LANES:
        runs = runs.withColumn(f"w{i}", F.col("power")[i])
    carried = [(F.coalesce(F.sum(_times(f"q{i}", f"w{i}", i)).over(earlier), F.lit(0).cast("long")) % PRIMES[i]).alias(f"c{i}") for i in LANES]
    runs = stored(runs.select("conv_id", "part", "n", "start", *_lanes("w"), *carried), "runs")
    whole = turns.join(runs.select("conv_id", "part", "start", *_lanes("w"), *_lanes("c")), ["conv_id", "part"])
    moved = [((F.col(f"c{i}") + _times(f"{x}{i}", f"w{i}", i)) % PRIMES[i]).alias(f"{x}{i}") for x in "pq" for i in LANES]
    placed = stored(whole.select("conv_id", "part", (F.col("start") + F.col("local")).alias("pos"), "n_bytes", *_lanes("d"), *moved), "placed")
    dropped(turns)
    return placed, runs


def _prefixes(placed: DataFrame, runs: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(rebuilt conversations, their prefixes): fingerprints f of each prefix and g of the one before it."""
    head = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % (MOST_HEAD + 1)).cast("long")
    own = runs.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumn("h", head).withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP)))
    early = placed.where(F.col("pos") <= MOST_HEAD).withColumn("h", head)
    # At most eight turns of each base.
    turn = F.struct("pos", "n_bytes", *_lanes("d"), *_lanes("p"), *_lanes("q"))
    heads = early.where((F.col("pos") < MOST_HEAD) & (F.pmod("conv_id", F.lit(GROUP)) == 0)).groupBy(F.col("conv_id").alias("base"))
    heads = heads.agg(F.sort_array(F.collect_list(turn)).alias("head"))
    cuts = early.where("pos = h").select("conv_id", *[F.col(f"p{i}").alias(f"x{i}") for i in LANES])
    convs = own.join(heads, "base", "left").join(cuts, "conv_id", "left")
    convs = convs.withColumn("hb", F.least("h", F.coalesce(F.size("head"), F.lit(0)).cast("long")))
    convs = convs.withColumn("hb", F.greatest("hb", F.lit(0).cast("long"))).withColumn("shift", (F.col("h") - F.col("hb")).cast("int"))
    convs = convs.withColumn("length", F.col("hb") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    for i in LANES:
        convs = convs.withColumn(f"y{i}", F.when(F.col("hb") > 0, F.element_at("head", F.col("hb").cast("int"))[f"q{i}"]).otherwise(F.lit(0).cast("long")))
    convs = stored(convs, "convs")

    at = F.explode(F.slice("head", F.lit(1), F.col("hb").cast("int")))
    of_heads = convs.where("hb > 0").select("conv_id", "length", at.alias("t")).select(
        "conv_id", F.lit(-1).alias("part"), (F.col("t.pos") + 1).alias("depth"), "t.n_bytes", *[f"t.{c}" for c in _lanes("d")],
        *[F.col(f"t.q{i}").alias(f"f{i}") for i in LANES], *[F.col(f"t.p{i}").alias(f"g{i}") for i in LANES], (F.col("t.pos") + 1 == F.col("length")).alias("is_end"),
    )
    base = bases(seed)
    back = {i: F.array(*[F.lit(pow(base[i], -k, PRIMES[i])).cast("long") for k in range(MOST_HEAD + 1)]) for i in LANES}

    def joined(own_letter: str, lane: int) -> Column:
        rest = F.pmod(F.col(f"{own_letter}{lane}") - F.col(f"x{lane}"), F.lit(PRIMES[lane]).cast("long"))
        return (F.col(f"y{lane}") + _times(rest, F.element_at(back[lane], F.col("shift") + 1), lane)) % PRIMES[lane]

    # Joined by task's share as well, so that a conversation with many turns is no hot key.
    shares = runs.select("conv_id", "part").join(convs.where("n > h").select("conv_id", "h", "hb", "shift", "length", *_lanes("x"), *_lanes("y")), "conv_id")
    depth = F.col("hb") + F.col("pos") - F.col("h") + 1
    of_rest = placed.join(shares, ["conv_id", "part"]).where("pos >= h").select(
        "conv_id", "part", depth.alias("depth"), "n_bytes", *_lanes("d"),
        *[joined("q", i).alias(f"f{i}") for i in LANES], *[joined("p", i).alias(f"g{i}") for i in LANES], (depth == F.col("length")).alias("is_end"),
    )
    return convs, stored(of_heads.unionByName(of_rest), "prefixes")


KEY = ["depth", *_lanes("f")]
ENDS = pa.schema([("depth", pa.int64()), *[(c, pa.int64()) for c in _lanes("f")], ("first", pa.int64()), ("ids", pa.string())])
ENDS_SQL = "depth long, " + ", ".join(f"{c} long" for c in _lanes("f")) + ", first long, ids string"
DIGEST = pa.schema([*[(c, pa.int64()) for c in KEY], ("ends_sha256", pa.string())])
DIGEST_SQL = "depth long, " + ", ".join(f"{c} long" for c in _lanes("f")) + ", ends_sha256 string"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of a node, joined in pieces."""
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in KEY], axis=1)
        ids = batch.column("conv_id").to_numpy()
        if not len(ids):
            continue
        new = np.ones(len(ids), bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        begin = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
        at = np.flatnonzero((np.arange(len(ids)) - begin) % CHUNK_IDS == 0).tolist()
        texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(at, [*at[1:], len(ids)])]
        yield pa.RecordBatch.from_arrays([*(pa.array(keys[at, i]) for i in range(len(KEY))), pa.array(ids[at]), pa.array(texts, pa.string())], schema=ENDS)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which follow each other; only the running digest is held."""
    last, running = None, None
    for batch in batches:
        done = []
        for key, ids in zip(zip(*(batch.column(c).to_pylist() for c in KEY)), batch.column("ids")):
            if key == last:
                running.update(b",")
            else:
                if last is not None:
                    done.append((*last, running.hexdigest()))
                last, running = key, hashlib.sha256()
            running.update(ids.as_py().encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), DIGEST)], schema=DIGEST)
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*last, running.hexdigest()), DIGEST)], schema=DIGEST)


def _ends(convs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The digest of the conversations that end at a node. A hot node's ids are joined in pieces before they meet."""
    turnless = convs.where("length = 0").select(F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in _lanes("f")], "conv_id")
    ends = prefixes.where("is_end").select(*KEY, "conv_id").unionByName(turnless)
    ends = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").mapInArrow(_listed, ENDS_SQL)
    return ends.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_digested, DIGEST_SQL)


def _nodes(prefixes: DataFrame) -> DataFrame:
    same = F.lit(True)
    for c in [*_lanes("g"), *_lanes("d")]:
        same = same & (F.min(c) == F.max(c))
    return prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        *[F.max(c).alias(c) for c in _lanes("g")], (same & (F.min("n_bytes") == F.max("n_bytes"))).alias("equal"),
    )


def prefix_trie(conversations: DataFrame, seed: int = 1) -> DataFrame:
    """The nodes of the trie of rebuilt ``conversations`` (conv_id, turn, role, text; other columns are not read).

    Turns are ordered by turn, null first; rows with equal turns by role, then by their SHA-256. Repeated rows are turns of
    their own. Null role or text is empty, rows with a null conv_id are left out. A conversation c is rebuilt from the
    first h turns of c - pmod(c, 5), as far as there are any, and its own turns after its first h; h = crc32(c) % 9. A
    conversation exists if it has a row; one that is left without turns is a member of the root alone.

    Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and
    the reference of its last turn: turn_conv_id and turn_pos (from 0), null for the root. An empty table gives no rows.
    """
    while True:
        placed, runs = _turns(conversations, seed)
        convs, prefixes = _prefixes(placed, runs, seed)
        nodes = stored(_nodes(prefixes), "nodes")
        if nodes.where("not equal").isEmpty():
            break
        dropped(placed, convs, prefixes, nodes)
        seed += 1
    spark: SparkSession = conversations.sparkSession
    weight = (F.col("n_convs") - 1) * F.col("n_bytes")
    zero = F.lit(0).cast("long")
    kids = nodes.where("depth > 1").groupBy((F.col("depth") - 1).alias("depth"), *[F.col(f"g{i}").alias(f"f{i}") for i in LANES])
    nodes = nodes.join(kids.agg(F.count("*").alias("n_children")), KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = stored(nodes.withColumn("weight", weight), "nodes")
    totals = nodes.groupBy("conv_id").agg(F.sum("weight").alias("owned"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    shares = runs.select("conv_id", "part").union(convs.where("hb > 0").select("conv_id", F.lit(-1))).join(totals, "conv_id")
    members = prefixes.select(*KEY, "conv_id", "part").join(shares, ["conv_id", "part"]).groupBy(*KEY).agg(F.sum("owned").alias("owned"), F.sum("leaves").alias("n_leaves"))

    # What the owner of a node owns above it: sums by blocks of depths, so that a long path is not one task's.
    shared = nodes.where("n_convs > 1").withColumn("block", F.floor(F.col("depth") / DEPTH_BLOCK))
    blocks = shared.groupBy("conv_id", "block").agg(F.sum("weight").alias("sum"))
    upward = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("sum").over(upward), zero).alias("before"))
    upward = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    shared = shared.withColumn("within", F.coalesce(F.sum("weight").over(upward), zero)).join(blocks, ["conv_id", "block"]).join(members, KEY)
    saved = (F.col("owned") - F.col("before") - F.col("within")).alias("saved_tokens")
    columns = [*KEY, *_lanes("g"), "conv_id", "n_convs", "n_children"]
    single = nodes.where("n_convs = 1").select(*columns, F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"))
    known = stored(shared.select(*columns, "n_leaves", saved).unionByName(single), "known")

    above = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(f"f{i}").alias(f"g{i}") for i in LANES], F.col("conv_id").alias("parent_conv_id"))
    deep = known.where("depth > 1").join(above, ["depth", *_lanes("g")])
    all_ = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).first()
    top = known.where("depth = 1").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved")).first()
    first = known.where("depth = 1").withColumn("parent_conv_id", F.lit(all_.conv_id).cast("long"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", *_lanes("f")]
    root = [(all_.conv_id, 0, None, all_.n_convs, top.n_children, top.n_leaves or 1, top.saved or 0, 0, 0, 0, 0)] if all_.n_convs else []
    root = spark.createDataFrame(root, ", ".join(f"{c} long" for c in out))
    rows = deep.select(*out).unionByName(first.select(*out)).unionByName(root)
    rows = rows.join(_ends(convs, prefixes), KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
    owner = convs.select("conv_id", "base", "h", "hb")
    in_head = F.col("depth") <= F.col("hb")
    rows = rows.join(owner, "conv_id").select(
        *out[:7], "ends_sha256", F.when(F.col("depth") > 0, F.when(in_head, F.col("base")).otherwise(F.col("conv_id"))).alias("turn_conv_id"),
        F.when(F.col("depth") > 0, F.when(in_head, F.col("depth") - 1).otherwise(F.col("depth") - 1 - F.col("hb") + F.col("h"))).alias("turn_pos"),
    )
    return rows


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations."""
    found = prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
