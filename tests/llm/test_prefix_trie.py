import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from shelfspark.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, part int"
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def rebuilt(rows):
    """The turns (role, text) of every rebuilt conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", digest(role or "", text or ""), text or ""))
    own = {c: [(role, text) for _, role, _, text in sorted(t)] for c, t in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def brute(rows):
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        yield node
        for child in children[node]:
            yield from below(child)

    out = []
    for node, own in members.items():
        under = list(below(node))
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x)
        parent = min(members[node[:-1]]) if node else None
        ids = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(own), len(node), parent, len(own), len(children[node]), sum(not children[x] for x in under), saved, ids))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=repr)


def odd_rows():
    rng = random.Random(5)
    texts = ["", None, "a", "é漢", "hello", "x" * 50_000, "b"]
    rows = []
    for c in list(range(0, 60)) + [-3, -5, 1000, 1001, 7777]:
        for t in range(rng.randint(1, 12)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(texts[:3 if c % 2 else 7])))
    rows += rows[5:20]  # repeated rows
    rows += [(None, 0, "user", "nobody's"), (None, None, None, None), (2005, None, None, None)]
    for c in (80, 81, 82, 85, 90, 91):  # copies, long enough for their bases to differ
        rows += [(c, t, "user", f"turn {t % 4}") for t in range(20)]
    return rows


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(parts)


def test_against_brute_force(spark):
    rows = odd_rows()
    df = trie.prefix_trie(frame(spark, rows))
    assert got(df) == brute(rows)
    for r in df.collect():  # every node's stored reference is a turn of that conversation
        assert (r.turn_conv_id is None) == (r.depth == 0)


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    # Two long copies that share no base and one longer one, cut into many tasks and depth blocks.
    monkeypatch.setattr(trie, "DEPTH_BLOCK", 16)
    rows = [(c, t, "user", f"t{t % 7}{'!' * (t % 3)}") for c in (10, 20, 35) for t in range(300 if c < 35 else 420)] + odd_rows()[:50]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert got(trie.prefix_trie(frame(spark, rows, 7))) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_other_bases_after_a_collision(spark, monkeypatch):
    # With primes this small, fingerprints collide; verification must notice it and the larger ones then serve.
    calls = []
    real = trie._turns

    def spoilt(conversations, seed):
        calls.append(seed)
        placed, runs = real(conversations, seed)
        if len(calls) == 1:
            placed = placed.withColumns({f"q{i}": placed[f"q{i}"] % 3 for i in trie.LANES}).withColumns({f"p{i}": placed[f"p{i}"] % 3 for i in trie.LANES})
        return placed, runs

    monkeypatch.setattr(trie, "_turns", spoilt)
    rows = odd_rows()
    assert got(trie.prefix_trie(frame(spark, rows))) == brute(rows) and calls == [1, 2]


def test_empty_and_turnless(spark):
    assert trie.prefix_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0
    rows = [(c, 0, "user", "x") for c in range(101, 160) if c % 5]  # bases are absent, so most keep no turn
    assert got(trie.prefix_trie(frame(spark, rows))) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_powers(n):
    for base, prime in zip(trie.bases(3), trie.PRIMES):
        assert trie._powers(base, prime, n).tolist() == [pow(base, k, prime) for k in range(n)]


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(trie.op11_prefix_trie(spark, "/root/testdata/sf0.01")) == brute(rows)
