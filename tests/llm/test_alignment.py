import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfspark.llm import alignment, queries
from shelfspark.llm.bpe import _letters

FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
TEXTS = [
    "Hello  world, it's 2024!\n\n\tx",
    " leading and trailing ",
    "",
    None,
    " ",
    "\r\n\x00);\r z",
    "漢字 🙂 ñandú nbsp  　ﬁ é",
    "<s> </s> <|endoftext|> <unk> <0x41>",
    "holds ▁ itself",
    "one two three four " * 700,
    "Hello  world, it's 2024!\n\n\tx",
    "x" * 5000 + " and " + "yz" * 3000,
    "pneumonoultramicroscopicsilicovolcanoconiosis antidisestablishmentarianism",
    "Étion dans, çouelle un éonierç le ch trement",
]


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def spelt(text, a, b):
    """(id, bytes) of both sides."""
    byte = _letters()
    one = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    two = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        two.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    return one, two


def brute(rows, libraries):
    docs = []
    for doc, text in rows:
        groups = []
        if text:
            one, two = spelt(text, *libraries)
            whole = (" " + text).encode()
            if b"".join(x for _, x in one) == whole == b"".join(x for _, x in two):
                ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (one, two)]
                cuts = sorted(ends[0] & ends[1])
                groups = [([], []) for _ in cuts]
                for side, tokens in enumerate((one, two)):
                    at = 0
                    for i, x in tokens:
                        at += len(x)
                        groups[next(k for k, c in enumerate(cuts) if c >= at)][side].append(i)
        docs.append((doc, groups))
    held = Counter(p for _, groups in docs for p in {(x, y) for a, b in groups for x in a for y in b})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for doc, groups in docs:
        links = [(x, y) for a, b in groups for x in a for y in b]
        listed = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(listed.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr), held, most


def check(df, rows, libraries):
    docs, pairs = alignment.alignments(df)
    wanted, held, most = brute(rows, libraries)
    assert sorted((tuple(r[f] for f in FIELDS) for r in docs.collect()), key=repr) == wanted
    n_b = libraries[1].vocab_size()
    assert {(r.a_id, r.b_id): (r.n, r.best) for r in pairs.collect()} == {p: (n, int(n == most[p[0]])) for p, n in held.items()}
    assert all(y < n_b for _, y in held)


def test_against_brute_force(spark, libraries):
    rows = [(i % 11 if i != 4 else None, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_a int, block string").repartition(3)
    check(df, rows, libraries)


def test_small_blocks_and_parts(spark, libraries, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS * 2) if t is None or len(t) < 5000]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for name, value in (("BLOCK_PAIRS", 20), ("BATCH_BYTES", 40), ("EXPANDED", 1)):
        monkeypatch.setattr(alignment, name, value)
    pair = alignment.worker((alignment.BYTE_LEVEL, alignment.PIECES))
    parts = [x for lo, hi in alignment._parts([t for _, t in rows]) for x in alignment.aligned([t for _, t in rows][lo:hi], pair)]
    monkeypatch.undo()
    assert [x[:5] for x in parts] == [x[:5] for x in alignment.aligned([t for _, t in rows], pair)]
    assert all(np.array_equal(x[5], y[5]) and np.array_equal(x[6], y[6]) for x, y in zip(parts, alignment.aligned([t for _, t in rows], pair)))
    check(df, rows, libraries)


def test_a_group_beyond_the_bound(monkeypatch):
    monkeypatch.setattr(alignment, "EXPANDED", 5)
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 4, 9), rng.integers(0, 3, 7)
    ga, gb = np.array([0, 0, 1, 1, 1, 1, 1, 2, 2]), np.array([0, 1, 1, 1, 1, 1, 2])
    doc = np.array([0, 0, 1])
    keys, links = alignment._summed(list(alignment.linked_pairs(ga, a, gb, b, doc, 3)))
    wanted = Counter((int(doc[g]) << 32) | int(x * 3 + y) for g, x in zip(ga, a) for h, y in zip(gb, b) if g == h)
    assert dict(zip(keys.tolist(), links.tolist())) == wanted


def test_odd_rows_and_empty_tables(odd, empty, libraries):
    rows = [(r.doc_id, r.text if len(r.text or "") < 20_000 else None) for r in odd.collect()]
    df = odd.sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(df, rows, libraries)
    docs, pairs = alignment.alignments(empty)
    assert docs.count() == 0 and pairs.count() == 0
    long = [r.text for r in odd.collect() if len(r.text or "") > 20_000][:1]
    got = alignment.aligned(long, alignment.worker((alignment.BYTE_LEVEL, alignment.PIECES)))[0]
    assert got[:2] == tuple(len(side) for side in spelt(long[0], *libraries))


def test_given_table(spark, libraries):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.001").collect()
    wanted = brute(rows, libraries)[0]
    assert sorted((tuple(r[f] for f in FIELDS) for r in got), key=repr) == wanted
