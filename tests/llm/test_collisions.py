"""Two plain words that every polynomial hash modulo 2**64 takes for one."""

import hashlib

import pytest

import brute
from shelfspark.llm import bpe, ngram_join, packing, repeats
from shelfspark.llm.ngram_join import Similarity

SWAP = str.maketrans("ab", "ba")


def pair(length=1024):
    word = "a"
    while len(word) < length:
        word += word.translate(SWAP)
    return word, word.translate(SWAP)


@pytest.fixture
def docs(spark):
    one, other = pair()
    filler = " ".join(f"w{i}" for i in range(12))
    return spark.createDataFrame([(1, f"{one} {filler}"), (2, f"{other} {filler}"), (3, one), (4, other)], "doc_id long, text string").coalesce(1)


def test_ids(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = {r.doc_id: r.text for r in docs.collect()}
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    for r in bpe.encoded(docs).collect():
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids
    library = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    for r in packing.pieces(docs, with_ids=True).collect():
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids + [packing.END]


def test_sets(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(map(tuple, ngram_join.near_duplicates(docs, Similarity(4, 85)).collect()))
    assert got == brute.near_duplicates(rows, 4, 85)
    assert {r[2] for r in got} == {1, 2, 3, 4}


def test_passages(docs):
    assert {r.n_removed for r in repeats.without_repeats(docs).collect()} == {0}


def test_units_that_share_a_place(spark):
    # Far more units than places: those that lose theirs are encoded again.
    import numpy as np

    from shelfspark.llm import tokens, words

    units = tokens.Units(lambda spelt: (np.concatenate([np.frombuffer(x, np.uint8).astype(np.int64) for x in spelt]), np.array([len(x) for x in spelt])), bits=4)
    import pyarrow as pa

    texts = [" ".join(hashlib.sha256(b"%d" % (i % 97)).hexdigest()[: i % 60 + 1] for i in range(k, k + 300)) for k in range(0, 900, 150)]
    for row, ids in tokens.word_ids(pa.array(texts), units):
        assert bytes(ids.tolist()).decode() == texts[row].replace(" ", "")
