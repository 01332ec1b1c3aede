import hashlib
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfspark.llm import bpe


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def ids_of(texts):
    encoder, units = bpe._worker(bpe.VOCABULARY)
    return [x.tolist() for _, x in bpe.text_ids(pa.array(texts, pa.string()), encoder, units)]


def test_like_the_library(tokenizer):
    rng = random.Random(1)
    letters = " \n\t  ab c'sdTHEtheing123.,!?éßñ漢字 　\x1c\x85🙂aaa  \r\n<|endoftext|>'ll're"
    texts = ["", None, " ", "  ", "a  b", "\n\n x", "<|endoftext|>", "a <|endoftext|> b", "a" * 1000, "   z", "́a"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice("abcdefghij etaoinshrdlu") for _ in range(rng.randint(0, 200))) for _ in range(1000)]
    wanted = [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert ids_of(texts) == wanted


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    global _library
    if "_library" not in globals():
        _library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    assert ids_of([text]) == [_library.encode(text, add_special_tokens=False).ids]


def test_units_lose_their_places(tokenizer):
    encoder, _ = bpe._worker(bpe.VOCABULARY)
    from shelfspark.llm.tokens import Units

    units = Units(encoder.units, bits=1)
    texts = ["one two three four", "five six seven eight nine ten", "one two"]
    got = [x.tolist() for t in texts for _, x in bpe.text_ids(pa.array([t]), encoder, units)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_round_trip_of_odd_rows(odd, tokenizer):
    texts = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=repr)
    ids = bpe.encoded(odd)
    assert sorted(((r.doc_id, r.ids) for r in ids.collect()), key=repr) == sorted(((d, tokenizer.encode(t, add_special_tokens=False).ids) for d, t in texts), key=repr)
    assert sorted(((r.doc_id, r.text) for r in bpe.decoded(ids).collect()), key=repr) == texts


def test_digests(spark, tmp_path, odd, tokenizer):
    odd.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    for r in bpe.op5_bpe(spark, str(tmp_path)).where("doc_id in (1, 3, 14)").collect():
        ids = tokenizer.encode(odd.where(f"doc_id = {r.doc_id}").first().text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty(empty):
    assert bpe.decoded(bpe.encoded(empty)).count() == 0
