"""Byte-level BPE by backtracking, and decoding by an offset table.

An Aho-Corasick automaton over the reversed vocabulary finds the longest token from every place of a pre-token in one
pass. The encoder takes these longest tokens; two neighbours may only stand side by side if merging their joined bytes
gives the two again, which a table of token pairs answers. Where no token fits it goes back, and a mark on each place
that has led nowhere keeps the work linear. The result is exactly that of applying the merges in their order.

Tokens are stored as one run of bytes with their offsets; decoding gathers from it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import tokens, words
from shelfspark.llm.storage import text_batches

VOCABULARY = "byte_bpe_50k.json"
# Fixed value: the white space of the pre-tokenizer beyond the six single bytes. Texts that hold any are encoded whole.
WIDE_SPACE = r"\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Fixed value: the pre-tokenizer's pattern, with {s} for white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^{s}\p{L}\p{N}]+|[{s}]+(?![^{s}])|[{s}]+"


def _letters() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file: printable ones for themselves, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Offsets:
    """Byte strings of all ids as one run of bytes."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.counts = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.cumsum(self.counts) - self.counts

    def joined(self, ids: np.ndarray) -> bytes:
        return tokens.gathered(self.flat, self.starts[ids], self.counts[ids]).tobytes()


class Encoder:
    """A vocabulary file of byte-level BPE whose merged tokens are numbered in the order of the merges."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        byte = _letters()
        self.vocabulary = {bytes(byte[c] for c in token): i for token, i in data["model"]["vocab"].items()}
        self.special = {a["content"].encode(): a["id"] for a in data["added_tokens"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        vocab = data["model"]["vocab"]
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        if any(x[2] >= y[2] for x, y in zip(pairs, pairs[1:])):
            raise ValueError("merged tokens must be numbered in the order of the merges")
        self.merged = {(a, b): c for a, b, c in pairs}
        self.parts = {c: (a, b) for a, b, c in pairs}
        self.sizes = {i: len(t) for t, i in self.vocabulary.items()}
        self.shorter = {i: self._shorter(t) for t, i in self.vocabulary.items()}
        self.backwards = ahocorasick.Automaton()
        for token, i in self.vocabulary.items():
            self.backwards.add_word(token[::-1].decode("latin-1"), i)
        self.backwards.make_automaton()
        wide = re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), WIDE_SPACE)
        self.pattern = regex.compile(PATTERN.replace("{s}", r"\t-\r " + wide))
        self.apart = "|".join([f"[{WIDE_SPACE}]", *(re.escape(s.decode()) for s in self.special)])
        self.at_special = regex.compile("|".join(regex.escape(s.decode()) for s in self.special)) if self.special else None
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, list[int]] = {}
        strings = [b""] * (max([*self.vocabulary.values(), *self.special.values()]) + 1)
        for s, i in [*self.vocabulary.items(), *self.special.items()]:
            strings[i] = s
        self.bytes = Offsets(strings)
        self.digits = Offsets([b"%d," % i for i in range(len(strings))])

    def _shorter(self, token: bytes) -> int | None:
        return next((self.vocabulary[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.vocabulary), None)

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b in order gives a and b again.

        The two are taken apart from the last merge on. If two parts that touch could have merged before either was
        used up, they would have.
        """
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 250_000:
                self.pairs.clear()
            known = self.pairs[key] = self._fits(a, b)
        return known

    def _fits(self, a: int, b: int) -> bool:
        before = len(self.sizes) + 1
        while True:
            joined = self.merged.get((a, b))
            if joined is not None and joined < before:
                return False
            later = max(a, b)
            if later not in self.parts:
                return True
            if a > b:
                before, a = later, self.parts[later][1]
            else:
                # At equal rank the left pair merges first, so a merge of this rank counts too.
                before, b = later + 1, self.parts[later][0]

    def pretoken(self, text: bytes) -> list[int]:
        whole = self.vocabulary.get(text)
        if len(text) == 1:
            return [whole]
        longest = [0] * len(text)
        last = len(text) - 1
        sizes = self.sizes
        for end, token in self.backwards.iter(text[::-1].decode("latin-1")):
            place = last - end
            old = longest[place]
            if not old or sizes[token] > sizes[old - 1]:
                longest[place] = token + 1
        out: list[int] = []
        dead = bytearray(len(text) + 1)
        place = 0
        token = longest[0] - 1
        while True:
            previous = out[-1] if out else None
            while token is not None:
                end = place + sizes[token]
                if not dead[end] and (previous is None or self.fits(previous, token)):
                    break
                token = self.shorter[token]
            if token is None:
                dead[place] = 1
                token = out.pop()
                place -= sizes[token]
                token = self.shorter[token]
                continue
            out.append(token)
            place += sizes[token]
            if place > last:
                return out
            token = longest[place] - 1

    def plain(self, text: str) -> list[int]:
        """Ids of a text without special tokens."""
        out: list[int] = []
        for part in self.pattern.findall(text):
            ids = self.known.get(part)
            if ids is None:
                ids = self.pretoken(part.encode())
                if len(part) <= 32:
                    if len(self.known) > 200_000:
                        self.known.clear()
                    self.known[part] = ids
            out += ids
        return out

    def units(self, spelt: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special tokens, one after another, and how many each has."""
        ids = [self.plain(x.decode()) for x in spelt]
        return np.fromiter(chain.from_iterable(ids), np.int64), np.fromiter(map(len, ids), np.int64, len(ids))

    def whole(self, text: str) -> list[int]:
        """Ids of any text."""
        if not self.at_special:
            return self.plain(text)
        out, at = [], 0
        for m in self.at_special.finditer(text):
            out += self.plain(text[at : m.start()]) + [self.special[m[0].encode()]]
            at = m.end()
        return out + self.plain(text[at:])


def text_ids(column: pa.Array, encoder: Encoder, units: tokens.Units) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) of every row of a text column.

    A unit is a word with all white space before it; what white space ends a text is a unit too.
    """
    whole = pc.match_substring_regex(pc.fill_null(column.cast(pa.large_string()), ""), encoder.apart).to_pylist()
    for first, data, offsets in words.chunks(column):
        _, ends, bounds = words.spans(data, offsets)
        rows = len(offsets) - 1
        hi = np.insert(ends, bounds[1:], offsets[1:])
        lo = np.concatenate(([0], hi[:-1])) if len(hi) else hi
        hashes, checks = (words.word_hashes(data, lo, hi, seed=seed) for seed in (0, 1))
        where, counts = units.find(hashes, checks, lambda i: data[lo[i] : hi[i]].tobytes())
        ids = tokens.gathered(units.flat, where, counts)
        edges = np.concatenate(([0], np.cumsum(counts)))[bounds + np.arange(rows + 1)]
        for i in range(rows):
            if whole[first + i]:
                text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
                yield first + i, np.array(encoder.whole(text), np.int64)
            else:
                yield first + i, ids[edges[i] : edges[i + 1]]


_workers: dict[str, tuple[Encoder, tokens.Units]] = {}


def _worker(name: str) -> tuple[Encoder, tokens.Units]:
    """The encoder of this worker, with the units it has encoded."""
    if name not in _workers:
        import public_tokenizers

        encoder = Encoder(public_tokenizers.path(name))
        _workers[name] = encoder, tokens.Units(encoder.units, kind=np.uint16 if len(encoder.bytes.counts) <= 1 << 16 else np.int32)
    return _workers[name]


def _coded(name: str):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, units = _worker(name)
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            held, size = [], 0
            for row, ids in text_ids(batch.column("text"), encoder, units):
                held.append((docs[row], ids.astype(np.int32)))
                size += len(ids)
                if size > 1_000_000:
                    yield _lists(held, schema)
                    held, size = [], 0
            yield _lists(held, schema)

    return run


def _lists(held: list[tuple[int, np.ndarray]], schema: pa.Schema) -> pa.RecordBatch:
    offsets = np.concatenate(([0], np.cumsum([len(x) for _, x in held]))).astype(np.int32)
    values = np.concatenate([x for _, x in held]) if held else np.zeros(0, np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array([d for d, _ in held], pa.int64()), lists], schema=schema)


def encoded(df: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) of every row of ``df`` (doc_id, text; other columns are not read).

    Null and empty texts have no ids. A null doc_id stays null; repeated rows give repeated results.
    """
    rows = text_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_coded(vocabulary), "doc_id long, ids array<int>")


def _decoded(name: str, digest: bool):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
        if digest
        else [("doc_id", pa.int64()), ("text", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _worker(name)
        for batch in batches:
            lists = pc.fill_null(batch.column("ids"), [])
            out: list[list] = [[] for _ in schema]
            for doc, scalar in zip(batch.column("doc_id").to_pylist(), lists):
                ids = scalar.values.to_numpy(zero_copy_only=False).astype(np.int64)
                # As the library does, bytes that are no UTF-8 become replacement characters.
                text = encoder.bytes.joined(ids).decode("utf-8", "replace")
                if digest:
                    listed = encoder.digits.joined(ids)[:-1]
                    row = [doc, len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()]
                else:
                    row = [doc, text]
                for column, x in zip(out, row):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return run


def decoded(ids: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) of ``ids`` (doc_id, ids). Null ids count as none."""
    return ids.select("doc_id", "ids").mapInArrow(_decoded(vocabulary, False), "doc_id long, text string")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again, as counts and digests."""
    ids = encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return ids.mapInArrow(_decoded(VOCABULARY, True), schema)
