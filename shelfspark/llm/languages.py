"""Language identification by Bayesian evidence fusion.

log posterior = tempered log likelihood of the text + log P(declared | language) + log prior of the host.

- Text: a multinomial model of hashed byte trigrams per language, and one of no language at all (all trigrams alike).
  Trigrams of a text depend on each other, so a text counts as ``effective`` trigrams at most.
- Declared: how often rows whose text clearly is of a language declare each language, counted over all rows.
- Host: counts of clear rows per host, smoothed towards those of its address suffix, these towards all rows. A new or
  small host so takes its suffix's shares, a large one its own. All counts come from one grouped aggregation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import markup, words
from shelfspark.llm.storage import stored, text_batches

BUCKET_BITS = 14
EMPTY = 1 << BUCKET_BITS
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    languages: tuple[str, ...] = ("de", "en", "es", "fr")
    train_rows: int = 4000
    effective: float = 40.0
    mixed_in: float = 0.02
    prior_rows: float = 50.0
    clear: float = 0.95
    accept: float = 0.5


@dataclass(frozen=True)
class TextModel:
    """Log probabilities of trigram buckets, a row a language and a last one for no language."""

    table: np.ndarray


_LETTER = np.zeros(256, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def buckets(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The trigram bucket that begins at each byte; EMPTY where the trigram has no letter or leaves its row."""
    letters = _LETTER[data].astype(np.uint32)
    out = np.full(len(data), EMPTY, np.int64)
    if len(data) > 2:
        a, b, c = letters[:-2], letters[1:-1], letters[2:]
        code = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77)) ^ (c * np.uint32(0xC2B2AE3D))
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out[:-2] = np.where((a | b | c) > 0, (code >> np.uint32(32 - BUCKET_BITS)).astype(np.int64), EMPTY)
    for back in (1, 2):
        edge = offsets[1:] - back
        out[edge[edge >= offsets[:-1]]] = EMPTY
    return out


def _counted(n_languages: int):
    schema = pa.schema([("language", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((n_languages, EMPTY + 1), np.int64)
        for batch in batches:
            languages = batch.column("language").to_pylist()
            for first, data, offsets in words.chunks(batch.column("text")):
                found = buckets(data, offsets)
                for i in range(len(offsets) - 1):
                    counts[languages[first + i]] += np.bincount(found[offsets[i] : offsets[i + 1]], minlength=EMPTY + 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(n_languages), pa.int32()), pa.array([c.tobytes() for c in counts], pa.binary())], schema=schema)

    return run


def fitted(df: DataFrame, how: Settings = Settings()) -> TextModel:
    """A text model from at most ``how.train_rows`` rows of ``df`` (doc_id, text, declared) of declared language.

    The rows with the least hashes of doc_id are taken, as many of each language; only their ids are sent around.
    """
    df = text_batches(df).select("doc_id", F.col("text").cast("string").alias("text"), F.col("declared").cast("string").alias("declared"))
    known = df.where(F.col("declared").isin(*how.languages) & F.col("doc_id").isNotNull())
    each = how.train_rows // len(how.languages)
    ids = None
    for i, language in enumerate(how.languages):
        part = known.where(F.col("declared") == language).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(each)
        part = part.select("doc_id", F.lit(i).alias("language"))
        ids = part if ids is None else ids.union(part)
    sample = known.join(F.broadcast(ids), "doc_id").select("language", "text").coalesce(16)
    n = len(how.languages)
    counts = np.zeros((n, EMPTY + 1), np.int64)
    for r in sample.mapInArrow(_counted(n), "language int, counts binary").collect():
        counts[r.language] += np.frombuffer(r.counts, np.int64)
    shares = counts[:, :EMPTY] + 0.01
    shares = shares / shares.sum(axis=1, keepdims=True)
    shares = (1 - how.mixed_in) * shares + how.mixed_in / EMPTY
    table = np.zeros((n + 1, EMPTY + 1), np.float32)
    table[:n, :EMPTY] = np.log(shares)
    table[n, :EMPTY] = -np.log(EMPTY)
    return TextModel(table)


def likelihoods(texts: pa.Array, model: TextModel, effective: float) -> np.ndarray:
    """Tempered log likelihoods, a row a text."""
    out = np.zeros((len(texts), len(model.table)))
    for first, data, offsets in words.chunks(texts):
        found = buckets(data, offsets)
        n = np.diff(np.concatenate(([0], np.cumsum(found != EMPTY)))[offsets])
        tempering = np.minimum(1.0, effective / np.maximum(n, 1))
        full = np.flatnonzero(np.diff(offsets))
        for k, row in enumerate(model.table):
            sums = np.zeros(len(n))
            if len(full):
                sums[full] = np.add.reduceat(row[found].astype(np.float64), offsets[:-1][full])
            out[first : first + len(n), k] = sums * tempering
    return out


def _text_evidence(spark: SparkSession, model: TextModel, effective: float):
    shared = spark.sparkContext.broadcast(model)

    def column(texts: pa.Array) -> pa.Array:
        rows = likelihoods(texts, shared.value, effective)
        ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
        return pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))

    return F.arrow_udf(column, "array<double>")


def address_parts(address: Column) -> tuple[Column, Column]:
    """Host and suffix of a URL or a bare host; the suffix of a host without dots is empty."""
    host = F.lower(F.regexp_replace(F.regexp_extract(F.coalesce(address.cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)", 1), r"^.*@|:\d*$", ""))
    return host, F.regexp_extract(host, r"\.([^.]+)$", 1)


def _shares(counts: list[Column], toward: list[Column], rows: float) -> list[Column]:
    total = sum(counts[1:], counts[0])
    return [(c + t * rows) / (total + rows) for c, t in zip(counts, toward)]


def _argmax(values: Column, best: Column) -> Column:
    return F.array_position(values, best).cast("int") - 1


def identified(df: DataFrame, model: TextModel, how: Settings = Settings()) -> DataFrame:
    """``df`` (text, declared, address and others) with language, probability and accepted.

    A row is accepted if its best language reaches ``how.accept`` and its text has a trigram with a letter. Texts without
    any, empty and null ones are of language ``und`` with probability 0. Null or unknown declarations and null addresses count as no
    evidence. Columns of these three names are replaced; all others stay.
    """
    spark = df.sparkSession
    n = len(how.languages)
    names = [c for c in df.columns if c not in ("language", "probability", "accepted")]
    host, suffix = address_parts(F.col("address"))
    rows = text_batches(df).select(*names, host.alias("__host"), suffix.alias("__suffix"), _text_evidence(spark, model, how.effective)(F.col("text").cast("string")).alias("__text"))

    # Counts of clear rows, per host and declared language.
    best = F.array_max("__text")
    clear = F.aggregate("__text", F.lit(0.0), lambda s, x: s + F.exp(x - best)) <= 1 / how.clear
    seen = rows.select("__host", "__suffix", F.coalesce(F.col("declared").cast("string"), F.lit("")).alias("__declared"), "__text").where(clear)
    seen = seen.withColumn("__top", _argmax(F.col("__text"), best)).where(F.col("__top") < n)
    per = seen.groupBy("__host", "__suffix", "__declared", "__top").agg(F.count("*").alias("n"))
    per = stored(per, "language-counts")
    table = np.zeros((n, n))  # language of the text, declared language
    for r in per.where(F.col("__declared").isin(*how.languages)).groupBy("__top", "__declared").agg(F.sum("n").alias("n")).collect():
        table[r["__top"], how.languages.index(r["__declared"])] = r.n
    said = (table + 1.0) / (table.sum(axis=1, keepdims=True) + n)

    def counted(by: list[str], label: str) -> DataFrame:
        sums = [F.sum(F.when(F.col("__top") == i, F.col("n")).otherwise(0)).cast("double").alias(f"__{label}{i}") for i in range(n)]
        return per.groupBy(*by).agg(*sums)

    every = counted([], "all").collect()[0]
    uniform = [F.lit(((every[i] or 0.0) + 1.0) / (sum(x or 0.0 for x in every) + n)) for i in range(n)]
    suffixes = counted(["__suffix"], "suffix")
    hosts = counted(["__host", "__suffix"], "host").join(suffixes, "__suffix")
    of_suffix = _shares([F.col(f"__suffix{i}") for i in range(n)], uniform, how.prior_rows)
    of_host = _shares([F.col(f"__host{i}") for i in range(n)], of_suffix, how.prior_rows)
    priors = hosts.select("__host", F.array(*[F.log(x) for x in of_host]).alias("__host_prior"))
    priors = stored(priors, "host-priors")
    fallback = suffixes.select("__suffix", F.array(*[F.log(x) for x in of_suffix]).alias("__suffix_prior"))
    fallback = stored(fallback, "suffix-priors")

    joined = rows.join(priors, "__host", "left").join(fallback, "__suffix", "left")
    prior = F.coalesce("__host_prior", "__suffix_prior", F.array(*[F.log(x) for x in uniform]))
    declared = F.array(*[F.lit(0.0)] * n)
    for j, language in enumerate(how.languages):
        declared = F.when(F.col("declared") == language, F.array(*[F.lit(float(np.log(said[i, j]))) for i in range(n)])).otherwise(declared)
    # "No language" has the prior of a rare one and says nothing about declarations.
    evidence = F.zip_with(F.col("__text"), F.zip_with(prior, declared, lambda x, y: x + y), lambda t, x: t + F.coalesce(x, F.lit(float(np.log(0.001)))))
    fused = joined.withColumn("__fused", evidence)
    top = F.array_max("__fused")
    total = F.aggregate("__fused", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    place = _argmax(F.col("__fused"), top)
    letters = F.element_at("__text", n + 1) < 0
    known = letters & (place < n)
    language = F.when(known, F.element_at(F.array(*map(F.lit, how.languages)), F.least(place, F.lit(n - 1)) + 1)).otherwise(UNKNOWN)
    probability = F.when(known, 1 / total).otherwise(0.0)
    return fused.select(*names, language.alias("language"), probability.alias("probability"), (known & (1 / total >= how.accept)).alias("accepted"))


def _markup(pages: pa.Array) -> pa.Array:
    found = [(markup.bare_text(p), markup.facts(p)["lang"]) for p in (x or "" for x in pages.to_pylist())]
    declared = [re.match("[a-z]*", (lang or "").lower())[0] for _, lang in found]
    return pa.StructArray.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array(declared, pa.string())], names=["text", "declared"])


def page_evidence(pages: DataFrame) -> DataFrame:
    """Rows for ``identified`` from web pages (page_id, url, html): text without markup, declared language, address."""
    own = F.arrow_udf(_markup, "struct<text: string, declared: string>")(F.col("html").cast("string"))
    return text_batches(pages).select(F.col("page_id").alias("doc_id"), own.alias("own"), F.col("url").alias("address")).select("doc_id", "own.text", "own.declared", "address")


def document_evidence(documents: DataFrame) -> DataFrame:
    """``documents`` with lang as the declared language and source as the host."""
    return documents.withColumns({"declared": F.col("lang"), "address": F.col("source")})


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language, its probability and acceptance of all documents."""
    rows = document_evidence(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source"))
    return identified(rows, fitted(rows)).select("doc_id", "language", "probability", "accepted")


def op3_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language, its probability and acceptance of all pages, from their text, declared markup language and address."""
    rows = page_evidence(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return identified(rows, fitted(rows)).select(F.col("doc_id").alias("page_id"), "language", "probability", "accepted")
