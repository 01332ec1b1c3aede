"""Embedding near-dedup with binary codes of randomly rotated vectors.

A unit vector is rotated at random into ``bits`` dimensions; its code is the signs there, its correction factor the inner
product of the vector and its code. For a code c of o with factor f and a rotated query q, <c, q> / f estimates <o, q>
without bias, and misses it by more than ``confidence * sqrt((1 - f**2) / f**2 / (bits - 1))`` with a probability of at
most about 2 * exp(-confidence**2 / 2), 3e-8 here. Pairs whose upper bound stays below the threshold are done; all
others are computed exactly, in double precision, so no pair below the threshold is linked.

Equal vectors of a label form a class first. The classes of a label are dealt to blocks of bounded size, and each pair
of blocks is one small group: a large label becomes many groups. A group gives counts and a spanning set of links for
its rows, never its pairs. The comparisons in a label still grow with the square of its distinct vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm.components import components
from shelfspark.llm.storage import stored


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.93
    bits: int = 256
    confidence: float = 6.0
    block_rows: int = 1024
    seed: int = 11


_rotations: dict[tuple[int, int, int], np.ndarray] = {}


def rotation(size: int, how: Settings) -> np.ndarray:
    """Orthonormal columns: a (bits, size) matrix that keeps lengths."""
    bits = max(how.bits, -(-size // 64) * 64)
    key = size, bits, how.seed
    if key not in _rotations:
        gauss = np.random.default_rng([how.seed, size]).standard_normal((bits, size))
        q, r = np.linalg.qr(gauss)
        _rotations[key] = q * np.sign(np.diag(r))
    return _rotations[key]


def coded(unit: np.ndarray, how: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and correction factors of unit vectors."""
    turned = unit @ rotation(unit.shape[1], how).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])


def estimated(codes: np.ndarray, factors: np.ndarray, queries: np.ndarray, how: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of the inner products (codes by queries) and their half-widths, one a code."""
    turned = (queries @ rotation(queries.shape[1], how).T).astype(np.float32)
    bits = turned.shape[1]
    signs = np.unpackbits(codes, axis=1, count=bits).astype(np.float32) * 2 - 1
    with np.errstate(divide="ignore", invalid="ignore"):
        values = signs @ turned.T / np.sqrt(bits) / factors[:, None]
        width = how.confidence * np.sqrt(np.maximum(1 - factors**2, 0) / factors**2 / (bits - 1))
    return values, width


def linked(left: np.ndarray, right: np.ndarray, how: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``left`` and ``right`` (doubles) whose cosine reaches the threshold."""
    left_norm, right_norm = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
    codes, factors = coded(left / left_norm[:, None], how)
    values, width = estimated(codes, factors, right / right_norm[:, None], how)
    i, j = np.nonzero(~(values + width[:, None] < how.threshold))
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 50_000):
        part = slice(at, at + 50_000)
        dots = np.einsum("ij,ij->i", left[i[part]], right[j[part]])
        keep[part] = dots / (left_norm[i[part]] * right_norm[j[part]]) >= how.threshold
    return i[keep], j[keep]


def spanning(u: np.ndarray, v: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` rows the least row that the links (u, v) reach."""
    label = np.arange(count)
    while True:
        before = label.copy()
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if (label == before).all():
            return label


GROUP = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("least", pa.int64())])
GROUP_SQL = "node long, links long, least long"


def _compared(how: Settings):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        second = table.column("second").to_numpy(zero_copy_only=False).astype(bool)
        order = np.argsort(nodes, kind="stable")
        nodes, copies, second = nodes[order], copies[order], second[order]
        flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vectors = flat.astype(np.float64).reshape(len(nodes), -1)[order]
        if second.any():
            a, b = np.flatnonzero(~second), np.flatnonzero(second)
            i, j = linked(vectors[a], vectors[b], how)
            u, v = a[i], b[j]
        else:
            u, v = linked(vectors, vectors, how)
            u, v = u[u < v], v[u < v]
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, u, copies[v])
        np.add.at(links, v, copies[u])
        least = spanning(u, v, len(nodes))
        some = links > 0
        return pa.table([pa.array(nodes[some]), pa.array(links[some]), pa.array(nodes[least][some])], schema=GROUP)

    return run


def near_vectors(df: DataFrame, how: Settings = Settings()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``df`` (vec_id, embedding, label; others are not read).

    Vectors link within their label, if they have the same length. A null label, a null or empty vector, a zero vector
    and one with a null or non-finite component link with nothing: no links, their own component, kept. A null vec_id
    takes no part: no links, a null component, not kept. Equal vectors are links too; repeated rows count as vectors.
    """
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & some, F.lit(False))
    valid = rows.where(usable)
    classes = valid.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("size", F.size("embedding")), "vector-classes")
    blocks = classes.groupBy("label", "size").agg(F.ceil(F.count("*") / how.block_rows).cast("int").alias("blocks"))
    dealt = classes.join(blocks, ["label", "size"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "label", "size", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "copies", "embedding",
        (F.col("block") > F.col("other")).alias("second"),
    )
    found = stored(dealt.groupBy("label", "size", "i", "j").applyInArrow(_compared(how), GROUP_SQL), "vector-links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("u"), F.col("least").alias("v")))
    placed = classes.join(links, "node", "left").join(joined, "node", "left")
    placed = placed.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    # A class may hold a third of all rows; adaptive execution splits that key of the join.
    inside = valid.join(placed, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    outside = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return inside.union(outside).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, cosine 0.93 within a label."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP10_SQL = """
WITH RECURSIVE finite AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), usable AS (
  SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM finite WHERE len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings UNION SELECT v, root FROM reach JOIN links ON node = u
), roots AS (
  SELECT node, min(root) AS root FROM reach GROUP BY node
), degrees AS (
  SELECT u, count(*) AS n FROM links GROUP BY u
)
SELECT vec_id, coalesce(n, 0) AS n_links, root AS component_id, vec_id = root AS kept
FROM embeddings JOIN roots ON node = vec_id LEFT JOIN degrees ON u = vec_id
"""
