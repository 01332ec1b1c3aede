"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a linear function of its features; of a pair, the better one is preferred with the logistic
probability of the difference of strengths. Weights minimise the logistic loss over preference pairs of a document
labelled 1 and one labelled 0, on their feature differences, with a ridge penalty, by Newton steps.

All labelled rows are learned from. They are dealt to blocks of about ``block_rows``, and a block gives all pairs of its
rows; up to ``block_rows`` rows give all pairs there are. Rows of a rare label go to as many blocks as it takes for each
to have some. A step is one job that sums gradients and curvatures over the blocks: what comes to the driver is one row a
task, whatever the number of rows.

The cut is an exact quantile: strengths below the share of zeros among the training rows are predicted 0. A score is the
logistic of the strength around the cut, shifted so that the cut itself scores ``at_cut``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import textstats
from shelfspark.llm.storage import dropped, stored, text_batches
from shelfspark.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Settings:
    block_rows: int = 1_000
    least_of_kind: int = 16
    ridge: float = 1e-3
    steps: int = 25
    at_cut: float = 0.7
    seed: int = 5


@dataclass(frozen=True)
class Ranking:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    spread: float
    at_cut: float = 0.7


_ROOTS = [textstats.SHAPES.index(x) for x in ("symbols", "dup_lines", "repeats", "upper", "digits", "marks", "bars")]


def features(shapes: np.ndarray) -> np.ndarray:
    """Shapes, their squares, and roots of shares: a little of a rare thing tells much."""
    return np.hstack([shapes, shapes**2, np.sqrt(np.maximum(shapes[:, _ROOTS], 0))])


def strengths(model: Ranking, shapes: np.ndarray) -> np.ndarray:
    if not len(shapes):
        return np.zeros(0)
    # Standardised features are held within what training rows show, so that no odd text runs off.
    return _standard(model, shapes) @ model.weights


def scored(model: Ranking, strength: np.ndarray) -> np.ndarray:
    shift = np.log(model.at_cut / (1 - model.at_cut))
    return 1 / (1 + np.exp(-np.clip((strength - model.cut) / model.spread + shift, -40, 40)))


def _standard(model: Ranking, shapes: np.ndarray) -> np.ndarray:
    return np.clip((features(shapes) - model.center) / model.scale, -8, 8)


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _summed(df: DataFrame, sums: Callable[[pa.RecordBatch], np.ndarray]) -> list[np.ndarray]:
    """One array of sums for each batch of rows, in an order that does not change."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([sums(batch).tolist()], pa.list_(pa.float64()))], names=["sums"])

    return [np.array(r.sums) for r in df.mapInArrow(task, "sums array<double>").collect()]


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of all features over all rows, merged from those of batches."""
    def of_batch(batch: pa.RecordBatch) -> np.ndarray:
        x = features(_matrix(batch.column("shapes"), len(textstats.SHAPES)))
        return np.concatenate(([len(x)], x.mean(axis=0), ((x - x.mean(axis=0)) ** 2).sum(axis=0)))

    n, center, spread = 0.0, 0.0, 0.0
    for part in _summed(rows.select("shapes"), of_batch):
        k, mean, squares = part[0], *np.split(part[1:], 2)
        gap = mean - center
        center, spread, n = center + gap * k / (n + k), spread + squares + gap**2 * n * k / (n + k), n + k
    scale = np.sqrt(spread / n)
    scale[scale < 1e-12] = 1.0
    return center, scale


def blocks(rows: DataFrame, good: int, bad: int, how: Settings) -> DataFrame:
    """(plus, minus): the shapes of a block's rows of either label. Every row is in a block, those of a rare label in several."""
    n = -(-(good + bad) // how.block_rows)

    def dealt(quality: int, size: int) -> DataFrame:
        copies = min(n, -(-how.least_of_kind * n // size))
        place = F.explode(F.transform(F.sequence(F.lit(0), F.lit(copies - 1)), lambda k: F.pmod(F.xxhash64("doc_id", F.lit(how.seed)) + k, F.lit(n))))
        return rows.where(F.col("quality") == quality).select("doc_id", "quality", "shapes", place.alias("block"))

    def of_kind(quality: int, name: str) -> Column:
        found = F.sort_array(F.collect_list(F.when(F.col("quality") == quality, F.struct("doc_id", "shapes"))))
        return F.flatten(F.transform(found, lambda x: x["shapes"])).alias(name)

    return dealt(1, good).unionByName(dealt(0, bad)).groupBy("block").agg(of_kind(1, "plus"), of_kind(0, "minus")).select("plus", "minus")


def _steepness(model: Ranking) -> Callable[[pa.RecordBatch], np.ndarray]:
    """Pairs, gradient and curvature of the loss, summed over all pairs of each block."""
    def of_batch(batch: pa.RecordBatch) -> np.ndarray:
        width = len(model.weights)
        total = np.zeros(1 + width + width**2)
        for plus, minus in zip(batch.column("plus"), batch.column("minus")):
            a, b = (_standard(model, np.asarray(x.values, float).reshape(-1, len(textstats.SHAPES))) for x in (plus, minus))
            # How likely the worse one of a pair is preferred.
            p = 1 / (1 + np.exp(np.clip((a @ model.weights)[:, None] - b @ model.weights, -700, 700)))
            w = p * (1 - p)
            mixed = a.T @ w @ b
            curve = (a.T * w.sum(axis=1)) @ a + (b.T * w.sum(axis=0)) @ b - mixed - mixed.T
            total += np.concatenate(([p.size], p.sum(axis=0) @ b - p.sum(axis=1) @ a, curve.ravel()))
        return total

    return of_batch


def _strength_of(model: Ranking) -> Column:
    def column(shapes: pa.Array) -> pa.Array:
        return pa.array(strengths(model, _matrix(shapes, len(textstats.SHAPES))))

    return F.arrow_udf(column, "double")("shapes")


def fitted(documents: DataFrame, labels: DataFrame, where: Column | None = None, how: Settings = Settings()) -> Ranking:
    """A ranking from all labelled documents that pass ``where``. With labels of one kind only all scores are alike."""
    width = 2 * len(textstats.SHAPES) + len(_ROOTS)
    rows = stored(textstats.labelled_shapes(documents, labels, where).select("doc_id", "quality", "shapes"), "ranked-shapes")
    sizes = {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    good, bad = sizes.get(1, 0), sizes.get(0, 0)
    center, scale = moments(rows) if good + bad else (np.zeros(width), np.ones(width))
    model = Ranking(center, scale, np.zeros(width), 0.0, 1.0, how.at_cut)
    if not good or not bad:
        dropped(rows)
        # All documents score high if all that is known are good ones, low otherwise.
        return replace(model, cut=0.0 if good else 1.0)
    pairs = stored(blocks(rows, good, bad, how), "ranked-pairs")
    for _ in range(how.steps):
        n, rest = np.split(np.sum(_summed(pairs, _steepness(model)), axis=0), [1])
        gradient, curve = rest[:width] / n + how.ridge * model.weights, rest[width:].reshape(width, width) / n + how.ridge * np.eye(width)
        step = np.linalg.solve(curve, gradient)
        model = replace(model, weights=model.weights - step)
        if np.abs(step).max() < 1e-8:
            break
    found = stored(rows.select(_strength_of(model).alias("strength")), "strengths")
    cut = exact_quantiles(found, [], ["strength"], {"cut": bad / (good + bad)}).first()["cut"]
    spread = found.agg(F.stddev_pop("strength")).first()[0]
    dropped(rows, pairs, found)
    return replace(model, cut=cut, spread=max(spread / 2, 1e-9))


def ranked(df: DataFrame, model: Ranking) -> DataFrame:
    """``df`` with score (0 to 1) and predicted (1 from ``model.at_cut`` on). Null and empty texts are scored as empty.

    Columns of these names are replaced; all others stay.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def column(texts: pa.Array) -> pa.Array:
        return pa.array(scored(shared.value, strengths(shared.value, textstats.statistics(texts)[1])))

    names = [c for c in df.columns if c not in ("score", "predicted")]
    rows = text_batches(df).select(*names, F.arrow_udf(column, "double")(F.col("text").cast("string")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= model.at_cut).cast("int"))


def op4_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored; labels of three quarters of the rows are learned from."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = fitted(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out)
    return ranked(documents, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
