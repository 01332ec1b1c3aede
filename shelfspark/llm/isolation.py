"""Quality rules with an isolation forest on their statistics.

A rule statistic is by how much a share (of symbols, capitals, repeated lines ...) exceeds what labelled good documents
show, with a margin; within that tolerance it is zero, so ordinary documents are alike in all of them and odd ones stand apart.
Random splits isolate odd rows early. Each tree splits a subsample of labelled documents at random values of random
statistics; the mean path length of a document over all trees gives its anomaly score, 2 ** (-path / expected path).
Tolerances and threshold come from all labelled rows: the threshold is the lowest score that at most ``most_lost`` of the
good ones exceed.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import textstats
from shelfspark.llm.storage import dropped, stored, text_batches
from shelfspark.operators.quantiles import exact_quantiles

RULES = ("symbols", "upper", "marks", "bars", "dup_lines", "repeats")
LEAST_WORDS = 10
MOST_REPEATS = 20


@dataclass(frozen=True)
class Settings:
    trees: int = 200
    sample: int = 256
    most_lost: float = 0.002
    margin: float = 1.5
    tolerated: float = 0.999
    seed: int = 7


@dataclass(frozen=True)
class Forest:
    """Trees as arrays over nodes: split statistic (-1 at a leaf), split value, first child, path length at a leaf."""

    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    expected: float
    tolerance: np.ndarray | None = None
    threshold: float = 1.0


def excess(shapes: np.ndarray, tolerance: np.ndarray) -> np.ndarray:
    """The rule statistics of rows of ``textstats.SHAPES``."""
    return np.maximum(0.0, shapes[:, [textstats.SHAPES.index(r) for r in RULES]] - tolerance)


def _expected_path(n: int) -> float:
    """The mean path length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def grown(rows: np.ndarray, how: Settings) -> Forest:
    rng = np.random.default_rng(how.seed)
    feature, value, child, path, roots = [], [], [], [], []
    size = min(how.sample, len(rows))
    deepest = int(np.ceil(np.log2(max(size, 2))))

    def node() -> int:
        for x, y in ((feature, -1), (value, 0.0), (child, 0), (path, 0.0)):
            x.append(y)
        return len(feature) - 1

    for _ in range(how.trees if size else 0):
        roots.append(node())
        todo = [(roots[-1], rows[rng.choice(len(rows), size, replace=False)], 0)]
        while todo:
            here, part, depth = todo.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            open_ = np.flatnonzero(high > low)
            if depth >= deepest or len(part) < 2 or not len(open_):
                path[here] = depth + _expected_path(len(part))
                continue
            f = int(rng.choice(open_))
            cut = rng.uniform(low[f], high[f])
            feature[here], value[here], child[here] = f, cut, node()
            right = node()
            left = part[:, f] < cut
            todo += [(child[here], part[left], depth + 1), (right, part[~left], depth + 1)] if left.any() else [(right, part, depth + 1)]
    return Forest(*(np.array(x) for x in (feature, value, child, path)), np.array(roots, np.int64), _expected_path(size) or 1.0)


def anomaly(forest: Forest, rows: np.ndarray) -> np.ndarray:
    """Scores of 0 to 1; higher is odder."""
    total = np.zeros(len(rows))
    index = np.arange(len(rows))
    for root in forest.roots:
        at = np.full(len(rows), root)
        while (inner := forest.feature[at] >= 0).any():
            split = at[inner]
            at[inner] = forest.child[split] + (rows[index[inner], forest.feature[split]] >= forest.value[split])
        total += forest.path[at]
    return 2.0 ** (-total / max(len(forest.roots), 1) / forest.expected) if len(forest.roots) else total


def base_fails(n_words, n_repeat_words):
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATS * n_words)


def _scored(forest: Forest, tolerance: np.ndarray):
    """Anomaly scores of arrays of ``textstats.SHAPES``, as a function of an Arrow column."""

    def score(shapes: pa.Array) -> pa.Array:
        values = np.asarray(shapes.flatten()).reshape(len(shapes), len(textstats.SHAPES))
        return pa.array(anomaly(forest, excess(values, tolerance)))

    return score


def fitted(documents: DataFrame, labels: DataFrame, how: Settings = Settings()) -> Forest:
    """A forest and its threshold from all labelled documents.

    Rows that fail the base rules teach nothing. Without good rows the forest keeps everything. One half of the rows sets
    tolerances and grows the trees, the other sets the threshold. To the driver come quantiles and the rows that trees
    are grown on, ``how.sample`` for each, as the method has it.
    """
    rows = textstats.labelled_shapes(documents, labels).where(~base_fails(F.col("n_words"), F.col("n_repeat_words")))
    rows = stored(rows.select("doc_id", "quality", "shapes", (F.pmod(F.xxhash64("doc_id", F.lit(how.seed)), F.lit(2)) == 0).alias("half")), "labelled-shapes")
    good = rows.where("quality = 1")
    sizes = {r["half"]: r["count"] for r in good.groupBy("half").count().collect()}
    if len(sizes) < 2:
        return grown(np.zeros((0, len(RULES))), how)
    shares = good.where("half").select(*[F.greatest(F.lit(0.0), F.col("shapes")[textstats.SHAPES.index(r)]).alias(r) for r in RULES])
    found = {r["column"]: r["most"] for r in exact_quantiles(shares, [], RULES, {"most": how.tolerated}).collect()}
    tolerance = how.margin * np.array([found[r] for r in RULES])
    drawn = rows.where("half").orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.trees * how.sample).select("shapes").collect()
    forest = grown(excess(np.array([r.shapes for r in drawn]), tolerance), how)
    scores = good.where("not half").select(F.arrow_udf(_scored(forest, tolerance), "double")("shapes").alias("score"))
    lost = int(how.most_lost * (sizes[False] - 1)) + 1
    threshold = scores.orderBy(F.desc("score")).limit(lost).agg(F.min("score")).first()[0]
    dropped(rows)
    return replace(forest, tolerance=tolerance, threshold=float(threshold))


def judged(df: DataFrame, forest: Forest) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, anomaly and kept.

    Null and empty texts have zero counts and fail the base rules. Columns of these names are replaced; all others stay.
    """
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def score(shapes: pa.Array) -> pa.Array:
        values = np.asarray(shapes.flatten()).reshape(len(shapes), len(textstats.SHAPES))
        forest = shared.value
        tolerance = np.zeros(len(RULES)) if forest.tolerance is None else forest.tolerance
        return pa.array(anomaly(forest, excess(values, tolerance)))

    names = [c for c in df.columns if c not in (*textstats.COUNTS, "base_failed", "anomaly", "kept")]
    rows = text_batches(df).select(*names, textstats.measured(F.col("text")).alias("__m"))
    rows = rows.select(*names, *[f"__m.{c}" for c in textstats.COUNTS], F.arrow_udf(score, "double")("__m.shapes").alias("anomaly"))
    failed = base_fails(F.col("n_words"), F.col("n_repeat_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("anomaly") <= forest.threshold))


def op7_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, judged with a forest fitted on labelled ones."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    forest = fitted(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged(documents, forest).select("doc_id", *textstats.COUNTS, "base_failed", "kept", "anomaly")
