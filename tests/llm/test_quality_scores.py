import random

import numpy as np
import pytest
from brute import counts
from samples import SCHEMA

from shelfspark.llm import isolation, ranking, textstats

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_counts_of_odd_rows(spark, odd, labels):
    rows = isolation.judged(odd, isolation.fitted(odd, labels)).collect()
    assert len(rows) == odd.count()
    for r in rows:
        n, chars, symbols, dup, repeats = counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeats)
        assert r.base_failed == (n < 10 or 100 * repeats > 20 * n)
        assert not (r.kept and r.base_failed)
        assert r.source in (None, "src0") and r.score == "s"


def test_counts_of_documents(documents):
    rng = random.Random(2)
    texts = [r.text for r in documents.select("text").collect()]
    texts += ["\n".join(rng.choice(["a b", "a  b", "", " ", "c"]) for _ in range(rng.randint(0, 8))) for _ in range(200)]
    import pyarrow as pa

    got, _ = textstats.statistics(pa.array(texts))
    assert [tuple(x) for x in got.tolist()] == [counts(t) for t in texts]


def test_forest_keeps_good_and_rejects_bad(documents, labels):
    kept = isolation.judged(documents, isolation.fitted(documents, labels)).join(labels, "doc_id").where("not base_failed")
    share = {r.quality: r.share for r in kept.groupBy("quality").agg({"kept": "count"}).join(kept.where("kept").groupBy("quality").count(), "quality", "left").selectExpr("quality", "coalesce(`count`, 0) / `count(kept)` share").collect()}
    assert share[1] >= 0.98 and share[0] <= 0.2


def test_forest_isolates_far_rows():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(2000, 4))
    forest = isolation.grown(rows, isolation.Settings())
    near, far = isolation.anomaly(forest, rows), isolation.anomaly(forest, rows + 20)
    assert far.min() > np.quantile(near, 0.99)
    # Alike rows cannot be split: nothing is odd.
    flat = isolation.grown(np.zeros((50, 4)), isolation.Settings())
    assert len(set(isolation.anomaly(flat, np.zeros((5, 4))))) == 1


def test_without_labels(spark, odd, empty, labels):
    none = labels.where("false")
    forest = isolation.fitted(odd, none)
    assert all(r.kept != r.base_failed for r in isolation.judged(odd, forest).collect())
    assert isolation.judged(empty, forest).count() == 0
    model = ranking.fitted(odd, none)
    assert {r.score for r in ranking.ranked(odd, model).collect()} and ranking.ranked(empty, model).count() == 0


def test_ranking_on_held_out_rows(spark, labels):
    rows = ranking.op4_quality_ranking(spark, FOLDER).join(labels.select("doc_id", "quality"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    above = np.mean([[g > b for b in bad] for g in good])
    assert right >= 0.95 and above >= 0.98


def test_scores_of_odd_rows(odd, documents, labels):
    model = ranking.fitted(documents, labels)
    rows = ranking.ranked(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    empties = {r.score for r in rows if not (r.text or "").strip()}
    assert len(empties) == 1 or max(empties) - min(empties) < 0.2


def test_labels_with_nulls_and_conflicts(spark, documents):
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 5), (3, 0), (3, 1), (4, 1)], "doc_id long, quality int")
    got = {r.doc_id: r.quality for r in textstats.labelled(documents, labels, 10).collect()}
    assert got == {3: 0, 4: 1}
    assert textstats.labelled(documents, labels, 1).count() == 1


def test_held_out_labels_teach_nothing(spark, documents, labels):
    """Turning the labels of held-out rows around changes no weight."""
    from pyspark.sql import functions as F

    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ranking.fitted(documents, labels, ~held), ranking.fitted(documents, turned, ~held)
    assert np.array_equal(a.weights, b.weights) and a.cut == b.cut


def test_schema_of_odd_rows(odd):
    assert SCHEMA.count(",") + 1 == len(odd.columns)


def test_all_labelled_rows_set_tolerances_and_threshold(spark, monkeypatch):
    """More labelled rows than were ever taken: of 24,000, half of the good ones less a share of 0.002 lie within the threshold."""
    rows = spark.range(24_000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 12 + int(id % 40)), x -> concat('w', x, '-', id % 97))) AS text", "int(id % 8 <> 0) AS quality")
    forest = isolation.fitted(rows, rows)
    seen = textstats.labelled_shapes(rows, rows)
    assert seen.count() == 24_000 and seen.where("quality = 1").count() == 21_000
    kept = isolation.judged(rows, forest).where("kept").join(rows.where("quality = 1").select("doc_id"), "doc_id").count()
    assert kept >= 0.995 * 21_000


def _ranked_by_all_pairs(shapes, good, ridge=1e-3):
    """Weights from every pair of a good and a bad row, by brute force."""
    x = ranking.features(shapes)
    scale = x.std(axis=0)
    scale[scale < 1e-12] = 1.0
    z = np.clip((x - x.mean(axis=0)) / scale, -8, 8)
    apart = (z[good][:, None] - z[~good][None]).reshape(-1, z.shape[1])
    weights = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(apart @ weights))
        gradient = -(apart.T @ p) / len(apart) + ridge * weights
        weights = weights - np.linalg.solve((apart.T * (p * (1 - p))) @ apart / len(apart) + ridge * np.eye(len(weights)), gradient)
    return weights, np.quantile(z @ weights, (~good).mean())


def test_ranking_learns_from_all_pairs(documents, labels):
    rows = textstats.labelled_shapes(documents, labels).orderBy("doc_id").limit(300).select("doc_id", "quality", "shapes").collect()
    few = documents.where(documents.doc_id.isin([r.doc_id for r in rows]))
    model = ranking.fitted(few, labels)
    weights, cut = _ranked_by_all_pairs(np.array([r.shapes for r in rows]), np.array([r.quality == 1 for r in rows]))
    assert np.allclose(model.weights, weights, atol=1e-5) and abs(model.cut - cut) < 1e-5


def test_every_labelled_row_is_in_a_block(spark):
    """Rows of a rare label are in several blocks, so that no block and no row is without pairs."""
    width = len(textstats.SHAPES)
    rows = spark.createDataFrame([(i, int(i % 100 != 0), [float(i)] * width) for i in range(3000)], "doc_id long, quality int, shapes array<double>")
    found = ranking.blocks(rows, 2970, 30, ranking.Settings(block_rows=100)).collect()
    plus, minus = ([{int(v) for v in r[k]} for r in found] for k in ("plus", "minus"))
    assert len(found) == 30 and all(plus) and all(len(m) >= 5 for m in minus)
    assert set().union(*plus, *minus) == set(range(3000)) and sum(map(len, plus)) == 2970
