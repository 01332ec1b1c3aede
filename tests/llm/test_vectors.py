import math
import random

import numpy as np
from brute import Union

from shelfspark.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, component_id string, n_links string"


def brute(rows, threshold=0.93):
    groups, links = Union(), {}
    good = []
    for n, (i, e, label) in enumerate(rows):
        links[n] = 0
        if i is not None and label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e):
            v = np.array(e, np.float32).astype(float)
            good.append((n, i, v, label))
    for a, (n, i, v, label) in enumerate(good):
        for m, j, w, other in good[:a]:
            if label == other and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= threshold:
                links[n] += 1
                links[m] += 1
                groups.join(i, j)
    out = []
    for n, (i, _, _) in enumerate(rows):
        root = None if i is None else groups.find(i)
        out.append((i, links[n], root, i is not None and root == i))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


def test_odd_rows_and_groups(spark, empty):
    rng = random.Random(3)
    center = [rng.gauss(0, 1) for _ in range(16)]

    def near(spread):
        return [x + rng.gauss(0, spread) for x in center]

    rows = [(i, near(rng.choice([0.05, 0.25, 0.4, 2.0])), rng.choice([1, 1, 2])) for i in range(250)]
    rows += [(i, center, 1) for i in range(300, 340)] + [(300, center, 1)]
    rows += [(400, None, 1), (401, center, None), (402, [0.0] * 16, 1), (403, center[:15] + [None], 1), (404, center[:15] + [float("nan")], 1)]
    rows += [(405, center[:15] + [float("inf")], 1), (406, center[:8], 1), (407, [], 1), (None, center, 1), (None, None, None), (408, [x * 1000 for x in center], 1)]
    df = spark.createDataFrame([(*r, "c", "n") for r in rows], SCHEMA).repartition(4)
    want = brute(rows)
    # A null vec_id takes no part.
    assert result(vectors.near_vectors(df)) == want
    assert result(vectors.near_vectors(df, vectors.Settings(block_rows=20))) == want
    assert vectors.near_vectors(df.where("false")).count() == 0


def test_estimates_are_unbiased_and_bounded():
    how = vectors.Settings()
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    codes, factors = vectors.coded(x, how)
    values, width = vectors.estimated(codes, factors, x, how)
    error = values - x @ x.T
    off = ~np.eye(400, dtype=bool)
    assert (np.abs(error) <= width[:, None]).all()
    assert abs(error[off].mean()) < 0.002
    assert codes.shape == (400, how.bits // 8)


def test_rotation_keeps_lengths():
    turn = vectors.rotation(300, vectors.Settings())
    assert turn.shape[0] >= 300 and np.allclose(turn.T @ turn, np.eye(300))
