"""Ranks, quantiles, cuts and ungrouped windows with hot groups, against brute force."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfspark.config import FeatureConfig, SplitConfig
from shelfspark.operators import encoding, features, quantiles, ranking, splits


def skewed(n=3000, seed=1):
    """A third of the rows in one group; ties, nulls and a null group."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else f"g{i % 17}" if i % 50 else None
        value = None if i % 101 == 0 else float(rng.choice([0, 0, 1, rng.randint(-500, 500), rng.gauss(0, 100)]))
        rows.append((i, group, value))
    return rows


PROBS = {"lo": 0.0, "q1": 0.25, "med": 0.5, "p77": 0.77, "hi": 1.0}


@pytest.mark.parametrize("bins, counted", [(3, 20), (16, 100), (4096, 20), (4096, 10**6), (2, 1)])
def test_exact_quantiles(spark, monkeypatch, bins, counted):
    monkeypatch.setattr(quantiles, "COUNTED_ROWS", counted)
    rows = skewed()
    df = spark.createDataFrame(rows, "id long, g string, v double").withColumn("w", F.col("v") * 2 + 1)
    out = quantiles.exact_quantiles(df, ["g"], ["v", "w"], PROBS, bins=bins).toPandas()
    pdf = pd.DataFrame(rows, columns=["id", "g", "v"]).dropna(subset=["v"])
    pdf["g"] = pdf["g"].fillna("<null>")
    out["g"] = out["g"].astype(object).where(out["g"].notna(), "<null>")
    for column, scale in (("v", lambda v: v), ("w", lambda v: v * 2 + 1)):
        got = out[out["column"] == column].set_index("g")
        assert set(got.index) == set(pdf["g"])
        for g, values in pdf.groupby("g")["v"]:
            assert got.loc[g, "n"] == len(values)
            for name, p in PROBS.items():
                assert got.loc[g, name] == pytest.approx(np.quantile(scale(values.to_numpy()), p), abs=1e-9)


def test_exact_quantiles_of_few_values_and_whole_frame(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,)], "v double")
    row = quantiles.exact_quantiles(df, [], ["v"], {"q": 0.25, "m": 0.5}).collect()
    assert [(r["n"], r["q"], r["m"]) for r in row] == [(2, 1.75, 2.5)]
    one = quantiles.exact_quantiles(df.where("v = 4"), [], ["v"], {"q": 0.25}).collect()
    assert [(r["n"], r["q"]) for r in one] == [(1, 4.0)]


def far_apart(seed=4):
    """Doubles of every size and sign, neighbours, ties and values without a size."""
    rng = random.Random(seed)
    sizes = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-320, 308) for _ in range(400)]
    near = [1.0 + k * 2.0**-52 for k in range(100)] + [k * 5e-324 for k in range(-30, 30)]
    return {
        "all": sizes + near + [0.0, -0.0, 7.0, 7.0, float("inf"), float("-inf"), float("inf")],
        "one": [3.5] * 500,
        "negative": [-abs(x) for x in sizes if x],
        "nan": [abs(x) for x in sizes[:50]] + [float("inf"), float("nan"), float("nan")],
        "mixed nan": sizes[:60] + [float("-inf"), float("nan")],
    }


@pytest.mark.parametrize("bins", [2, 64])
def test_exact_quantiles_of_any_double(spark, monkeypatch, bins):
    monkeypatch.setattr(quantiles, "COUNTED_ROWS", 10)
    groups = far_apart()
    df = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "g string, v double").repartition(6)
    rows = quantiles.exact_quantiles(df, ["g"], ["v"], PROBS, bins=bins).collect()
    assert {r["g"] for r in rows} == set(groups)
    for r in rows:
        values = sorted((v + 0.0 for v in groups[r["g"]]), key=lambda v: (math.isnan(v), v))
        for name, p in PROBS.items():
            place = p * (len(values) - 1)
            low, high = values[math.floor(place)], values[math.ceil(place)]
            part = place - math.floor(place)
            want = low + part * (high - low) if part > 0 else low
            assert r[name] == want or math.isnan(want) and math.isnan(r[name]), (r["g"], name)


def test_exact_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert quantiles.exact_quantiles(df, ["g"], ["v"], {"q": 0.5}).collect() == []
    assert quantiles.exact_quantiles(df.where("false"), [], ["v"], {"q": 0.5}).collect() == []


def test_grouped_rank(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "id long, g string, v double").repartition(7)
    got = ranking.grouped_rank(df, ["g"], ["v", "id"]).collect()
    expected = {}
    groups = {}
    for i, g, v in rows:
        groups.setdefault(g, []).append((v is not None, v or 0.0, i))
    for g, members in groups.items():
        for place, (_, _, i) in enumerate(sorted(members), 1):
            expected[i] = (place, len(members))
    assert {r["id"]: (r["rank"], r["rank_of"]) for r in got} == expected


def series(n=300):
    rng = random.Random(5)
    start = dt.date(2024, 1, 1)
    # A hot day: a third of the rows fall on it.
    return [
        (start + dt.timedelta(days=50 if i % 3 == 0 else i % 100), f"s{i:04d}", float(rng.randint(0, 99)) if i % 23 else None)
        for i in range(n)
    ]


def test_ungrouped_features_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(features, "BLOCK_ROWS", 40)
    rows = series()
    df = spark.createDataFrame(rows, "date date, store_id string, sales double").repartition(5)
    cfg = FeatureConfig(lags=(1, 7, 30), windows=(3, 30))
    got = features.history_features(df, groups=None, cfg=cfg, tie_break=["store_id"]).orderBy("date", "store_id").toPandas()
    pdf = pd.DataFrame(rows, columns=["date", "store_id", "sales"]).sort_values(["date", "store_id"]).reset_index(drop=True)
    for n in cfg.lags:
        np.testing.assert_allclose(got[f"sales_lag_{n}"].astype(float), pdf["sales"].shift(n))
    for n in cfg.windows:
        for stat in cfg.stats:
            want = pdf["sales"].shift(1).rolling(n, min_periods=1).agg(stat)
            np.testing.assert_allclose(got[f"sales_rolling_{n}_{stat}"].astype(float), want, atol=1e-9)


def test_reach_of_more_than_two_blocks(spark, monkeypatch):
    monkeypatch.setattr(features, "BLOCK_ROWS", 10)
    rows = series(120)
    df = spark.createDataFrame(rows, "date date, store_id string, sales double").repartition(3)
    cfg = FeatureConfig(lags=(25,), windows=(35,), stats=("mean",))
    got = features.history_features(df, groups=None, cfg=cfg, tie_break=["store_id"]).orderBy("date", "store_id").toPandas()
    sales = pd.DataFrame(rows, columns=["date", "store_id", "sales"]).sort_values(["date", "store_id"])["sales"].reset_index(drop=True)
    np.testing.assert_allclose(got["sales_lag_25"].astype(float), sales.shift(25))
    np.testing.assert_allclose(got["sales_rolling_35_mean"].astype(float), sales.shift(1).rolling(35, min_periods=1).mean())


@pytest.mark.parametrize("direct", [10, 200_000])
def test_row_split_finds_the_cut_rows_on_a_hot_day(spark, monkeypatch, direct):
    monkeypatch.setattr(splits, "DIRECT_SORT_ROWS", direct)
    rows = series()
    df = spark.createDataFrame(rows, "date date, store_id string, sales double").repartition(6)
    got = {r["store_id"]: r["split"] for r in splits.split_by_rows(df).collect()}
    train, validation = SplitConfig().sizes(len(rows))
    expected = {}
    for place, (_, store, sales) in enumerate(sorted(rows, key=lambda r: (r[0], r[1]))):
        if sales is not None:
            expected[store] = "train" if place < train else "validation" if place < train + validation else "test"
    assert got == expected


def test_split_sizes_use_floating_point():
    assert SplitConfig().sizes(10) == (7, 1)
    assert SplitConfig(0.2, 0.2).sizes(5) == (3, 1)


def test_encoding_with_large_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(encoding, "BROADCAST_ROWS", 3)
    train = spark.createDataFrame([("b", "x"), ("a", "x"), ("d", "y"), ("c", None), ("a", "y")], "k string, m string")
    codes = encoding.fit_codes(train, ["k", "m"])
    other = spark.createDataFrame([(1, "a", "y"), (2, "z", None), (3, "d", "x")], "id int, k string, m string")
    rows = encoding.encode(other, codes).orderBy("id").collect()
    assert [(r["k"], r["m"]) for r in rows] == [(0.0, 1.0), (-1.0, -1.0), (3.0, 0.0)]


def test_columns_of_few_values_are_not_counted_again(spark, monkeypatch):
    """Once the cells of a column hold one value each, its quantiles are known: only the other columns are read once more."""
    monkeypatch.setattr(quantiles, "COUNTED_ROWS", 100)
    rows = spark.range(3000).selectExpr("int(id % 2) AS g", "double(id % 3) AS few", "double(id * id) AS many", "CAST(NULL AS DOUBLE) AS none")
    found = quantiles.exact_quantiles(rows, ["g"], ["few", "many", "none"], {"q1": 0.25, "q2": 0.5})
    got = {(r.g, r["column"]): (r.n, r.q1, r.q2) for r in found.collect()}
    want = {}
    for g in (0, 1):
        for name, values in (("few", [i % 3 for i in range(3000) if i % 2 == g]), ("many", [i * i for i in range(3000) if i % 2 == g])):
            values.sort()
            want[g, name] = (1500, *[values[int(p)] + (p % 1) * (values[int(p) + 1] - values[int(p)]) for p in (0.25 * 1499, 0.5 * 1499)])
    assert got == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "many" in plan and "% 3" not in plan
