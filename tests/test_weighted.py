"""Weighted sampling without replacement."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsgrain.operators import sampling


def _times(rows, seed):
    out = {}
    for i, w in rows:
        if w is not None and 0 < w < math.inf:
            u = (int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:15], 16) + 1) / (16 ** 15 + 1)
            out[i] = -math.log(u) / w
    return out


ROWS = [(i, (i % 5) * 0.5 + (100.0 if i % 97 == 0 else 0.0)) for i in range(3000)] + [(-1, None), (-2, -3.0), (-3, math.nan), (-4, math.inf)]


@pytest.mark.parametrize("size, seed", [(1, 1), (100, 1), (100, 2), (2399, 3), (10_000, 4), (0, 5), (0.25, 6), (1.0, 7), (0.0, 8)])
def test_exact_size_and_rows(spark, size, seed):
    df = spark.createDataFrame(ROWS, "id int, w double").repartition(5)
    times = _times(ROWS, seed)
    n = min(size, len(times)) if isinstance(size, int) else math.floor(size * len(times))
    got = sampling.weighted_sample(df, "w", size, ["id"], seed).collect()
    assert sorted(r.id for r in got) == sorted(sorted(times, key=times.get)[:n])
    assert {(r.id, r.w) for r in got} <= set(ROWS)


def test_inclusion_rates(spark):
    """Rates over many groups of four agree with those of drawing two rows one after another."""
    weights = [1.0, 2.0, 4.0, 8.0]
    rows = [(g * 4 + k, g, w) for g in range(20_000) for k, w in enumerate(weights)]
    times = spark.createDataFrame(rows, "id int, g int, w double").select("g", "w", sampling._race_time(F.col("w"), 9, ["id"]).alias("t")).toPandas()
    picked = times.sort_values("t").groupby("g").head(2)
    rates = picked.groupby("w").size() / 20_000
    total = sum(weights)
    for w in weights:
        want = w / total + sum(v / total * w / (total - v) for v in weights if v != w)
        assert abs(rates[w] - want) < 5 * np.sqrt(want * (1 - want) / 20_000)


def test_no_rows_move(spark):
    df = spark.range(1000).withColumn("w", F.col("id") + 1.0)
    plan = sampling.weighted_sample(df, "w", 10, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [" not in plan.split("Subquery")[0]
    assert sampling.weighted_sample(df.where("id < 0"), "w", 10, ["id"]).collect() == []
