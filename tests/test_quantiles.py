"""Two-pass exact quantiles: brackets from sketches, against NumPy."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opsgrain.operators import quantiles
from opsgrain.operators.quantiles import exact_quantiles, quantile, upper_median

SPOTS = {"low": quantile(0.0), "q1": quantile(0.25), "m": quantile(0.5), "q99": quantile(0.99), "top": quantile(1.0), "u": upper_median}


def _groups():
    rng = np.random.default_rng(3)
    n = 60_000
    return {
        "normal": rng.normal(size=n), "ties": rng.integers(0, 7, n).astype(float), "one": np.full(n, 3.25), "few": np.array([5.0, -1.0]), "single": np.array([2.0]),
        "wide": np.exp(rng.normal(size=n) * 60), "mirrored": np.concatenate([-np.exp(rng.normal(size=n // 2) * 30), np.exp(rng.normal(size=n // 2) * 30)]),
        "narrow": 1e9 + rng.random(n) * 1e-4, "zeros": np.concatenate([np.zeros(n), [-0.0, 1.0]]), "hot": np.concatenate([np.full(n, 1.0), rng.random(2000)]),
        None: rng.random(5000), "huge": np.array([-1.7e308, 1.7e308, 0.0] * 50),
    }


@pytest.fixture(scope="module")
def values(spark):
    groups = _groups()
    rows = pd.DataFrame({"g": np.concatenate([np.full(len(v), g, object) for g, v in groups.items()]), "v": np.concatenate(list(groups.values()))})
    lost = pd.DataFrame({"g": ["normal", "nothing", "single"], "v": [math.nan, None, None]})
    return spark.createDataFrame(pd.concat([rows, lost]), "g string, v double").repartition(6)


def _check(got, groups):
    assert set(got) - {"nothing"} == set(groups) and "nothing" not in got
    for g, v in groups.items():
        s = np.sort(v)
        for name, q in (("low", 0), ("q1", 0.25), ("m", 0.5), ("q99", 0.99), ("top", 1)):
            at = (len(s) - 1) * q
            lo, hi = s[math.floor(at)], s[math.ceil(at)]
            with np.errstate(over="ignore"):
                want = lo + (hi - lo) * (at - math.floor(at))
            assert got[g][name] == pytest.approx(want, rel=1e-12, abs=0), (g, name)
        assert got[g]["u"] == s[len(s) // 2]


def test_any_distribution(values):
    _check({r.g: r.asDict() for r in exact_quantiles(values, "v", SPOTS, ["g"]).collect()}, _groups())


def test_more_than_one_cell_of_a_bracket(values, monkeypatch):
    """A coarse sketch and few cells leave work for every later step."""
    monkeypatch.setattr(quantiles, "_SKETCH", 64)
    monkeypatch.setattr(quantiles, "_MARGIN", 3 * 2.296 / 64 ** 0.9021)
    monkeypatch.setattr(quantiles, "_CELLS", 5)
    _check({r.g: r.asDict() for r in exact_quantiles(values, "v", SPOTS, ["g"]).collect()}, _groups())


def test_a_rank_outside_its_bracket_is_an_error(values, monkeypatch):
    monkeypatch.setattr(quantiles, "_SKETCH", 8)
    monkeypatch.setattr(quantiles, "_MARGIN", -0.02)
    with pytest.raises(Exception, match="outside its bracket"):
        exact_quantiles(values.where("g = 'normal'"), "v", SPOTS, ["g"]).collect()


def test_only_brackets_are_shuffled(values):
    counted = values.where("g = 'normal'").count()
    plan = exact_quantiles(values.where("g = 'normal'"), "v", {"m": quantile(0.5)}, ["g"])
    assert plan.count() == 1
    b = quantiles._brackets(values.where("g = 'normal'").select(F.lit(0).alias("_g0"), F.col("v").alias("_v")).where("not isnan(_v)"), ["_g0"], {"m": quantile(0.5)}).first()
    inside = values.where((F.col("g") == "normal") & F.col("v").between(b._lo, b._hi)).count()
    assert 0 < inside < 0.03 * counted


def test_empty_and_named_like_helpers(spark):
    assert exact_quantiles(spark.createDataFrame([], "g int, v double"), "v", SPOTS, ["g"]).collect() == []
    df = spark.createDataFrame([(1, 2, 3.0), (1, 2, 5.0)], "_i int, _rank int, _v double")
    assert [tuple(r) for r in exact_quantiles(df, "_v", {"m": quantile(0.5)}, ["_i", "_rank"]).collect()] == [(1, 2, 4.0)]
