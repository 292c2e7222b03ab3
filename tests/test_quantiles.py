"""Exact quantiles by narrowing and by counted values, against plain sorting."""

from __future__ import annotations

import numpy as np
import pytest

from tenderlake.plans import common as K

QS = [0.0, 0.1, 0.25, 0.5, 0.755, 1.0]
_r = np.random.default_rng(3)
COLUMNS = {
    "continuous": _r.standard_normal(4000).tolist(),
    "one value holds nearly all": [7.0] * 3900 + _r.uniform(-1, 1, 60).tolist() + _r.uniform(7, 9, 40).tolist(),
    "heavy value beside the place": [1.0] * 1999 + [2.0] + (2 + _r.random(2000)).tolist(),
    "few values": [float(x) for x in _r.integers(0, 4, 3000)],
    "one row": [5.0], "two rows": [5.0, 6.0], "one value": [3.0] * 50, "none": [],
    "infinite ends": [float("-inf"), float("inf"), 0.0, 1.0, 2.0],
}


@pytest.mark.parametrize("name", COLUMNS)
@pytest.mark.parametrize("last, margin", [(10_000, 5e-4), (3, 5e-4), (3, 0.1)])
def test_order_statistics(spark, monkeypatch, name, last, margin):
    monkeypatch.setattr(K, "LAST_ROWS", last)
    monkeypatch.setattr(K, "MARGIN", margin)
    values = COLUMNS[name]
    d = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "v double")
    got, order = K.order_statistics(d, "v", QS), sorted(values)
    for q, found in zip(QS, got):
        if not values:
            assert found is None
            continue
        place = (len(values) - 1) * q
        assert found[:2] == (order[int(np.floor(place))], order[int(np.ceil(place))])
        assert found[2] == pytest.approx(place - np.floor(place))


def test_a_wrong_estimate_only_repeats_the_step(spark, monkeypatch):
    monkeypatch.setattr(K, "LAST_ROWS", 2)
    real, calls = K.F.percentile_approx, []

    def off(col, at, accuracy):
        calls.append(at)  # the first estimates lie far above the place
        return real(col, [0.9, 0.95] if len(calls) <= 2 else at, accuracy)

    monkeypatch.setattr(K.F, "percentile_approx", off)
    d = spark.range(1000).selectExpr("id * 1.5D AS v")
    assert K.quantiles_of(d, "v", {"m": 0.5}) == {"m": 749.25}
    assert len(calls) > 2


def test_integers_and_nan(spark):
    assert K.quantiles_of(spark.range(4), "id", {"a": 0.5, "b": 0.0}) == {"a": 1.5, "b": 0.0}
    d = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,)], "v double")
    assert K.quantiles_of(d, "v", {"m": 0.5, "low": 0.25}) == {"m": 2.0, "low": 1.5}


def test_grouped_quantiles_with_a_hot_group_and_a_hot_value(spark):
    rows = [("a", v) for v in COLUMNS["one value holds nearly all"]] + [("b", v) for v in (4.0, 1.0, 9.0, 2.0)]
    rows += [("c", 1.0), ("d", None)]
    d = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.low, r.mid) for r in K.grouped_quantiles(spark, d, ["g"], "v", {"low": 0.005, "mid": 0.5}).collect()}
    assert set(got) == {"a", "b", "c"}
    for g in got:
        own = [v for k, v in rows if k == g]
        assert got[g] == pytest.approx((np.quantile(own, 0.005), np.quantile(own, 0.5)))
