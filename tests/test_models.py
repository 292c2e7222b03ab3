"""Boosting with patience, and the closed-form ridge, against plain computations."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tenderlake.operators.boosting import best_prefix, boost, prefix, prefix_losses
from tenderlake.operators.ridge import fit_ridge
from tenderlake.plans.common import checkpointed


@pytest.mark.parametrize("losses, patience, expected", [
    ([5.0, 5.0, 4.0, 4.5, 4.6], 2, (3, True)),       # a flat first round, then a gain
    ([5.0, 5.0, 5.0, 1.0], 2, (1, True)),            # the gain comes after the patience ended
    ([5.0, 5.0, 5.0, 1.0], 3, (4, False)),
    ([3.0], 5, (1, False)), ([2.0, 2.0], 1, (1, True))])
def test_best_prefix(losses, patience, expected):
    assert best_prefix(losses, patience) == expected


def test_patience_finds_gains_after_a_flat_start(spark):
    # Six features add up; a small step gains less in each round than a fixed tolerance asks for.
    x = [F.rand(i + 1).alias(f"x{i}") for i in range(6)]
    d = spark.range(1200).select("id", *x).withColumn("label", sum((F.col(f"x{i}") > 0.5).cast("double") for i in range(6)))
    d = VectorAssembler(inputCols=[f"x{i}" for i in range(6)], outputCol="features").transform(d)
    d = checkpointed(spark, d.select("features", "label", (F.col("id") % 5 == 0).alias("is_check")))
    train, check = d.where(~F.col("is_check")), d.where(F.col("is_check"))
    own = GBTRegressor(featuresCol="features", labelCol="label", maxDepth=1, stepSize=0.005, seed=1)
    flat = own.copy({own.validationIndicatorCol: "is_check", own.validationTol: 0.05, own.maxIter: 40}).fit(d)
    assert flat.getNumTrees == 1
    found = boost(own, train, check, rounds=40, patience=20)
    assert found.fitted == 40 and found.chosen == found.model.getNumTrees > 30
    assert found.losses[found.chosen - 1] == min(found.losses) < 0.9 * found.losses[0]
    # The kept model is the prefix that was chosen.
    assert prefix_losses(found.model, check, False)[-1] == pytest.approx(min(found.losses))
    assert boost(own, train, check.where("false"), rounds=3, patience=20).chosen == 3  # nothing to choose on


@pytest.mark.parametrize("kind", [GBTRegressor, GBTClassifier])
def test_the_best_prefix_is_kept_without_another_fit(spark, kind, tmp_path, monkeypatch):
    d = spark.range(400).select((F.rand(1) > 0.5).cast("double").alias("label"), F.rand(2).alias("x"), F.rand(3).alias("y"))
    d = checkpointed(spark, VectorAssembler(inputCols=["x", "y"], outputCol="f").transform(d))
    own = kind(featuresCol="f", labelCol="label", maxDepth=2, stepSize=0.3, seed=1)
    fits, plain = [], kind._fit
    monkeypatch.setattr(kind, "_fit", lambda self, df: (fits.append(self.getMaxIter()), plain(self, df))[1])
    found = boost(own, d.where("x < 0.7"), d.where("x >= 0.7"), rounds=30, patience=4)
    assert found.chosen < found.fitted and fits == [16]  # labels are noise: the first ensemble is enough
    again = own.copy({own.maxIter: found.chosen}).fit(d.where("x < 0.7"))
    assert found.model.getNumTrees == found.chosen and found.model.treeWeights == again.treeWeights
    assert found.model.toDebugString.split("\n", 1)[1] == again.toDebugString.split("\n", 1)[1]
    assert found.model.featureImportances == again.featureImportances
    found.model.write().save(str(tmp_path / "model"))
    columns = ["prediction"] if kind is GBTRegressor else ["prediction", "probability", "rawPrediction"]
    loaded = type(found.model).load(str(tmp_path / "model"))
    want = again.transform(d).select(*columns).collect()
    assert want == found.model.transform(d).select(*columns).collect() == loaded.transform(d).select(*columns).collect()
    assert len(prefix(again, 1).trees) == 1


def test_ridge_equals_the_normal_equations(spark):
    r = np.random.default_rng(5)
    x = r.standard_normal((200, 3)) * [1, 50, 0] + [0, 1000, 7]
    y = 3 + x @ [2.0, -0.1, 4.0] + r.standard_normal(200)
    rows = [(float(a), None if i % 9 == 0 else float(b), float(c), float(t)) for i, ((a, b, c), t) in enumerate(zip(x, y))]
    d = spark.createDataFrame(rows + [(1.0, 2.0, 3.0, None)], "a double, b double, c double, y double")
    model = fit_ridge(d, ["a", "b", "c"], "y")
    known = np.array([[np.nan if v is None else v for v in row[:3]] for row in rows])
    scale = np.nanstd(known, axis=0, ddof=1)
    z = np.nan_to_num((known - np.nanmean(known, axis=0)) / np.where(scale > 0, scale, 1))
    z = np.c_[np.ones(200), z]
    w = np.linalg.solve(z.T @ z + np.diag([0, 1, 1, 1]), z.T @ y)
    assert np.allclose(model.weights, w)
    got = [v for v, in d.where("y is not null").select(model.predict()).collect()]
    assert np.allclose(sorted(got), sorted(z @ w))
    assert fit_ridge(d.where("false"), ["a"], "y").weights == [0.0, 0.0]
