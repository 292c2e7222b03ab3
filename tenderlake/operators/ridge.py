"""Closed-form ridge regression: the Gram matrix and the moments are one aggregate over the rows.

With p columns the aggregate has p(p+1)/2 + p sums, combined on the map side; the driver
solves the p x p system.  Columns are standardised with the training rows' mean and sample standard
deviation (a constant column is only centred); a missing value is the mean.  The intercept is not
penalised.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Ridge:
    features: list[str]
    means: list[float]
    scales: list[float]
    weights: list[float]  # the intercept first

    def columns(self) -> list[Column]:
        """The intercept's column and the standardised features."""
        one = [F.lit(1.0)]
        for name, mean, scale in zip(self.features, self.means, self.scales):
            x = F.col(name).cast("double")
            one.append(F.coalesce(F.when(F.isnan(x), None).otherwise((x - mean) / scale), F.lit(0.0)))
        return one

    def predict(self) -> Column:
        first, *rest = [F.lit(w) * c for w, c in zip(self.weights, self.columns())]
        out = first
        for c in rest:
            out = out + c
        return out


def fit_ridge(train: DataFrame, features: list[str], target: str, penalty: float = 1.0) -> Ridge:
    """Ridge of ``target`` on ``features``; rows without a target don't count.  Without rows all weights are 0."""
    rows = train.where(F.col(target).isNotNull())
    known = {f: F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")) for f in features}
    got = rows.agg(*[F.avg(c).alias(f"m_{f}") for f, c in known.items()],
                   *[F.stddev_samp(c).alias(f"s_{f}") for f, c in known.items()]).first()
    model = Ridge(list(features), [got[f"m_{f}"] or 0.0 for f in features], [got[f"s_{f}"] or 1.0 for f in features], [])
    columns = model.columns()
    p = len(columns)
    y = F.col(target).cast("double")
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    sums = rows.agg(*[F.sum(columns[i] * columns[j]).alias(f"g_{i}_{j}") for i, j in pairs],
                    *[F.sum(columns[i] * y).alias(f"b_{i}") for i in range(p)]).first()
    gram = np.zeros((p, p))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = sums[f"g_{i}_{j}"] or 0.0
    gram += penalty * np.diag([0.0] + [1.0] * (p - 1))
    moments = np.array([sums[f"b_{i}"] or 0.0 for i in range(p)])
    if not gram[0, 0]:
        gram[0, 0] = 1.0
    model.weights = [float(w) for w in np.linalg.solve(gram, moments)]
    return model
