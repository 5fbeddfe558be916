"""Least squares with one swept-out factor, and Student's t.

The factor (a category, with any number of levels) is removed by sums inside its levels.  What is left to solve is the
small system of the other regressors; levels and variances are column expressions on one row per factor level.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import count_big, dbl
from storeops.session import materialize


@dataclass(frozen=True)
class SweptFit:
    """y ~ factor + regressors.

    ``levels`` has one row per factor level: the level, its count ``n`` and the means ``x`` (array) and ``y``.  The rest
    is of fixed size: coefficients, inverse of the swept system, residual variance and the usual figures.
    """

    factor: str
    names: list[str]
    levels: DataFrame
    base: dict
    beta: np.ndarray
    inverse: np.ndarray
    sigma2: float
    n: int
    parameters: int
    r2: float
    r2_adj: float
    aic: float
    bic: float

    def _spread(self, d: list[Column]) -> Column:
        """d' inverse d."""
        terms = [F.lit(float(self.inverse[i, j])) * a * b for i, a in enumerate(d) for j, b in enumerate(d)]
        return sum(terms[1:], terms[0])

    def mean_and_se(self, x: list[Column]) -> tuple[Column, Column]:
        """Prediction and its standard error at regressors ``x``, for a row of ``levels``."""
        d = [dbl(v) - F.col("x")[i] for i, v in enumerate(x)]
        mean = sum((F.lit(float(b)) * v for b, v in zip(self.beta, d)), F.col("y"))
        return mean, F.sqrt(F.greatest(self.sigma2 * (1 / F.col("n") + self._spread(d)), F.lit(0.0)))

    def terms(self) -> DataFrame:
        """term, coefficient, se: the first level as intercept, the others against it, then the regressors."""
        base_x, base_y, base_n = self.base["x"], self.base["y"], self.base["n"]
        shift = float(self.beta @ np.array(base_x))
        d = [F.col("x")[i] - F.lit(float(v)) for i, v in enumerate(base_x)]
        effect = F.col("y") - F.lit(base_y) - sum((F.lit(float(b)) * v for b, v in zip(self.beta, d)), F.lit(0.0))
        others = self.levels.where(F.col(self.factor) != F.lit(self.base["level"])).select(
            F.concat(F.lit(f"{self.factor}="), F.col(self.factor)).alias("term"), effect.alias("coefficient"),
            F.sqrt(self.sigma2 * (1 / F.col("n") + F.lit(1 / base_n) + self._spread(d))).alias("se"),
        )
        v = self.sigma2 * (1 / base_n + float(np.array(base_x) @ self.inverse @ np.array(base_x)))
        rows = [("Intercept", base_y - shift, math.sqrt(v))]
        rows += [(m, float(b), math.sqrt(self.sigma2 * self.inverse[i, i])) for i, (m, b) in enumerate(zip(self.names, self.beta)) if self.inverse[i, i] > 0]
        fixed = self.levels.sparkSession.createDataFrame(rows, "term string, coefficient double, se double")
        return fixed.unionByName(others)


def fit_swept(rows: DataFrame, factor: str, y: Column, regressors: dict[str, Column]) -> SweptFit:
    """Fits in one grouping: the driver gets a single row of sums, whatever the number of rows or levels."""
    names, x = list(regressors), [dbl(c) for c in regressors.values()]
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    per = rows.groupBy(factor).agg(
        count_big().alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy"),
        *[F.sum(c).alias(f"s{i}") for i, c in enumerate(x)], *[F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i, j in pairs],
        *[F.sum(c * y).alias(f"sy{i}") for i, c in enumerate(x)],
    )
    per = materialize(rows.sparkSession, per, "levels")
    c = F.col
    level = F.struct(c(factor).alias("level"), c("n"), (c("sy") / c("n")).alias("y"), F.array(*[c(f"s{i}") / c("n") for i in range(len(x))]).alias("x"))
    one = per.agg(
        F.sum("n").alias("n"), F.sum("sy").alias("y"), F.sum("syy").alias("yy"), count_big().alias("levels"), F.min(level).alias("base"),
        F.sum(c("syy") - c("sy") * c("sy") / c("n")).alias("rest"),
        *[F.sum(c(f"s{i}_{j}") - c(f"s{i}") * c(f"s{j}") / c("n")).alias(f"w{i}_{j}") for i, j in pairs],
        *[F.sum(c(f"sy{i}") - c(f"s{i}") * c("sy") / c("n")).alias(f"m{i}") for i in range(len(x))],
    ).first()
    gram = np.zeros((len(x), len(x)))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = one[f"w{i}_{j}"]
    moment = np.array([one[f"m{i}"] for i in range(len(x))])
    inverse = np.linalg.pinv(gram, rcond=1e-12, hermitian=True)
    beta = inverse @ moment
    n, k = one["n"], one["levels"] + int(np.linalg.matrix_rank(gram, hermitian=True))
    rss, tss = max(one["rest"] - float(beta @ moment), 0.0), one["yy"] - one["y"] ** 2 / n
    r2 = 1 - rss / tss
    log_like = -n / 2 * (math.log(2 * math.pi) + math.log(rss / n) + 1)
    return SweptFit(
        factor, names, per.select(factor, level.getField("n").alias("n"), level.getField("y").alias("y"), level.getField("x").alias("x")),
        one["base"].asDict(), beta, inverse, rss / (n - k), n, k, r2, 1 - (1 - r2) * (n - 1) / (n - k),
        2 * k - 2 * log_like, math.log(n) * k - 2 * log_like,
    )


def two_sided_p(t: np.ndarray, df: int) -> np.ndarray:
    """P(|T| > |t|) of Student's t by the regularised incomplete beta function."""
    x = df / (df + np.asarray(t, float) ** 2)
    a, b = df / 2, 0.5
    direct = x <= (a + 1) / (a + b + 2)
    out = np.where(direct, _beta_fraction(a, b, np.where(direct, x, 0.5)), 1 - _beta_fraction(b, a, np.where(direct, 0.5, 1 - x)))
    return np.where(x >= 1, 1.0, np.where(x <= 0, 0.0, out))


def _beta_fraction(a: float, b: float, x: np.ndarray) -> np.ndarray:
    x = np.clip(x, 1e-300, 1 - 1e-16)
    front = np.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * np.log(x) + b * np.log1p(-x)) / a
    # even and odd terms of the continued fraction, evaluated from the tail
    value = np.ones_like(x)
    for m in range(200, 0, -1):
        odd = -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        value = 1 + odd / (1 + even / value)
    return front / value


def with_p_values(terms: DataFrame, df: int) -> DataFrame:
    """``terms`` (term, coefficient, se) with p_value."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            t = part["coefficient"] / part["se"].where(part["se"] > 0)
            part["p_value"] = np.where(t.isna(), 0.0, two_sided_p(t.fillna(0.0).to_numpy(), df))
            yield part

    return terms.mapInPandas(run, "term string, coefficient double, se double, p_value double")
