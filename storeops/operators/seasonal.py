"""Seasonal forecasts: log-linear trend, yearly harmonics and holiday effects per category, from aggregated moments.

A day's design row is never gathered.  Products of sines and cosines are sines and cosines of sums and differences, so the
sums of 21 harmonics per category and holiday, plain, times trend and times demand, hold the whole Gram matrix.  One task
solves the small system of a category from them, and the days are scored by column expressions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import count_big, dbl
from storeops.session import materialize

FOURIER_ORDER = 10
YEAR = 365.25
BAND_80 = 1.2815515655446004  # standard normal quantile of 0.9
# a light ridge keeps harmonics and holidays that the data cannot tell apart finite
RIDGE_SEASON, RIDGE_HOLIDAY, RIDGE_ALL = 0.1, 1.0, 1e-9


def seasonal_grid(demand: DataFrame, holidays: DataFrame, horizon: int = 182) -> DataFrame:
    """category, ds, y (null ahead), holiday, tau (0 on the first, 1 on the last day), for every day up to the horizon."""
    span = demand.groupBy("category").agg(F.min("ds").alias("a"), F.date_add(F.max("ds"), horizon).alias("b"))
    day = F.explode(F.sequence("a", "b")).alias("ds")
    grid = span.select("category", "a", F.greatest(F.date_diff("b", "a"), F.lit(1)).alias("days"), day)
    named = holidays.groupBy(F.col("day").alias("ds")).agg(F.min("holiday").alias("holiday"))
    rows = grid.join(demand, ["category", "ds"], "left").join(F.broadcast(named), "ds", "left")  # a dozen days a year
    return rows.select("category", "ds", dbl(F.col("y")).alias("y"), "holiday", (F.date_diff("ds", "a") / F.col("days")).alias("tau"))


def _angle() -> Column:
    return F.lit(2 * math.pi) * F.unix_date("ds") / F.lit(YEAR)


def seasonal_moments(grid: DataFrame) -> DataFrame:
    """category, holiday, k = 0 … 20: sums over the observed days of cos kθ (c) and sin kθ (s), also times tau and times
    z = log(1 + y); tt and zz are the sums of squares, on k = 0."""
    k, tau, z = F.col("k"), F.col("tau"), F.log1p("y")
    rows = grid.where(F.col("y").isNotNull()).select(
        "category", "holiday", "tau", z.alias("z"), _angle().alias("angle"), F.explode(F.sequence(F.lit(0), F.lit(2 * FOURIER_ORDER))).alias("k")
    )
    c, s = F.cos(F.col("angle") * k), F.sin(F.col("angle") * k)
    waves = rows.withColumns({"c": c, "s": s})
    c, s, z = F.col("c"), F.col("s"), F.col("z")
    first = lambda v: F.sum(F.when(k == 0, v).otherwise(0.0))
    return waves.groupBy("category", "holiday", "k").agg(
        F.sum(c).alias("c"), F.sum(s).alias("s"), F.sum(tau * c).alias("tc"), F.sum(tau * s).alias("ts"),
        F.sum(z * c).alias("zc"), F.sum(z * s).alias("zs"), first(tau * tau).alias("tt"), first(z * z).alias("zz"),
    )


def gram_of(m: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, float, list[str]]:
    """Gram matrix, moments with z, sum of z² and holiday names from the moments of one category.

    Columns: 1, tau, sin 1 … K, cos 1 … K, holidays.
    """
    order, size = FOURIER_ORDER, 2 + 2 * FOURIER_ORDER
    all_ = m.groupby("k")[["c", "s", "tc", "ts", "zc", "zs", "tt", "zz"]].sum().sort_index()
    c, s = all_["c"].to_numpy(), all_["s"].to_numpy()
    i = np.arange(1, order + 1)
    plus, minus = i[:, None] + i[None, :], i[:, None] - i[None, :]
    sines, cosines = slice(2, 2 + order), slice(2 + order, size)
    names = sorted(m["holiday"].dropna().unique())
    gram = np.zeros((size + len(names),) * 2)
    gram[sines, sines] = (c[abs(minus)] - c[plus]) / 2
    gram[cosines, cosines] = (c[abs(minus)] + c[plus]) / 2
    gram[sines, cosines] = (s[plus] + np.sign(minus) * s[abs(minus)]) / 2
    gram[0, 0], gram[0, 1], gram[1, 1] = c[0], all_["tc"].iloc[0], all_["tt"].sum()
    gram[0, sines], gram[0, cosines] = s[i], c[i]
    gram[1, sines], gram[1, cosines] = all_["ts"].to_numpy()[i], all_["tc"].to_numpy()[i]
    moment = np.zeros(len(gram))
    moment[0], moment[1] = all_["zc"].iloc[0], 0.0
    moment[sines], moment[cosines] = all_["zs"].to_numpy()[i], all_["zc"].to_numpy()[i]
    for n, name in enumerate(names, size):
        mine = m[m["holiday"] == name].set_index("k").sort_index()
        gram[0, n] = gram[n, n] = mine["c"].iloc[0]
        gram[1, n] = mine["tc"].iloc[0]
        gram[sines, n], gram[cosines, n] = mine["s"].to_numpy()[i], mine["c"].to_numpy()[i]
        moment[n] = mine["zc"].iloc[0]
    upper = np.triu(gram)
    return upper + np.triu(gram, 1).T, moment, float(all_["zz"].sum()), names


def seasonal_models(grid: DataFrame) -> DataFrame:
    """category, trend, sines, cosines (arrays), marks (holiday → effect), sigma; one row per category.

    A category gathers at most 21 rows per holiday, whatever the length of its series.
    """
    # z times tau is the one product the harmonics do not hold
    trend = grid.where(F.col("y").isNotNull()).groupBy("category").agg(F.sum(F.col("tau") * F.log1p("y")).alias("zt"))
    fields = ["holiday", "k", "c", "s", "tc", "ts", "zc", "zs", "tt", "zz"]
    held = seasonal_moments(grid).groupBy("category").agg(F.collect_list(F.struct(*fields)).alias("moments")).join(trend, "category")

    def solve(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for row in part.itertuples(index=False):
                gram, moment, zz, names = gram_of(pd.DataFrame([tuple(x[f] for f in fields) for x in row.moments], columns=fields))
                moment[1] = row.zt
                size = 2 + 2 * FOURIER_ORDER
                ridge = np.diag([0.0] * 2 + [RIDGE_SEASON] * (size - 2) + [RIDGE_HOLIDAY] * len(names)) + RIDGE_ALL * np.eye(len(gram))
                beta = np.linalg.solve(gram + ridge, moment)
                n = gram[0, 0]
                mean = (moment[0] - gram[0] @ beta) / n
                spread = (zz - 2 * beta @ moment + beta @ gram @ beta) / n - mean * mean
                out.append((row.category, list(beta[:2]), list(beta[2 : 2 + FOURIER_ORDER]), list(beta[2 + FOURIER_ORDER : size]), dict(zip(names, beta[size:].tolist())), math.sqrt(max(spread, 0.0))))
            yield pd.DataFrame(out, columns=["category", "trend", "sines", "cosines", "marks", "sigma"])

    schema = "category string, trend array<double>, sines array<double>, cosines array<double>, marks map<string,double>, sigma double"
    return held.mapInPandas(solve, schema)


def seasonal_forecast(demand: DataFrame, holidays: DataFrame, horizon: int = 182) -> DataFrame:
    """History and ``horizon`` days ahead for every category, 80 % band, with the parts trend, yearly and holidays."""
    grid = materialize(demand.sparkSession, seasonal_grid(demand, holidays, horizon), "seasonal_grid")
    rows = grid.join(seasonal_models(grid), "category")
    waves = [F.col(name)[i - 1] * f(_angle() * i) for name, f in (("sines", F.sin), ("cosines", F.cos)) for i in range(1, FOURIER_ORDER + 1)]
    parts = rows.withColumns({
        "_level": F.col("trend")[0] + F.col("trend")[1] * F.col("tau"), "_yearly": sum(waves[1:], waves[0]),
        "_mark": F.coalesce(F.element_at("marks", F.col("holiday")), F.lit(0.0)),
    })
    mean = F.col("_level") + F.col("_yearly") + F.col("_mark")
    back = lambda v: F.greatest(F.expm1(v), F.lit(0.0))
    return parts.select(
        "category", "ds", "y", back(mean).alias("yhat"), back(mean - BAND_80 * F.col("sigma")).alias("yhat_lower"), back(mean + BAND_80 * F.col("sigma")).alias("yhat_upper"),
        back(F.col("_level")).alias("trend"), F.expm1("_yearly").alias("yearly"), F.expm1("_mark").alias("holidays"),
    )


def seasonal_summary(forecast: DataFrame) -> DataFrame:
    """Spread of the yearly factor and days with a holiday effect."""
    return forecast.groupBy("category").agg(
        count_big().alias("days"), F.round(F.min("yearly"), 4).alias("yearly_min"), F.round(F.avg("yearly"), 4).alias("yearly_mean"),
        F.round(F.max("yearly"), 4).alias("yearly_max"), F.count_if(F.col("holidays") != 0).alias("holiday_days"),
    )
