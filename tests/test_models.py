"""Regression and seasonal fits against numpy and known signals."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from storeops.functions.ols import two_sided_p
from storeops.operators import forecast as fc, seasonal


def _weekly(spark):
    rng = np.random.default_rng(4)
    rows = []
    for ci, c in enumerate(["A", "B", "C"]):
        for w in range(60):
            day = dt.date(2018, 1, 1) + dt.timedelta(weeks=w)
            q = (day.month - 1) // 3
            rows.append((c, day, int(round(np.exp(3 + ci * 0.4 + 0.1 * q + 0.004 * w + rng.normal(0, 0.1))))))
    return spark.createDataFrame(rows, "category string, week_start date, qty bigint"), rows


def _design(rows):
    """The regression of ``_weekly`` in full: first category as intercept, the others against it, quarters, week."""
    y = np.log1p([r[2] for r in rows])
    t = np.array([(r[1] - dt.date(2018, 1, 1)).days // 7 for r in rows])
    quarter = np.array([(r[1].month - 1) // 3 for r in rows])
    cat = np.array([r[0] for r in rows])
    x = np.column_stack([np.ones(len(y)), cat == "B", cat == "C", quarter == 1, quarter == 2, quarter == 3, t]).astype(float)
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    rss = float(((y - x @ beta) ** 2).sum())
    return x, y, beta, rss, np.linalg.inv(x.T @ x) * rss / (len(y) - x.shape[1])


def test_regression_equals_numpy_least_squares(spark):
    df, rows = _weekly(spark)
    fit = fc.fit_weekly(fc.weekly_features(df))
    x, y, beta, rss, cov = _design(rows)
    names = ["Intercept", "category=B", "category=C", "quarter=2", "quarter=3", "quarter=4", "t"]
    terms = {r.term: r for r in fit.terms().collect()}
    assert sorted(terms) == sorted(names)
    assert np.allclose([terms[m].coefficient for m in names], beta, atol=1e-8)
    assert np.allclose([terms[m].se for m in names], np.sqrt(np.diag(cov)), atol=1e-9)
    assert fit.r2 == pytest.approx(1 - rss / ((y - y.mean()) ** 2).sum(), abs=1e-9)
    n, k = x.shape
    ll = -n / 2 * (np.log(2 * np.pi) + np.log(rss / n) + 1)
    assert (fit.n, fit.parameters) == (n, k)
    assert fit.aic == pytest.approx(2 * k - 2 * ll) and fit.bic == pytest.approx(np.log(n) * k - 2 * ll)


def test_regression_with_a_missing_quarter_and_a_single_week(spark):
    """Regressors the data cannot tell apart get no coefficient of their own; a category of one week only moves its level."""
    df, rows = _weekly(spark)
    kept = [r for r in rows if r[1].month > 3] + [("Z", dt.date(2018, 5, 7), 9)]
    fit = fc.fit_weekly(fc.weekly_features(spark.createDataFrame(kept, df.schema)))
    assert fit.parameters == 4 + 2 + 1  # levels, two of three quarters, trend
    y = np.log1p([r[2] for r in kept])
    x = np.column_stack([[r[0] == c for r in kept] for c in "ABCZ"] + [[(r[1].month - 1) // 3 == q for r in kept] for q in (2, 3)] + [[r[1].toordinal() for r in kept]]).astype(float)
    rss = float(((y - x @ np.linalg.lstsq(x, y, rcond=None)[0]) ** 2).sum())
    assert fit.sigma2 == pytest.approx(rss / (len(y) - 7), rel=1e-6)


def test_weekly_forecast_matches_direct_scoring(spark):
    df, rows = _weekly(spark)
    features = fc.weekly_features(df)
    fit = fc.fit_weekly(features)
    _, _, beta, _, cov = _design(rows)
    got = fc.weekly_forecast(features, fit).where("category = 'B' AND week_ahead = 5").first()
    day = dt.date(2018, 1, 1) + dt.timedelta(weeks=64)
    x = np.array([1, 1, 0, *[float((day.month - 1) // 3 == i) for i in (1, 2, 3)], 64.0])
    mean, se = x @ beta, np.sqrt(x @ cov @ x)
    assert got.mean == round(float(np.expm1(mean)), 1) and got.high == round(float(np.expm1(mean + 1.96 * se)), 1)
    assert fc.weekly_forecast(features, fit).count() == 78


def test_forecast_needs_no_join_and_no_list_of_categories(spark):
    features = fc.weekly_features(_weekly(spark)[0])
    plan = fc.weekly_forecast(features, fc.fit_weekly(features))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and " IN " not in plan


@pytest.mark.parametrize("t,df,p", [(2.228, 10, 0.05), (1.96, 100000, 0.05), (2.576, 100000, 0.01), (0.0, 5, 1.0), (12.706, 1, 0.05), (3.169, 10, 0.01)])
def test_student_t_tail(t, df, p):
    assert float(two_sided_p(np.array([t]), df)[0]) == pytest.approx(p, rel=2e-3)


def _daily(spark, days=1000):
    stamps = pd.date_range("2018-01-01", periods=days + 180)
    angle = 2 * np.pi * (stamps - pd.Timestamp("1970-01-01")).days / 365.25
    rng = np.random.default_rng(9)
    rows, truth = [], {}
    for c, level in (("A", 100), ("B", 40)):
        truth[c] = np.expm1(np.log(level) + 0.3 * np.sin(angle) + (0.1 if c == "B" else 0) * np.cos(2 * angle))
        rows += [(c, d.date(), float(y * np.exp(rng.normal(0, 0.02)))) for d, y in zip(stamps[:days], truth[c])]
    marks = [(dt.date(2018 + i, 12, 25), "Christmas") for i in range(3)] + [(dt.date(2018 + i, 5, 1), "May") for i in range(3)]
    return spark.createDataFrame(rows, "category string, ds date, y double"), spark.createDataFrame(marks, "day date, holiday string"), truth


def test_seasonal_fit_recovers_yearly_shape(spark):
    demand, marks, truth = _daily(spark)
    out = seasonal.seasonal_forecast(demand, marks, 180).toPandas().sort_values(["category", "ds"])
    for c, part in out.groupby("category"):
        ahead = part[part["y"].isna()]
        assert len(ahead) == 180
        assert np.abs(ahead["yhat"].to_numpy() / truth[c][1000:] - 1).max() < 0.05
    assert (out["yhat_lower"] <= out["yhat"]).all() and (out["yhat"] <= out["yhat_upper"]).all()


def test_moments_hold_the_whole_gram_matrix(spark):
    """The solution equals a ridge regression on gathered design rows."""
    demand, marks, _ = _daily(spark, 500)
    grid = seasonal.seasonal_grid(demand, marks, 30).where("category = 'B'")
    got = seasonal.seasonal_models(grid).first()
    rows = grid.where("y is not null").toPandas().sort_values("ds")
    angle = 2 * np.pi * np.array([d.toordinal() - dt.date(1970, 1, 1).toordinal() for d in rows["ds"]])[:, None] / 365.25 * np.arange(1, 11)[None, :]
    names = ["Christmas", "May"]
    x = np.hstack([np.ones((len(rows), 1)), rows[["tau"]], np.sin(angle), np.cos(angle), np.column_stack([rows["holiday"] == h for h in names])]).astype(float)
    z = np.log1p(rows["y"].to_numpy())
    beta = np.linalg.solve(x.T @ x + np.diag([0] * 2 + [0.1] * 20 + [1.0] * 2) + 1e-9 * np.eye(24), x.T @ z)
    assert np.allclose([*got.trend, *got.sines, *got.cosines, *[got.marks[h] for h in names]], beta, atol=1e-7)
    assert got.sigma == pytest.approx(np.std(z - x @ beta), abs=1e-8)


def test_seasonal_fit_gathers_no_series(spark):
    """What a category gathers does not grow with its days."""
    demand, marks, _ = _daily(spark, 400)
    for days in (200, 400):
        part = demand.where(F.col("ds") < F.lit(dt.date(2018, 1, 1) + dt.timedelta(days=days)))
        moments = seasonal.seasonal_moments(seasonal.seasonal_grid(part, marks))
        assert moments.groupBy("category").count().agg(F.max("count")).first()[0] <= 21 * 3
    plan = seasonal.seasonal_forecast(demand, marks)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroups" not in plan


def test_rare_categories_are_summed_again(spark):
    d = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("A", d, 1), ("X", d, 2), ("Y", d, 3)], "category string, ds date, y bigint")
    assert sorted((r.category, r.y) for r in fc.group_rare(df, ["A"]).collect()) == [("A", 1), ("OTHER", 5)]


def test_zero_fill_crosses_the_year(spark):
    df = spark.createDataFrame([("A", dt.date(2019, 11, 1), 5), ("A", dt.date(2020, 2, 1), 7)], "category string, month date, qty bigint")
    assert [r.qty for r in fc.zero_filled_months(df).orderBy("month").collect()] == [5, 0, 0, 7]


def test_week_at_new_year_stays_whole(spark):
    sales = spark.createDataFrame([(1, dt.date(2018, 12, 31), 2, 10.0), (1, dt.date(2019, 1, 1), 3, 10.0)], "product_id int, sale_date date, qty int, net double")
    products = spark.createDataFrame([(1, "A")], "product_id int, category string")
    out = fc.weekly_sales(sales.withColumn("net", F.col("net").cast("decimal(12,2)")), products).collect()
    assert [(r.year_week, r.qty) for r in out] == [(201901, 5)]
