import numpy as np
import pytest

from panelkit import operators as op
from panelkit.plans import gold
from tests.conftest import rows


def series(frame, **groups):
    data = [(k, 2000 + i, None if v is None else float(v)) for k, vs in groups.items() for i, v in enumerate(vs)]
    return frame("k STRING, year INT, v DOUBLE", *data)


def test_fit_matches_numpy(frame):
    noise = np.random.default_rng(1).normal(0, 5, 12)
    y = 100 + 3 * np.arange(12) + noise
    found = op.fit_ols(series(frame, a=y), ["k"], "year", "v").collect()[0]
    x = np.arange(2000, 2012)
    slope, intercept = np.polyfit(x - 2000, y, 1)
    residuals = y - (intercept + slope * (x - 2000))
    r2 = round(1 - (residuals**2).sum() / ((y - y.mean()) ** 2).sum(), 4)
    assert found["n_observations"] == 12
    assert found["slope"] == pytest.approx(slope)
    assert found["intercept"] == pytest.approx(intercept - 2000 * slope)
    assert found["r_squared"] == r2
    assert found["r_squared_adjusted"] == round(1 - (1 - r2) * 11 / 10, 4)
    assert found["standard_error"] == round(float(np.sqrt((residuals**2).sum() / 10)), 2)


def test_too_short_and_constant_series_have_no_fit(frame):
    df = series(frame, seven=range(7), eight=range(8), constant=[5] * 10, holes=[1, 2, None, 4, 5, 6, 7, None, 3, 9])
    assert rows(op.fit_ols(df, ["k"], "year", "v").select("k", "n_observations"), "k") == [("eight", 8), ("holes", 8)]


def test_large_values_on_a_line_leave_no_residual(frame):
    fit = op.fit_ols(series(frame, a=[10**12 + 10**7 * i for i in range(10)]), ["k"], "year", "v").collect()[0]
    assert (fit["r_squared"], fit["standard_error"]) == (1.0, 0.0)


def test_one_shuffle_and_one_aggregation(frame):
    plan = op.fit_ols(series(frame, a=range(9)), ["k"], "year", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "Join" not in plan


def test_small_residuals_of_large_values(frame):
    noise = np.random.default_rng(4).integers(0, 9, 30)
    fit = op.fit_ols(series(frame, a=10**12 + 10**7 * np.arange(30) + noise), ["k"], "year", "v").collect()[0]
    x = np.arange(30)
    line = np.polyfit(x, noise, 1)
    assert fit["standard_error"] == round(float(np.sqrt(((noise - np.polyval(line, x)) ** 2).sum() / 28)), 2)
    assert fit["slope"] == pytest.approx(10**7 + line[0], abs=1e-6)


def test_forecast_starts_at_each_series_own_end(frame):
    df = frame(
        "k STRING, year INT, a BIGINT, b DOUBLE",
        *[("up", 2000 + i, 10 * i, None) for i in range(9)],
        *[("down", 1990 + i, 80 - 10 * i, 1.5 * i) for i in range(9)],
    )
    found = op.trend_forecast(df, "k", "year", ["a", "b"])
    columns = ["k", "variable_name", "last_observed_year", "forecast_year", "predicted_value", "predicted_lower_95",
               "predicted_upper_95", "slope"]
    assert rows(found.select(*columns), "k", "variable_name") == [
        ("down", "a", 1998, 1999, 0.0, 0.0, -10.0, -10.0),
        ("down", "b", 1998, 1999, 13.5, 13.5, 13.5, 1.5),
        ("up", "a", 2008, 2009, 90.0, 90.0, 90.0, 10.0),
    ]


def brute_backtest(values, holdout=3):
    x = np.arange(len(values)) + 2000
    y = np.array(values, float)
    train = x <= x.max() - holdout
    slope, intercept = np.polyfit(x[train] - 2000, y[train], 1)
    pred = np.maximum(0, intercept + slope * (x - 2000))[~train]
    naive = np.maximum(0, 2 * y[:-1][1:] - y[:-2])[-holdout:]
    test = y[~train]
    err, err0 = abs(test - pred), abs(test - naive)
    big = abs(test) >= 1
    mape = (err[big] * 100 / abs(test[big])).mean() if big.any() else None
    return round(err.mean(), 2), None if mape is None else round(mape, 2), round(err0.mean(), 2)


def test_backtest_matches_brute_force(frame):
    rng = np.random.default_rng(2)
    groups = {f"g{i}": np.round(np.maximum(0, 50 + 5 * i * np.arange(12) + rng.normal(0, 30, 12)), 3) for i in range(6)}
    groups["zeros"] = [5, 4, 6, 5, 4, 6, 5, 0, 0, 0]
    found = op.backtest(series(frame, **groups), "k", "year", ["v"]).collect()
    assert len(found) == len(groups)
    for r in found:
        mae, mape, naive = brute_backtest(groups[r["k"]])
        assert r["n_test_points"] == 3 and r["n_train_observations"] == len(groups[r["k"]]) - 3
        assert r["regression_mae"] == pytest.approx(mae, abs=0.011)
        assert r["naive_mae"] == pytest.approx(naive, abs=0.011)
        assert (r["regression_mape"] is None) == (mape is None)
        assert r["beats_naive"] == (r["improvement_pct"] is not None and r["improvement_pct"] > 0)


def found_in(frame):
    return op.backtest(series(frame, line=range(10)), "k", "year", ["v"])


def test_series_with_two_rows_a_year_are_an_error(frame):
    df = series(frame, k=[1, 5, 2, 8, 3, 9, 1, 4, 6])
    with pytest.raises(Exception, match="several rows per year"):
        op.fit_ols(df.union(df), ["k"], "year", "v").collect()


def test_backtest_without_naive_error_has_no_improvement(frame):
    found = op.backtest(series(frame, line=range(10)), "k", "year", ["v"]).collect()[0]
    assert found["naive_mae"] == 0 and found["improvement_pct"] is None and found["beats_naive"] is False
    summary = op.summarise(found_in(frame), ["variable_name"], gold.VALIDATION_SUMMARY).collect()[0]
    assert (summary["entities"], summary["wins"], summary["win_rate_pct"]) == (1, 0, 0.0)


def test_backtest_needs_five_training_points(frame):
    df = series(frame, short=[1, 5, 2, 8, 3, 9, 1], enough=[1, 5, 2, 8, 3, 9, 1, 7])
    assert [r["k"] for r in op.backtest(df, "k", "year", ["v"]).collect()] == ["enough"]
