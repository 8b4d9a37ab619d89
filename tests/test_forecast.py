import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.functions import series as ts
from ordermill.functions.calendar import days_between
from ordermill.operators import forecast as fc

START = dt.date(2024, 1, 1)  # a Monday
PERF = "restaurant_id string, activity_date date, daily_revenue double"


def perf(spark, **series):
    rows = [
        (name, START + dt.timedelta(days=i), float(v)) for name, values in series.items() for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, PERF)


def weekly(n, noise=0.02, seed=1):
    rng = np.random.default_rng(seed)
    pattern = np.array([100, 110, 120, 150, 250, 180, 90.0])
    return [float(pattern[i % 7] * (1 + 0.001 * i) * math.exp(noise * rng.standard_normal())) for i in range(n)]


def white(n, seed=2):
    rng = np.random.default_rng(seed)
    return list(np.exp(5 + 0.5 * rng.standard_normal(n)))


def one(spark, expression, **columns):
    row = spark.createDataFrame([tuple(columns.values())], list(columns))
    return row.select(expression.alias("x")).first().x


def test_days_between_is_dense_and_never_runs_backwards(spark):
    bounds = spark.createDataFrame([("a", START), ("b", dt.date(2030, 1, 1))], "k string, first date")
    rows = days_between(bounds, "first", F.lit("2024-01-05").cast("date"), "day").collect()
    assert [r.day.day for r in rows] == [1, 2, 3, 4, 5]


def test_gaps_become_zero_and_doubles_add_up(spark):
    df = perf(spark, a=[1, 2, 3]).filter("activity_date <> DATE'2024-01-02'").unionByName(perf(spark, a=[10]))
    rows = fc.regular_series(df).orderBy("activity_date").collect()
    assert [r.daily_revenue for r in rows] == [11.0, 0.0, 3.0]


def test_history_gate_at_the_limit(spark):
    profile = fc.series_profile(fc.regular_series(perf(spark, short=[1] * 89, enough=[1] * 90)))
    status = {r.restaurant_id: r.status for r in fc.history_gate(profile).collect()}
    assert status == {"short": "SKIPPED_INSUFFICIENT_HISTORY (n=89 < 90)", "enough": "FITTED"}


def test_naive_tiles_the_last_week(spark):
    values = [float(i) for i in range(10)]
    got = one(spark, ts.repeat_last_season(F.col("v"), 14), v=values)
    assert got == [3, 4, 5, 6, 7, 8, 9] * 2


@pytest.mark.parametrize(
    "forecast, actual, expected", [([1.0, 3.0], [2.0, 2.0], 50.0), ([1.0, 1.0], [0.0, 0.0], None), ([2.0, 2.0], [2.0, 2.0], 0.0)]
)
def test_wape(spark, forecast, actual, expected):
    assert one(spark, ts.wape(F.col("f"), F.col("a")), f=forecast, a=actual) == expected


def test_skill(spark):
    assert one(spark, ts.skill(F.col("m"), F.col("n")), m=5.0, n=10.0) == 50.0
    assert one(spark, ts.skill(F.col("m"), F.col("n")), m=5.0, n=0.0) is None


def test_aicc(spark):
    assert one(spark, ts.aicc(F.col("a"), F.col("n"), F.col("k")), a=10.0, n=20, k=3) == pytest.approx(10 + 24 / 16)
    assert one(spark, ts.aicc(F.col("a"), F.col("n"), F.col("k")), a=10.0, n=4, k=3) == math.inf


def test_chi_square_tail_at_a_known_quantile(spark):
    assert one(spark, ts.chi_square_tail(F.col("x"), 10), x=18.307) == pytest.approx(0.05, abs=1e-5)
    with pytest.raises(ValueError):
        ts.chi_square_tail(F.col("x"), 3)


def test_ljung_box_against_numpy(spark):
    x = np.random.default_rng(5).standard_normal(200)
    c = x - x.mean()
    acf = [np.sum(c[k:] * c[:-k]) / np.sum(c * c) for k in range(1, 11)]
    q = 200 * 202 * sum(r * r / (200 - k) for k, r in enumerate(acf, 1))
    tail = math.exp(-q / 2) * sum((q / 2) ** j / math.factorial(j) for j in range(5))
    assert one(spark, ts.ljung_box_pvalue(F.col("x")), x=[float(v) for v in x]) == pytest.approx(tail)
    assert one(spark, ts.ljung_box_pvalue(F.col("x")), x=[1.0] * 100) is None


def test_median_fallback(spark):
    values = [float(i % 7) for i in range(98)]
    profile = fc.series_profile(fc.regular_series(perf(spark, a=values)))
    rows = fc.median_forecast(profile).orderBy("forecast_date").collect()
    assert len(rows) == 14 and rows[0].forecast_date == START + dt.timedelta(days=98)
    assert [r.predicted_revenue for r in rows[:7]] == [0, 1, 2, 3, 4, 5, 6]
    assert all(r.lower_ci == r.predicted_revenue == r.upper_ci for r in rows)


def test_cap_limits_point_and_upper_bound(spark):
    values = [1.0] * 90 + [1.0, 1000.0] * 15
    profile = fc.series_profile(fc.regular_series(perf(spark, a=values))).withColumn("capacity_cap", F.lit(2.0))
    rows = fc.median_forecast(profile).collect()
    assert all(r.predicted_revenue <= 2 and r.upper_ci <= 2 and r.lower_ci >= 0 for r in rows)


@pytest.fixture(scope="module")
def mixed(spark):
    data = perf(
        spark, strong=weekly(200), noise=white(200), flat=[50.0] * 120, zeros=[0.0] * 120, short=[5.0] * 89,
        empty_end=[*weekly(120), *[0.0] * 14],
    )
    return fc.forecast(data, as_of="2024-08-01").collect()


def diagnostics(mixed):
    return {r.restaurant_id: r for r in mixed if r.record_type == "diagnostics"}


def test_every_entity_has_one_diagnostics_row_and_fitted_ones_14_days(mixed):
    assert len(diagnostics(mixed)) == len([r for r in mixed if r.record_type == "diagnostics"]) == 6
    for name, row in diagnostics(mixed).items():
        days = [r for r in mixed if r.record_type == "forecast" and r.restaurant_id == name]
        assert len(days) == (0 if row.status.startswith(("SKIPPED", "FIT_FAILED")) else 14), name


def test_a_weekly_pattern_is_modelled_better_than_naive(mixed):
    row = diagnostics(mixed)["strong"]
    assert row.skill_vs_naive_pct > 0 and row.holdout_mape_pct < 6
    days = sorted((r for r in mixed if r.restaurant_id == "strong" and r.record_type == "forecast"), key=lambda r: r.forecast_date)
    peak = max(days[:7], key=lambda r: r.predicted_revenue)
    assert peak.forecast_date.weekday() == 4
    assert all(0 <= r.lower_ci <= r.predicted_revenue <= r.upper_ci for r in days)


def test_degenerate_series_fall_back(mixed):
    d = diagnostics(mixed)
    assert d["flat"].status == "OK_FALLBACK_SEASONAL_MEDIAN" and d["flat"].naive_wape_pct == 0.0
    assert d["empty_end"].holdout_mape_pct is None and d["empty_end"].status == "OK_FALLBACK_SEASONAL_MEDIAN"
    assert d["short"].status.startswith("SKIPPED_INSUFFICIENT_HISTORY") and d["short"].n_obs_used == 89
    assert d["zeros"].status == "OK_FALLBACK_SEASONAL_MEDIAN"
    flat = [r.predicted_revenue for r in mixed if r.restaurant_id == "flat" and r.record_type == "forecast"]
    assert flat == [50.0] * 14


def test_status_follows_residuals_and_skill(mixed):
    for row in diagnostics(mixed).values():
        if row.status in ("OK", "OK_FALLBACK_SEASONAL_MEDIAN"):
            good = row.residuals_pass == "PASS" and (row.skill_vs_naive_pct or 0) > 0
            assert (row.status == "OK") == good


def test_a_failing_fit_is_reported_and_does_not_stop_the_rest(spark):
    def picky(profile, plan):
        fits = fc.weekly_models(profile, plan)
        odd = F.col("restaurant_id") == "odd"
        return fits.withColumns(
            {"future": F.when(~odd, F.col("future")), "fit_error": F.when(odd, F.lit("FIT_FAILED: no"))}
        )

    rows = fc.forecast(perf(spark, odd=weekly(120), fine=weekly(120)), as_of="2024-08-01", fitter=picky).collect()
    assert diagnostics(rows)["odd"].status == "FIT_FAILED: no" and diagnostics(rows)["odd"].aicc is None
    assert len([r for r in rows if r.record_type == "forecast"]) == 14


def test_lag_line_against_numpy(spark):
    values = weekly(120, noise=0.3)
    line = one(spark, ts.lag_line(F.col("v")), v=values)
    slope, offset = np.polyfit(values[:-7], values[7:], 1)
    assert line.slope == pytest.approx(slope) and line.offset == pytest.approx(offset)
    got = one(spark, ts.lag_forecast(F.col("v"), ts.lag_line(F.col("v")), 14), v=values)
    first = [offset + slope * x for x in values[-7:]]
    assert got == pytest.approx(first + [offset + slope * x for x in first])
    errors = one(spark, ts.lag_residuals(F.col("v"), ts.lag_line(F.col("v"))), v=values)
    assert errors == pytest.approx([y - offset - slope * x for x, y in zip(values, values[7:])])


def test_season_means_and_their_errors(spark):
    values = weekly(60, noise=0.3)
    got = one(spark, ts.season_means(F.col("v"), 14), v=values)
    assert got == pytest.approx([np.mean([values[60 + h % 7 - 7 * w] for w in range(1, 5)]) for h in range(14)])
    errors = one(spark, ts.season_mean_residuals(F.col("v")), v=values)
    assert errors == pytest.approx([values[t] - np.mean([values[t - 7 * w] for w in range(1, 5)]) for t in range(28, 60)])


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0, 1.0, 3.0], [4.0, 4.0, 4.0, 10.0]])
def test_median_and_deviation(spark, values):
    assert one(spark, ts.median(F.col("v")), v=values) == np.median(values)
    wanted = np.std(values, ddof=1) if len(values) > 1 else 0.0
    assert one(spark, ts.deviation(F.col("v")), v=values) == pytest.approx(wanted)


def test_fallback_days_equal_the_median_forecast(spark, mixed):
    data = perf(spark, flat=[50.0] * 120, noise=white(200))
    table = {(r.restaurant_id, r.forecast_date): r for r in fc.median_forecast(fc.series_profile(fc.regular_series(data))).collect()}
    fallen = [r for r in mixed if r.record_type == "forecast" and r.status == "OK_FALLBACK_SEASONAL_MEDIAN" and (r.restaurant_id, r.forecast_date) in table]
    assert fallen
    for r in fallen:
        want = table[r.restaurant_id, r.forecast_date]
        for column in ("predicted_revenue", "lower_ci", "upper_ci"):
            assert r[column] == pytest.approx(want[column])


def test_latest_diagnostics_takes_the_newest_run(spark):
    log = spark.createDataFrame(
        [("a", "2024-01-01", 1), ("a", "2024-02-01", 2), ("b", "2024-01-01", 3)], "restaurant_id string, model_run_date string, n int"
    )
    assert {r.restaurant_id: r.n for r in fc.latest_diagnostics(log).collect()} == {"a": 2, "b": 3}


def test_a_plan_with_too_little_history_is_refused():
    with pytest.raises(ValueError):
        fc.ForecastPlan(min_history=20)
