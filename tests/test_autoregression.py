import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.functions import series as sx
from ordermill.operators import autoregression as ar
from ordermill.operators import forecast as fc


def drawn(kind, n=300, seed=1):
    noise = np.random.default_rng(seed).normal(size=n)
    out = np.zeros(n)
    for t in range(n):
        if kind == "walk":
            out[t] = (out[t - 1] if t else 0) + noise[t]
        elif kind == "ar2":
            out[t] = 0.5 * (out[t - 1] if t else 0) + 0.3 * (out[t - 2] if t > 1 else 0) + noise[t]
        else:
            out[t] = noise[t]
    return out


SERIES = {"walk": drawn("walk"), "ar2": drawn("ar2"), "noise": drawn("noise"), "flat": np.full(120, 3.0), "short": np.array([1.0, 2.0])}


@pytest.fixture(scope="module")
def held(spark):
    return spark.createDataFrame([(k, v.tolist()) for k, v in SERIES.items()], "name string, v array<double>").cache()


def df_by_numpy(y):
    x, d = y[:-1], np.diff(y)
    design = np.column_stack([np.ones(len(x)), x])
    beta, *_ = np.linalg.lstsq(design, d, rcond=None)
    left = d - design @ beta
    covariance = left @ left / (len(x) - 2) * np.linalg.inv(design.T @ design)
    return beta[1] / math.sqrt(covariance[1, 1])


def yule_walker(y, p):
    c = y - y.mean()
    r = np.array([c[k:] @ c[: len(c) - k] / len(c) for k in range(p + 1)])
    if not p:
        return np.zeros(0), r[0]
    matrix = np.array([[r[abs(i - j)] for j in range(p)] for i in range(p)])
    phi = np.linalg.solve(matrix, r[1:])
    return phi, r[0] - phi @ r[1:]


def test_dickey_fuller_and_its_verdict(held):
    got = {r.name: r for r in held.select("name", sx.dickey_fuller(F.col("v")).alias("t"), sx.needs_differencing(F.col("v")).alias("d")).collect()}
    for name in ("walk", "ar2", "noise"):
        assert got[name].t == pytest.approx(df_by_numpy(SERIES[name]), rel=1e-9)
    assert got["walk"].d and not got["noise"].d
    assert got["flat"].t is None and not got["flat"].d and got["short"].t is None and not got["short"].d


@pytest.mark.parametrize("most", [1, 3, 14])
def test_all_orders_in_one_pass(held, most):
    fits = ar.levinson_durbin_of(sx.centred(F.col("v")), most)
    for row in held.where("name IN ('walk', 'ar2', 'noise')").select("name", fits.alias("fits")).collect():
        assert [f.order for f in row.fits] == list(range(most + 1))
        for fit in row.fits:
            phi, variance = yule_walker(SERIES[row.name], fit.order)
            assert fit.phi == pytest.approx(phi.tolist(), abs=1e-9) and fit.variance == pytest.approx(variance)


def chosen_by_numpy(y, most):
    best = None
    for p in range(most + 1):
        phi, variance = yule_walker(y, p)
        n, k = len(y), p + 1
        score = n * math.log(variance) + 2 * k + 2 * k * (k + 1) / (n - k - 1)
        if best is None or score < best[0]:
            best = score, p, phi, variance
    return best


def test_the_criterion_chooses_the_order(held):
    fits = ar.levinson_durbin_of(sx.centred(F.col("v")), 6)
    got = {r.name: r.best for r in held.select("name", sx.best_order(fits, F.size("v")).alias("best")).collect()}
    for name in ("walk", "ar2", "noise"):
        score, p, phi, _ = chosen_by_numpy(SERIES[name], 6)
        assert got[name].order == p and got[name].aicc == pytest.approx(score) and got[name].phi == pytest.approx(phi.tolist())
    assert got["ar2"].order >= 2 and got["flat"].order == 0


def test_forecasts_and_bounds_of_the_model(spark):
    plan = fc.ForecastPlan()
    level = np.exp(3 + 0.3 * drawn("ar2", 200, 5)) - 1
    walk = np.exp(5 + 0.1 * drawn("walk", 200, 6)) - 1
    rows = [("a", level.tolist(), 200, 1e9), ("b", walk.tolist(), 200, 1e9), ("c", [1.0] * 20, 20, 1e9)]
    profile = spark.createDataFrame(rows, "restaurant_id string, values array<double>, n_obs_used int, capacity_cap double")
    got = {r.restaurant_id: r for r in ar.autoregression(5)(profile, plan).collect()}
    for name, values, differenced in (("a", level, 0), ("b", walk, 1)):
        y = np.log1p(values)
        z = np.diff(y) if differenced else y
        _, p, phi, variance = chosen_by_numpy(z, 5)
        assert got[name].model_order == f"({p},{differenced},0)"
        c = list(z - z.mean())
        psi = [1.0]
        for h in range(plan.horizon):
            c.append(sum(phi[j] * c[-1 - j] for j in range(p)))
            psi.append(sum(phi[j] * psi[-1 - j] for j in range(min(p, len(psi)))))
        ahead = np.array(c[len(z) :]) + z.mean()
        weights = np.array(psi[: plan.horizon])
        if differenced:
            ahead, weights = y[-1] + np.cumsum(ahead), np.cumsum(weights)
        reach = plan.interval_z * np.sqrt(variance * np.cumsum(weights**2))
        assert [d.predicted_revenue for d in got[name].future] == pytest.approx(np.expm1(ahead).tolist())
        assert [d.lower_ci for d in got[name].future] == pytest.approx(np.expm1(ahead - reach).tolist())
        assert [d.upper_ci for d in got[name].future] == pytest.approx(np.expm1(ahead + reach).tolist())
        centred = z - z.mean()
        wanted = [centred[t] - sum(phi[j] * centred[t - 1 - j] for j in range(p)) for t in range(p, len(z))]
        assert got[name].residuals == pytest.approx(wanted, abs=1e-9) and len(got[name].holdout) == plan.holdout
    assert got["c"].future is None and got["c"].holdout is None


def performance(spark, days=140):
    rows = [(f"V{v}", k, 100.0 + 10 * v + 20 * (k % 7) + (k * 7919 % 13)) for v in range(4) for k in range(days)]
    frame = spark.createDataFrame(rows, "restaurant_id string, k int, daily_revenue double")
    return frame.select("restaurant_id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("k")).alias("activity_date"), "daily_revenue")


def test_the_autoregression_runs_the_whole_forecast_without_python(spark):
    mixed = fc.forecast(performance(spark), as_of="2024-06-01", fitter=ar.autoregression(8))
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    rows, notes = fc.forecast_rows(mixed).collect(), fc.diagnostics_rows(mixed).collect()
    assert len(rows) == 4 * 14 and len(notes) == 4 and all(math.isfinite(r.aicc) for r in notes)


def test_an_entity_that_raises_keeps_to_itself(spark):
    def model(values, plan):
        if 119 < values[0] < 121:
            raise ArithmeticError("no fit")
        if 129 < values[0] < 131:
            return {"model_order": "m", "model_seasonal_order": "s", "aic": 1, "aicc": 2, "holdout": [1.0], "residuals": [], "future": []}
        week = values[-7:]
        return {
            "model_order": "repeat", "model_seasonal_order": 7, "aic": 1, "aicc": 2, "holdout": np.tile(values[-21:-14], 2),
            "residuals": values[7:] - values[:-7], "future": [(x, x - 1, x + 1) for x in np.tile(week, 2)],
        }

    short = performance(spark, 30).withColumn("restaurant_id", F.concat(F.lit("S"), "restaurant_id")).where("restaurant_id = 'SV0'")
    mixed = fc.forecast(performance(spark).unionByName(short), as_of="2024-06-01", fitter=ar.grouped_fitter(model))
    notes = {r.restaurant_id: r for r in fc.diagnostics_rows(mixed).collect()}
    assert notes["V2"].status == "FAILED (ArithmeticError: no fit)" and notes["V3"].status.startswith("FAILED (ValueError: holdout has 1 days")
    assert notes["V0"].status.startswith("OK") and notes["V1"].sarima_order == "repeat" and "SKIPPED" in notes["SV0"].status
    assert {r.restaurant_id for r in fc.forecast_rows(mixed).collect()} == {"V0", "V1"}
