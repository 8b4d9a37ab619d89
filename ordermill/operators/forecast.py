"""Per-entity daily forecasts: a weekly model where it earns its keep, a weekday median elsewhere.

Everything is DataFrame code over one row per entity that holds its daily values as an array: two
candidate models, their error on a holdout against a seasonal benchmark, the residual test, the
fallback and the rows. A caller may supply another fitter in place of the two candidates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.calendar import DateLike, as_of_date
from ordermill.functions.numbers import choose
from ordermill.functions.series import (
    aicc,
    all_but_last,
    deviation,
    lag_forecast,
    lag_line,
    lag_residuals,
    last,
    ljung_box_pvalue,
    median,
    repeat_last_season,
    season_mean_residuals,
    season_means,
    skill,
    total,
    wape,
)

# What the forecast table calls a row that the model made, and one that the fallback made.
MODEL_LABEL, FALLBACK_LABEL = "WEEKLY_MODEL", "SEASONAL_MEDIAN_FALLBACK"


@dataclass(frozen=True)
class ForecastPlan:
    """What to forecast and the fixed choices of the method."""

    entity: str = "restaurant_id"
    date: str = "activity_date"
    value: str = "daily_revenue"
    horizon: int = 14
    holdout: int = 14
    season: int = 7
    min_history: int = 90
    cap_quantile: float = 0.99
    cap_factor: float = 1.25
    interval_z: float = 1.2815515655446004  # two-sided 80 %
    fallback_days: int = 28
    fallback_z: float = 1.28
    residual_level: float = 0.05
    lags: int = 10
    mean_weeks: int = 4
    regressor_weekdays: Sequence[int] = (3, 4)  # Thursday and Friday, Monday being 0
    fit_tasks: int | None = None  # tasks for the work per entity; default: the session's shuffle partitions

    def __post_init__(self):
        if self.min_history < max(5 * self.lags, 4 * self.season + self.holdout):
            raise ValueError("min_history is too short for the residual test and the holdout")


def regular_series(perf: DataFrame, plan: ForecastPlan = ForecastPlan(), tasks: int | None = None) -> DataFrame:
    """One row per entity and day between its first and last day; days without rows are 0.

    Rows of one day are added up, in the type they come in, before anything is grouped by entity, so
    the window sees at most one row per calendar day and entity. Each row then fills the days up to
    the next one: no calendar to join and a single read of the input. `tasks` fixes the number of
    partitions, which are by entity either way.
    """
    daily = perf.groupBy(plan.entity, plan.date).agg(F.sum(plan.value).cast("double").alias(plan.value))
    if tasks is not None:
        daily = daily.repartition(tasks, plan.entity)
    following = F.lead(plan.date).over(Window.partitionBy(plan.entity).orderBy(plan.date))
    until = F.coalesce(F.date_sub(following, 1), F.col(plan.date))
    filled = daily.withColumn("_until", until).select(
        plan.entity, plan.value, F.posexplode(F.sequence(plan.date, "_until")).alias("_gap", plan.date)
    )
    value = F.when(F.col("_gap") == 0, F.coalesce(plan.value, F.lit(0.0))).otherwise(0.0)
    return filled.select(plan.entity, plan.date, value.alias(plan.value))


def series_profile(series: DataFrame, plan: ForecastPlan = ForecastPlan()) -> DataFrame:
    """One row per entity: length, last day, capacity cap and the values in date order."""
    by_day = F.array_sort(F.collect_list(F.struct(plan.date, plan.value)))
    ceiling = F.percentile(plan.value, F.lit(plan.cap_quantile)) * plan.cap_factor
    return series.groupBy(plan.entity).agg(
        F.count(F.lit(1)).cast("int").alias("n_obs_used"),
        F.max(plan.date).alias("last_date"),
        ceiling.alias("capacity_cap"),
        F.transform(by_day, lambda x: x[plan.value]).alias("values"),
    )


def has_history(plan: ForecastPlan = ForecastPlan()) -> Column:
    return F.col("n_obs_used") >= plan.min_history


# The texts of a status.
def skipped_status(plan: ForecastPlan = ForecastPlan()) -> Column:
    return F.format_string(f"SKIPPED_INSUFFICIENT_HISTORY (n=%d < {plan.min_history})", "n_obs_used")


def history_gate(profile: DataFrame, plan: ForecastPlan = ForecastPlan()) -> DataFrame:
    status = F.when(has_history(plan), "FITTED").otherwise(skipped_status(plan))
    return profile.select(plan.entity, "n_obs_used", status.alias("status"))


def calendar_features(series: DataFrame, plan: ForecastPlan = ForecastPlan()) -> DataFrame:
    """A model's inputs per day: log value, weekday regressors, holdout flag."""
    last_day = F.max(plan.date).over(Window.partitionBy(plan.entity))
    weekday = F.weekday(plan.date)
    flags = {f"is_weekday_{k}": (weekday == k).cast("int") for k in plan.regressor_weekdays}
    return series.withColumns(
        {
            "log_value": F.log1p(plan.value),
            **flags,
            "is_holdout": F.col(plan.date) > F.date_sub(last_day, plan.holdout),
        }
    )


def naive_forecast(profile: DataFrame, plan: ForecastPlan = ForecastPlan()) -> DataFrame:
    """Benchmark rows over the holdout: the last training season, repeated, next to the actuals."""
    values = F.col("values")
    paired = F.arrays_zip(
        repeat_last_season(all_but_last(values, plan.holdout), plan.holdout, plan.season).alias("naive"),
        last(values, plan.holdout).alias("actual"),
    )
    return profile.filter(has_history(plan)).select(
        plan.entity, "last_date", F.posexplode(paired).alias("step", "pair")
    ).select(
        plan.entity,
        F.date_add("last_date", F.col("step") - plan.holdout + 1).alias(plan.date),
        F.col("pair.naive").alias("naive"),
        F.col("pair.actual").alias("actual"),
    )


def holdout_scores(profile: DataFrame, predicted: Column, plan: ForecastPlan = ForecastPlan()) -> DataFrame:
    """Add the model's and the benchmark's error on the holdout, and the skill between them."""
    values = F.col("values")
    actual = last(values, plan.holdout)
    naive = repeat_last_season(all_but_last(values, plan.holdout), plan.holdout, plan.season)
    return profile.withColumns(
        {"holdout_mape_pct": wape(predicted, actual), "naive_wape_pct": wape(naive, actual)}
    ).withColumn("skill_vs_naive_pct", skill(F.col("holdout_mape_pct"), F.col("naive_wape_pct")))


def residual_test(df: DataFrame, residuals: Column, plan: ForecastPlan = ForecastPlan()) -> DataFrame:
    """Add the Ljung-Box p-value and its verdict; no p-value counts as failed."""
    passed = F.coalesce(F.col("ljung_box_pvalue") > plan.residual_level, F.lit(False))
    return df.withColumn("ljung_box_pvalue", F.nanvl(ljung_box_pvalue(residuals, plan.lags), F.lit(None))).withColumn(
        "residuals_pass", F.when(passed, "PASS").otherwise("FAIL")
    )


def fallback_status(plan: ForecastPlan = ForecastPlan()) -> Column:
    """OK when the residuals pass and the model beats the benchmark, else the fallback status."""
    skilled = F.coalesce(~F.isnan("skill_vs_naive_pct") & (F.col("skill_vs_naive_pct") > 0), F.lit(False))
    good = (F.col("residuals_pass") == "PASS") & skilled
    return F.when(good, "OK").otherwise("OK_FALLBACK_SEASONAL_MEDIAN")


def weekday_medians(profile: DataFrame, plan: ForecastPlan = ForecastPlan()) -> DataFrame:
    """Median and sample deviation per weekday over the last days of each entity."""
    recent = profile.select(
        plan.entity, "last_date", "n_obs_used",
        F.posexplode(last(F.col("values"), plan.fallback_days)).alias("place", "value"),
    )
    kept = F.least("n_obs_used", F.lit(plan.fallback_days))
    day = F.date_add("last_date", (F.col("place") + 1 - kept).cast("int"))
    return recent.groupBy(plan.entity, F.weekday(day).alias("weekday")).agg(
        F.median("value").alias("median_value"),
        F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("deviation"),
    )


def _clip(c: Column, cap: Column | None = None) -> Column:
    floored = F.greatest(c, F.lit(0.0))
    return floored if cap is None else F.least(floored, cap)


def _future_days(profile: DataFrame, plan: ForecastPlan) -> DataFrame:
    return profile.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(plan.horizon)))).withColumn(
        "forecast_date", F.date_add("last_date", F.col("step"))
    )


def _bounds(middle: Column, spread: Column, cap: Column) -> dict[str, Column]:
    """Point and bounds; the lower bound has a floor but no ceiling."""
    return {
        "predicted_revenue": _clip(middle, cap),
        "lower_ci": _clip(middle - spread),
        "upper_ci": _clip(middle + spread, cap),
    }


def median_forecast(profile: DataFrame, plan: ForecastPlan = ForecastPlan()) -> DataFrame:
    """The fallback on its own: forecast rows for every entity with enough history."""
    fit_for = profile.filter(has_history(plan))
    future = _future_days(fit_for.drop("values"), plan).withColumn("weekday", F.weekday("forecast_date"))
    joined = future.join(weekday_medians(fit_for, plan), [plan.entity, "weekday"])
    spread = F.lit(plan.fallback_z) * F.col("deviation")
    bounds = [c.alias(name) for name, c in _bounds(F.col("median_value"), spread, F.col("capacity_cap")).items()]
    return joined.select(plan.entity, "forecast_date", *bounds, "n_obs_used")


# The columns of a diagnostics row.
DIAGNOSTICS = [
    "sarima_order", "sarima_seasonal_order", "aic", "aicc", "ljung_box_pvalue", "residuals_pass",
    "holdout_mape_pct", "naive_wape_pct", "skill_vs_naive_pct", "n_obs_used", "status",
]

#: What a fitter adds to a profile row: the model's name and period, its information criteria, its forecast of
#: the holdout made without it, its residuals, and point, lower and upper bound per future day. A fitter that
#: fails for an entity leaves `future` NULL and says why in `fit_error`.
FIT_COLUMNS = ["model_order", "model_seasonal_order", "aic", "aicc", "holdout", "residuals", "future", "fit_error"]
Fitter = Callable[[DataFrame, "ForecastPlan"], DataFrame]


def weekly_models(profile: DataFrame, plan: ForecastPlan = ForecastPlan()) -> DataFrame:
    """The better of two weekly models on the holdout, by built-in functions over the array of values.

    One repeats the mean of the last weeks per weekday. The other regresses the log of a day's value on
    that of a week before and is applied week after week. Equal errors, or none to compare, keep the first.
    """
    season, ahead, z = plan.season, plan.horizon, plan.interval_z
    values = F.when(has_history(plan), F.col("values"))
    logs = F.transform(values, F.log1p)
    known, known_logs = all_but_last(values, plan.holdout), all_but_last(F.col("_logs"), plan.holdout)
    actual = last(values, plan.holdout)
    fitted = profile.withColumn("_logs", logs).withColumns(
        {"_line": lag_line(F.col("_logs"), season), "_held_line": lag_line(known_logs, season)}
    )
    fitted = fitted.withColumns(
        {
            "_by_mean": season_means(known, plan.holdout, season, plan.mean_weeks),
            "_by_lag": F.transform(lag_forecast(known_logs, F.col("_held_line"), plan.holdout, season), F.expm1),
        }
    )
    lag_wins = F.coalesce(wape(F.col("_by_lag"), actual) < wape(F.col("_by_mean"), actual), F.lit(False))
    fitted = fitted.withColumn("_lag", lag_wins)
    by_lag = F.col("_lag")
    fitted = fitted.withColumn(
        "residuals",
        F.when(by_lag, lag_residuals(F.col("_logs"), F.col("_line"), season)).otherwise(
            season_mean_residuals(values, season, plan.mean_weeks)
        ),
    )
    squares = F.try_divide(total(F.transform("residuals", lambda r: r * r)), F.size("residuals"))
    fitted = fitted.withColumn("_variance", squares)
    reach = F.lit(z) * F.sqrt("_variance")

    def bounds(middle: Column, back: Callable[[Column], Column]) -> Column:
        return F.transform(
            middle,
            lambda x: F.struct(
                back(x).alias("predicted_revenue"), back(x - reach).alias("lower_ci"), back(x + reach).alias("upper_ci")
            ),
        )

    future = F.when(by_lag, bounds(lag_forecast(F.col("_logs"), F.col("_line"), ahead, season), F.expm1)).otherwise(
        bounds(season_means(values, ahead, season, plan.mean_weeks), lambda x: x)
    )
    n, parameters = F.size("residuals"), F.when(by_lag, F.lit(3)).otherwise(F.lit(1))
    aic = F.when(F.col("_variance") > 0, n * F.log("_variance") + 2.0 * parameters)
    return fitted.withColumns(
        {
            "model_order": F.when(by_lag, F.lit("weekly lag")).otherwise(F.lit(f"mean of {plan.mean_weeks} weeks")),
            "model_seasonal_order": F.lit(str(season)),
            "aic": aic,
            "aicc": F.when(aic.isNotNull(), aicc(aic, n, parameters)),
            "holdout": F.when(by_lag, F.col("_by_lag")).otherwise(F.col("_by_mean")),
            "future": F.when(has_history(plan), future),
            "fit_error": F.lit(None).cast("string"),
        }
    ).select(*profile.columns, *FIT_COLUMNS)


def _fallback_days(plan: ForecastPlan) -> Column:
    """Point and bounds of the fallback per future day, from the same weekdays of the last days."""
    values, cap = F.col("values"), F.col("capacity_cap")

    def day(step: Column) -> Column:
        # Weekdays repeat every 7 days; the day `step` ahead is at place n + step - 1.
        first = F.size(values) + (step - 1) % 7 - 7 * F.floor(F.lit(plan.fallback_days) / 7)
        alike = F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(plan.fallback_days // 7)), lambda w: first + 7 * w < F.size(values)),
            lambda w: F.get(values, (first + 7 * w).cast("int")),
        )
        bounds = _bounds(median(alike), F.lit(plan.fallback_z) * deviation(alike), cap)
        return F.struct(*[c.alias(name) for name, c in bounds.items()])

    return F.transform(F.sequence(F.lit(1), F.lit(plan.horizon)), day)


def forecast(
    perf: DataFrame,
    plan: ForecastPlan = ForecastPlan(),
    as_of: DateLike | Column = None,
    fitter: Fitter = weekly_models,
) -> DataFrame:
    """Forecast rows and one diagnostics row per entity, told apart by `record_type`.

    The input is read once. All work per entity happens in the row that holds its values, so nothing is
    joined back; the explicit number of tasks keeps the adaptive planner from merging the small series
    into few of them. Write the result once and split the written table.
    """
    if plan.fallback_days % 7:
        raise ValueError("fallback_days must be whole weeks")
    tasks = plan.fit_tasks or int(perf.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    profile = series_profile(regular_series(perf, plan, tasks), plan)
    scored = holdout_scores(fitter(profile, plan), F.col("holdout"), plan)
    tested = residual_test(scored, F.col("residuals"), plan)
    fitted = F.col("future").isNotNull()
    status = choose(
        [(~has_history(plan), skipped_status(plan)), (~fitted, F.col("fit_error"))],
        fallback_status(plan),
    )
    judged = (
        tested.withColumn("status", status)
        .withColumnsRenamed({"model_order": "sarima_order", "model_seasonal_order": "sarima_seasonal_order"})
        .withColumns({c: F.when(fitted, F.col(c)) for c in DIAGNOSTICS if c not in ("n_obs_used", "status")})
    )
    capped = F.transform(
        "future",
        lambda day: F.struct(
            _clip(day["predicted_revenue"], F.col("capacity_cap")).alias("predicted_revenue"),
            _clip(day["lower_ci"]).alias("lower_ci"),
            _clip(day["upper_ci"], F.col("capacity_cap")).alias("upper_ci"),
        ),
    )
    days = F.when(fitted, F.when(F.col("status") == "OK", capped).otherwise(_fallback_days(plan)))
    numbers = ["predicted_revenue", "lower_ci", "upper_ci"]
    nothing = F.struct(*[F.lit(None).cast("double").alias(c) for c in numbers])
    # The diagnostics row goes first, at step 0. The outer form infers no filter on the array, which the optimizer
    # would move below the steps above, to work all of them out a second time.
    rows = judged.withColumn("_days", F.concat(F.array(nothing), F.coalesce(days, F.array().cast(_DAYS)))).select(
        plan.entity, "last_date", *DIAGNOSTICS, F.posexplode_outer("_days").alias("step", "day")
    )
    is_forecast = F.col("step") > 0
    return rows.select(
        plan.entity,
        F.when(is_forecast, "forecast").otherwise("diagnostics").alias("record_type"),
        F.when(is_forecast, F.date_add("last_date", F.col("step"))).alias("forecast_date"),
        *[F.col(f"day.{c}").alias(c) for c in numbers],
        *DIAGNOSTICS,
        as_of_date(as_of).alias("model_run_date"),
    )


_DAYS = "array<struct<predicted_revenue:double,lower_ci:double,upper_ci:double>>"


def forecast_rows(mixed: DataFrame, plan: ForecastPlan = ForecastPlan()) -> DataFrame:
    method = F.when(F.col("status") == "OK", MODEL_LABEL).otherwise(FALLBACK_LABEL)
    return mixed.filter(F.col("record_type") == "forecast").select(
        plan.entity, "forecast_date", "predicted_revenue", "lower_ci", "upper_ci",
        "n_obs_used", "model_run_date", method.alias("forecast_method"),
    )


def diagnostics_rows(mixed: DataFrame, plan: ForecastPlan = ForecastPlan()) -> DataFrame:
    return mixed.filter(F.col("record_type") == "diagnostics").select(plan.entity, *DIAGNOSTICS, "model_run_date")


def latest_diagnostics(log: DataFrame, entity: str = "restaurant_id", run: str = "model_run_date") -> DataFrame:
    """The newest diagnostics row per entity from the log of all runs; combines on the map side."""
    rest = [c for c in log.columns if c not in (entity, run)]
    newest = log.groupBy(entity).agg(F.max(F.struct(run, *rest)).alias("newest"))
    return newest.select(entity, "newest.*").select(*log.columns)
