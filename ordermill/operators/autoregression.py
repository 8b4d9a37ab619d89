"""Fitters beside the weekly models: an autoregression chosen by test and criterion, and a hook for a user's own model.

The first one is columns only. A Dickey-Fuller test decides between the level and the difference of the log series,
the Levinson-Durbin recursion gives all orders from the same autocovariances, and AICc picks one. The
second hands each entity's values to a Python function and keeps its failure to that entity.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.series import (
    all_but_last,
    autocovariances,
    autoregressive_residuals,
    autoregressive_steps,
    best_order,
    bind,
    centred,
    dickey_fuller,
    differences,
    innovation_weights,
    levinson_durbin,
    needs_differencing,
    running_sums,
    total,
)
from ordermill.operators.forecast import FIT_COLUMNS, Fitter, ForecastPlan, has_history

MOST_LAGS = 14


def chosen_model(values: Column, most: int) -> Column:
    """(differenced, mean, last, held, fit) of a series: `held` is the centred level or difference, `fit` its best order."""

    def modelled(work: Column) -> Column:
        return bind(
            F.struct(work.alias("series"), centred(work).alias("held")),
            lambda w: F.struct(
                F.try_divide(total(w["series"]), F.size(w["series"])).alias("mean"),
                w["held"].alias("held"),
                best_order(levinson_durbin_of(w["held"], most), F.size(w["held"])).alias("fit"),
            ),
        )

    def of(series: Column) -> Column:
        return bind(
            needs_differencing(series),
            lambda d: F.struct(
                d.alias("differenced"),
                F.get(series, F.size(series) - 1).alias("last"),
                bind(F.when(d, differences(series)).otherwise(series), modelled).alias("model"),
            ),
        )

    return bind(values, of)


def levinson_durbin_of(held: Column, most: int) -> Column:
    return bind(autocovariances(held, most), lambda r: levinson_durbin(r, most))


def order_choice(profile: DataFrame, plan: ForecastPlan = ForecastPlan(), most: int = MOST_LAGS) -> DataFrame:
    """Per entity with enough history: test statistic, whether the difference is modelled, order, AICc and coefficients."""
    logs = F.transform("values", F.log1p)
    held = profile.filter(has_history(plan)).withColumn("_logs", logs)
    chosen = held.withColumns({"_statistic": dickey_fuller(F.col("_logs")), "_chosen": chosen_model(F.col("_logs"), most)})
    return chosen.select(
        plan.entity,
        F.col("_statistic").alias("dickey_fuller"),
        F.col("_chosen.differenced").alias("differenced"),
        F.col("_chosen.model.fit.order").alias("ar_order"),
        F.col("_chosen.model.fit.aicc").alias("aicc"),
        F.col("_chosen.model.fit.phi").alias("phi"),
    )


def _carried_on(chosen: Column, steps: int) -> Column:
    """The log series' next values by a chosen model."""
    ahead = F.transform(
        autoregressive_steps(chosen["model"]["held"], chosen["model"]["fit"]["phi"], steps), lambda x: x + chosen["model"]["mean"]
    )
    return F.when(chosen["differenced"], F.transform(running_sums(ahead), lambda x: x + chosen["last"])).otherwise(ahead)


def autoregression(most: int = MOST_LAGS) -> Fitter:
    """A fitter that models the log of the daily value by an autoregression of at most ``most`` lags.

    The holdout is forecast by a model of the days before it; the rest is fitted on all days. Bounds are those of
    the accumulated innovations, on the log scale.
    """

    def fitter(profile: DataFrame, plan: ForecastPlan) -> DataFrame:
        logs = F.when(has_history(plan), F.transform("values", F.log1p))
        fitted = profile.withColumn("_logs", logs)
        fitted = fitted.withColumns(
            {"_all": chosen_model(F.col("_logs"), most), "_early": chosen_model(all_but_last(F.col("_logs"), plan.holdout), most)}
        )
        model, fit = F.col("_all.model"), F.col("_all.model.fit")
        weights = innovation_weights(fit["phi"], plan.horizon)
        weights = bind(weights, lambda w: F.when(F.col("_all.differenced"), running_sums(w)).otherwise(w))
        spread = F.transform(
            bind(weights, lambda w: running_sums(F.transform(w, lambda x: x * x))),
            lambda s: F.lit(plan.interval_z) * F.sqrt(s * F.greatest(fit["variance"], F.lit(0.0))),
        )
        days = F.zip_with(
            _carried_on(F.col("_all"), plan.horizon),
            spread,
            lambda x, reach: F.struct(
                F.expm1(x).alias("predicted_revenue"), F.expm1(x - reach).alias("lower_ci"), F.expm1(x + reach).alias("upper_ci")
            ),
        )
        ready = F.col("_logs").isNotNull()
        named = F.format_string("(%d,%d,0)", fit["order"], F.col("_all.differenced").cast("int"))
        return fitted.withColumns(
            {
                "model_order": F.when(ready, named),
                "model_seasonal_order": F.when(ready, F.lit("none")),
                "aic": fit["aic"],
                "aicc": fit["aicc"],
                "holdout": F.when(ready, F.transform(_carried_on(F.col("_early"), plan.holdout), F.expm1)),
                "residuals": F.when(ready, autoregressive_residuals(model["held"], fit["phi"])),
                "future": F.when(ready, days),
                "fit_error": F.lit(None).cast("string"),
            }
        ).select(*profile.columns, *FIT_COLUMNS)

    return fitter


# What a user's model returns for an entity's values: keys of FIT_COLUMNS without `fit_error`.
EntityModel = Callable[[np.ndarray, "ForecastPlan"], Mapping[str, object]]
_FUTURE = "array<struct<predicted_revenue:double,lower_ci:double,upper_ci:double>>"


def grouped_fitter(model: EntityModel) -> Fitter:
    """A fitter from a function on one entity's daily values, run once per entity by `applyInPandas`.

    The function returns `model_order`, `model_seasonal_order`, `aic`, `aicc`, `holdout` (a number per holdout
    day), `residuals`, and `future` (point, lower and upper bound per day ahead). Where it raises, or a list has
    another length, the entity keeps its row, without a forecast and with the reason in `fit_error`; the others go on.
    """

    def fitter(profile: DataFrame, plan: ForecastPlan) -> DataFrame:
        kinds = ["string", "string", "double", "double", "array<double>", "array<double>", _FUTURE, "string"]
        added = ", ".join(f"{name} {kind}" for name, kind in zip(FIT_COLUMNS, kinds))
        known = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in profile.schema)

        def fit(rows: pd.DataFrame) -> pd.DataFrame:
            row = rows.iloc[0]
            out = dict.fromkeys(FIT_COLUMNS)
            try:
                if row["n_obs_used"] >= plan.min_history:
                    out |= _checked(model(np.array(row["values"], float), plan), plan)
            except Exception as problem:  # of this entity alone, reported in its row
                out = dict.fromkeys(FIT_COLUMNS) | {"fit_error": f"FAILED ({type(problem).__name__}: {problem})"[:500]}
            return rows.head(1).assign(**{name: pd.Series([value], index=rows.index[:1], dtype="object") for name, value in out.items()})

        return profile.groupBy(plan.entity).applyInPandas(fit, f"{known}, {added}")

    return fitter


def _checked(found: Mapping[str, object], plan: ForecastPlan) -> dict[str, object]:
    out = {name: found[name] for name in FIT_COLUMNS if name != "fit_error"}
    for name, wanted in (("holdout", plan.holdout), ("future", plan.horizon)):
        if len(out[name]) != wanted:
            raise ValueError(f"{name} has {len(out[name])} days instead of {wanted}")
    bounds = ("predicted_revenue", "lower_ci", "upper_ci")
    numbers = {name: [float(x) for x in out[name]] for name in ("holdout", "residuals")}
    days = [dict(zip(bounds, map(float, day))) for day in out["future"]]
    texts = {name: str(out[name]) for name in ("model_order", "model_seasonal_order")}
    return {**out, **numbers, **texts, "aic": float(out["aic"]), "aicc": float(out["aicc"]), "future": days}
