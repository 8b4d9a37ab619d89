"""Forecast statistics as expressions over one row per entity holding its daily values as an array.

An array has one value per calendar day, so its length is bounded by the length of the calendar.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SEASON = 7


def _n(values: Column) -> Column:
    return F.size(values)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value worked out once; inlined into a lambda it would be worked out per element."""
    return F.transform(F.array(value), body)[0]


def last(values: Column, n: int) -> Column:
    """The last n values, or all of them when there are fewer."""
    return F.slice(values, F.greatest(_n(values) - n + 1, F.lit(1)), n)


def all_but_last(values: Column, n: int) -> Column:
    return F.slice(values, F.lit(1), F.greatest(_n(values) - n, F.lit(0)))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def repeat_last_season(train: Column, horizon: int, season: int = SEASON) -> Column:
    """Seasonal-naive forecast: the last season of the training values, tiled over the horizon."""
    steps = F.sequence(F.lit(0), F.lit(horizon - 1))
    return bind(
        last(train, season), lambda tail: F.transform(steps, lambda h: F.get(tail, (h % season).cast("int")))
    )


def wape(forecast: Column, actual: Column) -> Column:
    """Sum of absolute errors over the sum of actuals, in percent; NULL when nothing was sold."""
    errors = total(F.zip_with(forecast, actual, lambda f, a: F.abs(f - a)))
    sold = total(actual)
    return F.when(sold > 0, errors / sold * 100.0)


def skill(model_wape: Column, naive_wape: Column) -> Column:
    """Percent of the benchmark's error that the model removes; NULL for a perfect benchmark."""
    return F.when(naive_wape > 0, (1.0 - model_wape / naive_wape) * 100.0)


def aicc(aic: Column, n_obs: Column, n_params: Column) -> Column:
    """AIC with the small-sample term; infinite where that term has no positive denominator."""
    room = n_obs - n_params - 1
    return F.when(room > 0, aic + 2.0 * n_params * (n_params + 1) / room).otherwise(F.lit(float("inf")))


def season_means(values: Column, steps: int, season: int = SEASON, weeks: int = 4) -> Column:
    """Forecast by the mean of the last `weeks` values at the same place of the season."""

    def mean_of(step: Column) -> Column:
        place = F.size(values) + step % season
        return sum((F.get(values, (place - season * w).cast("int")) for w in range(1, weeks + 1)), F.lit(0.0)) / float(weeks)

    return F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), mean_of)


def season_mean_residuals(values: Column, season: int = SEASON, weeks: int = 4) -> Column:
    """What that forecast, made one season ahead, has been off by within the series."""
    first = season * weeks

    def off_by(value: Column, place: Column) -> Column:
        before = [F.get(values, (place + first - season * w).cast("int")) for w in range(1, weeks + 1)]
        return value - sum(before, F.lit(0.0)) / float(weeks)

    return F.transform(F.slice(values, F.lit(first + 1), F.greatest(_n(values) - first, F.lit(0))), off_by)


def lag_line(values: Column, season: int = SEASON) -> Column:
    """(offset, slope) of the least-squares line from the value a season ago; slope 0 where that never varies."""
    pairs = F.greatest(_n(values) - season, F.lit(0))

    def fitted(both: Column) -> Column:
        x, y = both["x"], both["y"]
        return bind(
            F.struct(F.try_divide(total(x), F.size(x)).alias("x"), F.try_divide(total(y), F.size(y)).alias("y")),
            lambda mean: bind(
                F.coalesce(
                    F.try_divide(
                        total(F.zip_with(x, y, lambda a, b: (a - mean["x"]) * (b - mean["y"]))),
                        total(F.transform(x, lambda a: (a - mean["x"]) * (a - mean["x"]))),
                    ),
                    F.lit(0.0),
                ),
                lambda slope: F.struct((mean["y"] - slope * mean["x"]).alias("offset"), slope.alias("slope")),
            ),
        )

    sides = F.struct(F.slice(values, F.lit(1), pairs).alias("x"), F.slice(values, F.lit(season + 1), pairs).alias("y"))
    return bind(sides, fitted)


def lag_forecast(values: Column, line: Column, steps: int, season: int = SEASON) -> Column:
    """The line applied season after season, starting from the last known one."""

    def ahead(step: Column) -> Column:
        known = F.get(values, (F.size(values) - season + step % season).cast("int"))
        turns = F.sequence(F.lit(0), F.floor(step / season).cast("int"))
        return F.aggregate(turns, known, lambda value, _: line["offset"] + line["slope"] * value)

    return F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), ahead)


def lag_residuals(values: Column, line: Column, season: int = SEASON) -> Column:
    pairs = F.greatest(_n(values) - season, F.lit(0))
    before, after = F.slice(values, F.lit(1), pairs), F.slice(values, F.lit(season + 1), pairs)
    return F.zip_with(before, after, lambda x, y: y - line["offset"] - line["slope"] * x)


def median(values: Column) -> Column:
    """The middle of a short array, or the mean of the two in the middle."""
    half = F.floor(F.size(values) / 2).cast("int")
    return bind(
        F.array_sort(values),
        lambda ranked: F.when(F.size(ranked) % 2 == 1, F.get(ranked, half)).otherwise(
            (F.get(ranked, half - 1) + F.get(ranked, half)) / 2.0
        ),
    )


def deviation(values: Column) -> Column:
    """Sample standard deviation of an array; 0 for a single value."""

    def spread(held: Column) -> Column:
        return bind(
            F.try_divide(total(held), F.size(held)),
            lambda mean: F.sqrt(F.try_divide(total(F.transform(held, lambda x: (x - mean) * (x - mean))), F.size(held) - 1)),
        )

    return F.coalesce(bind(values, spread), F.lit(0.0))


def chi_square_tail(x: Column, dof: int) -> Column:
    """P(X > x) of a chi-square with an even number of degrees of freedom, in closed form."""
    if dof % 2:
        raise ValueError("the closed form needs an even number of degrees of freedom")
    half = x / 2.0
    term = series = F.lit(1.0)
    for j in range(1, dof // 2):
        term = term * half / float(j)
        series = series + term
    return F.exp(-half) * series


def ljung_box_pvalue(residuals: Column, lags: int = 10) -> Column:
    """P-value of the test that the first `lags` autocorrelations are zero; NULL for a flat series."""

    def statistic(values: Column) -> Column:
        n = _n(values)
        centred = bind(total(values) / n, lambda mean: F.transform(values, lambda x: x - mean))
        return bind(centred, lambda c: _q_statistic(c, n, lags))

    return bind(bind(residuals, statistic), lambda q: chi_square_tail(q, lags))


def _q_statistic(centred: Column, n: Column, lags: int) -> Column:
    def lag_term(k: Column) -> Column:
        ahead = F.slice(centred, k + 1, n - k)
        products = total(F.zip_with(ahead, F.slice(centred, F.lit(1), n - k), lambda a, b: a * b))
        return products * products / (n - k)

    products = total(F.transform(F.sequence(F.lit(1), F.lit(lags)), lag_term))
    variance = total(F.transform(centred, lambda x: x * x))
    return n * (n + 2.0) * F.try_divide(products, variance * variance)


# MacKinnon's (2010) response surface for the 5 % point of the Dickey-Fuller test with a constant.
DICKEY_FULLER_5_PCT = (-2.86154, -2.8903, -4.234, -40.040)


def differences(values: Column) -> Column:
    """Each value less the one before; one fewer than the values."""
    count = F.greatest(_n(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(2), count), F.slice(values, F.lit(1), count), lambda b, a: b - a)


def dickey_fuller(values: Column) -> Column:
    """t-statistic of the level in a regression of the changes on the level before, with a constant.

    It needs the sums of two series, their squares and their product alone. NULL where the level never
    varies, or the regression leaves nothing over.
    """

    def of(held: Column) -> Column:
        pairs = F.struct(all_but_last(held, 1).alias("x"), differences(held).alias("d"))
        return bind(pairs, lambda p: bind(centred_sums(p["x"], p["d"]), statistic))

    def centred_sums(x: Column, d: Column) -> Column:
        means = F.struct(F.try_divide(total(x), _n(x)).alias("x"), F.try_divide(total(d), _n(d)).alias("d"))
        return bind(
            means,
            lambda m: F.struct(
                _n(x).alias("n"),
                total(F.transform(x, lambda a: (a - m["x"]) * (a - m["x"]))).alias("xx"),
                total(F.transform(d, lambda b: (b - m["d"]) * (b - m["d"]))).alias("dd"),
                total(F.zip_with(x, d, lambda a, b: (a - m["x"]) * (b - m["d"]))).alias("xd"),
            ),
        )

    def statistic(s: Column) -> Column:
        slope = F.try_divide(s["xd"], s["xx"])
        left = s["dd"] - slope * s["xd"]
        return F.when((left > 0) & (s["n"] > 2), slope / F.sqrt(left / (s["n"] - 2) / s["xx"]))

    return bind(values, of)


def needs_differencing(values: Column) -> Column:
    """Whether a unit root is not rejected at 5 %; a series without a statistic stays as it is."""
    n = F.greatest(_n(values) - 1, F.lit(1)).cast("double")
    a, b, c, d = DICKEY_FULLER_5_PCT
    critical = F.lit(a) + b / n + c / (n * n) + d / (n * n * n)
    return F.coalesce(dickey_fuller(values) >= critical, F.lit(False))


def autocovariances(centred: Column, lags: int) -> Column:
    """Lag 0 to ``lags`` of a series whose mean is 0, all divided by its length."""

    def at(k: Column) -> Column:
        count = F.greatest(_n(centred) - k, F.lit(0))
        products = F.zip_with(F.slice(centred, k + 1, count), F.slice(centred, F.lit(1), count), lambda a, b: a * b)
        return F.coalesce(F.try_divide(total(products), _n(centred)), F.lit(0.0))

    return F.transform(F.sequence(F.lit(0), F.lit(lags)), at)


_FIT = "struct<order:int,phi:array<double>,variance:double>"


def levinson_durbin(covariances: Column, most: int) -> Column:
    """Autoregressions of order 0 to ``most``, each from the one before: order, coefficients, innovation variance."""

    def grow(fits: Column, k: Column) -> Column:
        before = fits[F.size(fits) - 1]
        explained = total(F.transform(before["phi"], lambda phi, j: phi * covariances[k - 1 - j]))
        partial = F.coalesce(F.try_divide(covariances[k] - explained, before["variance"]), F.lit(0.0))

        def step(fit: Column) -> Column:
            last_phi = fit["partial"]
            phi = F.transform(before["phi"], lambda x, j: x - last_phi * before["phi"][k - 2 - j])
            variance = before["variance"] * (F.lit(1.0) - last_phi * last_phi)
            return F.struct(
                k.cast("int").alias("order"), F.concat(phi, F.array(last_phi)).alias("phi"), variance.alias("variance")
            ).cast(_FIT)

        return F.concat(fits, F.array(bind(F.struct(partial.alias("partial")), step)))

    none = F.struct(F.lit(0).alias("order"), F.array().cast("array<double>").alias("phi"), covariances[0].alias("variance")).cast(_FIT)
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), F.array(none), grow)


def best_order(fits: Column, n_obs: Column) -> Column:
    """The fit of least AICc, of equal ones the lowest order: (aicc, aic, order, phi, variance).

    The parameters are the coefficients and the variance. A fit that leaves no variance beats all others.
    """

    def scored(fit: Column) -> Column:
        parameters = fit["order"] + 1
        aic = F.when(fit["variance"] > 0, n_obs * F.log(fit["variance"]) + 2.0 * parameters).otherwise(F.lit(float("-inf")))
        return F.struct(
            aicc(aic, n_obs, parameters).alias("aicc"), fit["order"].alias("order"), aic.alias("aic"),
            fit["phi"].alias("phi"), fit["variance"].alias("variance"),
        )

    return F.array_min(F.transform(fits, scored))


def centred(values: Column) -> Column:
    return bind(F.try_divide(total(values), _n(values)), lambda mean: F.transform(values, lambda x: x - mean))


def autoregressive_steps(recent: Column, phi: Column, steps: int) -> Column:
    """A centred series carried on: each value is ``phi`` over the ones before, the newest first."""

    def onward(values: Column, _: Column) -> Column:
        ahead = total(F.transform(phi, lambda p, j: p * F.coalesce(F.get(values, F.size(values) - 1 - j), F.lit(0.0))))
        return F.concat(values, F.array(ahead))

    carried = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), last(recent, 400), onward)
    return last(carried, steps)


def innovation_weights(phi: Column, steps: int) -> Column:
    """How much of an innovation is still there 0 to ``steps`` - 1 steps later."""

    def onward(weights: Column, _: Column) -> Column:
        ahead = total(F.transform(phi, lambda p, j: p * F.coalesce(F.get(weights, F.size(weights) - 1 - j), F.lit(0.0))))
        return F.concat(weights, F.array(ahead))

    if steps == 1:
        return F.array(F.lit(1.0))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps - 1)), F.array(F.lit(1.0)), onward)


def running_sums(values: Column) -> Column:
    def onward(sums: Column, x: Column) -> Column:
        return F.concat(sums, F.array(F.coalesce(F.get(sums, F.size(sums) - 1), F.lit(0.0)) + x))

    return F.aggregate(values, F.array().cast("array<double>"), onward)


def autoregressive_residuals(held: Column, phi: Column) -> Column:
    """What the model is off by, one step ahead, from the first value that has all its lags."""
    order = F.size(phi)

    def off_by(value: Column, place: Column) -> Column:
        return value - total(F.transform(phi, lambda p, j: p * F.get(held, place + order - 1 - j)))

    return F.transform(F.slice(held, order + 1, F.greatest(_n(held) - order, F.lit(0))), off_by)
