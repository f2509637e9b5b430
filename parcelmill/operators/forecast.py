"""Forecasts of monthly series, one small fit per series, all in parallel.

Each series is a market's monthly figure, at most a few hundred points, so a
group is bounded by the calendar. The model is a seasonal autoregression on
monthly differences, (1,1,0)(1,0,0,12):

    w(t) = y(t) - y(t-1)
    w(t) = a w(t-1) + s w(t-12) - a s w(t-13) + e(t)

fitted by least squares on the months that have all their lags. With the first
fourteen months given, that is the point of the greatest likelihood: a filter
that starts without knowledge of the state learns all of it from these months.
Coefficients keep six decimals, so a forecast can be worked out again from the
written ones. Series with fewer such months than the fit has unknowns, or whose
fit does not settle, use (1,1,1). The column ``model`` tells which was used:
seasonal, plain, or none for a series too short for either. Intervals come from
the weights of past shocks in the forecast.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.constants import (
    FORECAST_HOLDOUT, FORECAST_NORMAL_QUANTILE, FORECAST_STEPS, SEASON,
)
from parcelmill.functions.scalar import percent_change
from parcelmill.operators.calendar import holdout_split
from parcelmill.packaging import ship

FORECAST_SCHEMA = "step int, month date, mean double, lo double, hi double, model string"
#: Unknowns of the seasonal fit: two coefficients and the shock variance.
MIN_RESIDUALS = 3
#: The fit has settled when a round moves the coefficients by less than this.
SETTLED = 1e-12
ROUNDS = 500
#: Sums of squares that differ by less than this share are equal.
TIE = 1e-11
# A series that repeats exactly leaves no residual; its interval is still not
# narrower than this share of its usual monthly change.
LEAST_SPREAD = 1e-6


def _lagged(w: np.ndarray, lag: int) -> np.ndarray:
    out = np.full(len(w), np.nan)
    if lag < len(w):
        out[lag:] = w[: len(w) - lag]
    return out


def _slope(product: float, power: float) -> float:
    return product / power if power > 0 else 0.0


def _six(x: float) -> float:
    return math.floor(x * 1e6 + 0.5) / 1e6


def fit_seasonal(w: np.ndarray) -> tuple[float, float, float] | None:
    """(a, s, shock variance) of the seasonal model on differences, or None."""
    lags = np.column_stack([w, _lagged(w, 1), _lagged(w, SEASON), _lagged(w, SEASON + 1)])
    rows = lags[~np.isnan(lags).any(axis=1)]
    if len(rows) < MIN_RESIDUALS:
        return None
    now, one, season, both = rows.T
    (_, no, ns, nb), (_, oo, os, ob), (_, _, ss, sb), (_, _, _, bb) = (rows.T @ rows).tolist()
    a = s = 0.0
    # With one of the two coefficients fixed the other is a plain regression.
    for _ in range(ROUNDS):
        a_next = _slope(no - s * (os + nb) + s * s * sb, oo - 2 * s * ob + s * s * bb)
        s_next = _slope(ns - a_next * (os + nb) + a_next * a_next * ob, ss - 2 * a_next * sb + a_next * a_next * bb)
        moved = abs(a_next - a) + abs(s_next - s)
        a, s = a_next, s_next
        if moved < SETTLED:
            break
    else:
        return None
    if not np.isfinite([a, s]).all():
        return None
    a, s = _six(a), _six(s)
    shocks = now - a * one - s * season + a * s * both
    return a, s, float(shocks @ shocks) / len(shocks)


def fit_plain(w: np.ndarray) -> tuple[float, float, float, float] | None:
    """(a, b, last shock, shock variance) of w(t) = a w(t-1) + e(t) + b e(t-1):
    the best point of a grid that is refined around its best point."""
    known = w[~np.isnan(w)]
    if len(known) < 3:
        return None
    centre, width, best = (0.0, 0.0), 0.95, None
    for _ in range(6):
        a_axis = np.clip(centre[0] + np.linspace(-width, width, 21), -0.98, 0.98)
        b_axis = np.clip(centre[1] + np.linspace(-width, width, 21), -0.98, 0.98)
        a, b = (m.ravel() for m in np.meshgrid(a_axis, b_axis))
        shock, total = np.zeros(len(a)), np.zeros(len(a))
        for before, now in zip(known[:-1], known[1:]):
            shock = now - a * before - b * shock
            total += shock**2
        # Whole lines of points may fit equally well; the first of them is taken.
        at = int(np.argmax(total <= total.min() * (1 + TIE)))
        best = (float(a[at]), float(b[at]), float(shock[at]), float(total[at]) / (len(known) - 1))
        centre, width = best[:2], width / 5
    return best


def forecast_values(y: np.ndarray, steps: int, z: float = FORECAST_NORMAL_QUANTILE):
    """(mean, lo, hi) arrays of the next ``steps`` values and the model, or None
    when the series is too short. Gaps in ``y`` are NaN."""
    known = np.flatnonzero(~np.isnan(y))
    if len(known) < 4:
        return None
    w = np.diff(y)
    filled = np.interp(np.arange(len(y)), known, y[known])
    past = list(np.diff(filled))
    seasonal = fit_seasonal(w)
    if seasonal is not None:
        a, s, variance = seasonal
        for _ in range(steps):
            past.append(a * past[-1] + s * past[-SEASON] - a * s * past[-SEASON - 1])
        # Response of a difference to a shock h months before.
        reply = np.zeros(steps)
        for h in range(steps):
            reply[h] = (
                (h == 0)
                + a * (reply[h - 1] if h >= 1 else 0.0)
                + s * (reply[h - SEASON] if h >= SEASON else 0.0)
                - a * s * (reply[h - SEASON - 1] if h > SEASON else 0.0)
            )
    else:
        plain = fit_plain(w)
        if plain is None:
            return None
        a, b, shock, variance = plain
        reply = np.array([1.0 if h == 0 else (a + b) * a ** (h - 1) for h in range(steps)])
        for h in range(steps):
            past.append(a * past[-1] + (b * shock if h == 0 else 0.0))
    usual = math.sqrt(float(np.nanmean(w**2))) if np.isfinite(w).any() else 0.0
    variance = max(variance, (LEAST_SPREAD * usual) ** 2)
    mean = filled[-1] + np.cumsum(past[-steps:])
    spread = z * np.sqrt(variance * np.cumsum(np.cumsum(reply) ** 2))
    return mean, mean - spread, mean + spread, "plain" if seasonal is None else "seasonal"


def forecast(series: DataFrame, keys: list[str], steps: int = FORECAST_STEPS) -> DataFrame:
    """(keys, step, month, mean, lo, hi, model) for every series of (month, value).

    Months must be complete, see ``as_series``. A series too short to fit has
    null figures."""
    ship(series.sparkSession)
    types = dict(series.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", " + FORECAST_SCHEMA

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("month")
        found = forecast_values(rows["value"].to_numpy(dtype=float), steps)
        mean, lo, hi, model = found if found is not None else [*[np.full(steps, np.nan)] * 3, "none"]
        start = pd.Timestamp(rows["month"].iloc[-1])
        months = [(start + pd.DateOffset(months=h + 1)).date() for h in range(steps)]
        out = pd.DataFrame({
            "step": np.arange(1, steps + 1, dtype=np.int32), "month": months,
            "mean": mean, "lo": lo, "hi": hi, "model": model,
        })
        for k, value in zip(keys, key):
            out[k] = value
        return out[[*keys, "step", "month", "mean", "lo", "hi", "model"]]

    fitted = series.select(*keys, "month", "value").groupBy(*keys).applyInPandas(one, schema)
    return fitted.withColumns({
        c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("mean", "lo", "hi")
    })


def mape(actual: Column, expected: Column) -> Column:
    return F.avg(F.abs(F.try_divide(actual - expected, actual))) * 100


def backtest(series: DataFrame, keys: list[str], points: int = FORECAST_HOLDOUT) -> DataFrame:
    """(keys, mape_pct, points): error of the forecast of the last points from
    the months before them."""
    marked = holdout_split(series, keys, points)
    made = forecast(marked.filter(~F.col("held_out")), keys, points)
    held = marked.filter("held_out").select(*keys, "month", "value")
    return held.join(made, [*keys, "month"]).groupBy(*keys).agg(
        mape(F.col("value"), F.col("mean")).alias("mape_pct"), F.count("mean").alias("points")
    )


def latest_alert(series: DataFrame, keys: list[str]) -> DataFrame:
    """The latest month against its forecast from the months before, with
    ``alert`` where it is outside the interval. A month without an expected
    value raises none."""
    marked = holdout_split(series, keys, 1)
    made = forecast(marked.filter(~F.col("held_out")), keys, 1)
    held = marked.filter("held_out").select(*keys, "month", F.col("value").alias("actual"))
    both = held.join(made.drop("step"), [*keys, "month"])
    return both.select(
        *keys, "month", "actual", F.col("mean").alias("expected"), "lo", "hi",
        percent_change(F.col("actual"), F.col("mean")).alias("deviation_pct"),
        F.coalesce(~F.col("actual").between(F.col("lo"), F.col("hi")), F.lit(False)).alias("alert"), "model",
    )
