"""Fitted demand forecast: exponential smoothing with trend and season, chosen per product.

A product's weeks are one array, folded in order; nothing but that array per product is shuffled, and an array
has one entry per week of ``demand.FIRST_DAY`` to ``demand.LAST_DAY`` at most. In each week the one-step forecast is level + trend + season; its
error moves the level by ``alpha``, the trend by ``beta`` and the week's place in the season by ``gamma`` of it. The products of an Arrow
batch take each week side by side, some thousands at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from larder.operators.demand import HORIZON_WEEKS, SEASON_WEEKS

# Executors need not have this repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Parameters tried for every product: alpha, beta, gamma.
GRID = ((0.02, 0.0, 0.0), (0.1, 0.0, 0.0), (0.1, 0.01, 0.0), (0.02, 0.0, 0.05))
#: Weeks that share a place in the season, weeks of the backtest at most, and the share of a product's weeks it takes at most.
SEASON_STEP, TEST_WEEKS, TEST_SHARE = 4, 26, 4


#: Products folded side by side, and entries of their arrays at most.
SIDE_BY_SIDE, ENTRIES = 4096, 2_000_000


def _place(week: np.ndarray) -> np.ndarray:
    return week % SEASON_WEEKS // SEASON_STEP


def _fold(first: np.ndarray, n: np.ndarray, cents: np.ndarray, grid, horizon: int, test_weeks: int) -> dict[str, np.ndarray]:
    """The fit of some products, sorted by falling ``n``. ``cents``: a row per week, a column per product, 0 beyond its last week.

    Products with more weeks have as many to train on and to test on, so those still running are always the first ones.
    """
    y = cents / 100.0
    train = n - np.minimum(test_weeks, n // TEST_SHARE)
    every = np.arange(len(n))
    known = np.minimum(SEASON_WEEKS, train)
    start = np.where(np.arange(min(SEASON_WEEKS, len(y)))[:, None] < known, cents[:SEASON_WEEKS], 0).sum(axis=0) / 100.0 / known

    def running(weeks: np.ndarray) -> Iterator[tuple[int, int]]:
        counts = np.searchsorted(-weeks, -np.arange(weeks.max(initial=0)), side="left")
        return enumerate(counts.tolist())

    def step(k: int, t: np.ndarray, v: np.ndarray, level, trend, season, ahead, alpha, beta, gamma) -> np.ndarray:
        """Takes the week ``t`` into the state of the first k products; returns what the forecast missed."""
        missed = v - ahead[:k]
        level[:k] = level[:k] + trend[:k] + alpha * missed
        trend[:k] = trend[:k] + beta * missed
        season[every[:k], _place(first[:k] + t)] += gamma * missed
        ahead[:k] = level[:k] + trend[:k] + season[every[:k], _place(first[:k] + t + 1)]
        return missed

    parameters = np.asarray(grid, np.float64).T
    shape = (len(n), len(grid))
    level = np.repeat(start[:, None], len(grid), axis=1)
    trend, season, ahead, fit = np.zeros(shape), np.zeros((len(n), SEASON_WEEKS // SEASON_STEP, len(grid))), level.copy(), np.zeros(shape)
    for t, k in running(train):
        missed = step(k, t, y[t, :k, None], level, trend, season, ahead, *parameters)
        fit[:k] += missed * missed
    best = fit.argmin(axis=1)
    level, trend, season, ahead = level[every, best], trend[every, best], season[every, :, best], ahead[every, best]
    alpha, beta, gamma = parameters[:, best]
    ae, se, nae, nse = np.zeros((4, len(n)))
    for j, k in running(n - train):
        t = train[:k] + j
        v = y[t, every[:k]]
        off = v - np.maximum(ahead[:k], 0.0)
        naive = v - np.where(t >= SEASON_WEEKS, y[np.maximum(t - SEASON_WEEKS, 0), every[:k]], y[t - 1, every[:k]])
        for total, x in ((ae, np.abs(off)), (se, off * off), (nae, np.abs(naive)), (nse, naive * naive)):
            total[:k] += x
        step(k, t, v, level, trend, season, ahead, alpha[:k], beta[:k], gamma[:k])
    h = np.arange(1, horizon + 1)
    week = (first + n - 1)[:, None] + h
    forecast = np.maximum(level[:, None] + h * trend[:, None] + season[every[:, None], _place(week)], 0.0)
    whole = {"n_weeks": n, "n_tested": n - train, "alpha": alpha, "beta": beta, "gamma": gamma, "ae": ae, "se": se, "nae": nae, "nse": nse}
    return {"week": week.ravel(), "forecast": forecast.ravel()} | {c: np.repeat(x, horizon) for c, x in whole.items()}


def fitted_forecast(
    arrays: DataFrame, grid: Sequence[tuple[float, float, float]] = GRID, horizon: int = HORIZON_WEEKS,
    test_weeks: int = TEST_WEEKS,
) -> DataFrame:
    """Per product and week to come: the forecast, the parameters and the errors of a rolling-origin backtest.

    ``arrays`` comes from :func:`demand.weekly_arrays`. The last weeks of a product, a quarter of them at most, are kept out: the
    parameters with the least squared one-step error before them are taken (the first of equals), then each of these weeks is forecast
    from all weeks before it. ``naive_*`` are the errors of last season's same week there, or of the week before
    where a product is younger than a season. A product with fewer than four weeks has no errors (NULL). No forecast is below 0.
    """
    whole = ("week", "n_weeks", "n_tested")
    columns = ["week", "forecast", "n_weeks", "n_tested", "alpha", "beta", "gamma", "ae", "se", "nae", "nse"]
    fields = [StructField(c, IntegerType() if c in whole else DoubleType()) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weeks = batch.column(2).value_lengths().to_numpy().astype(np.int64)
            sold, begin = batch.column(2).flatten().to_numpy(), np.cumsum(weeks) - weeks
            order = np.argsort(-weeks, kind="stable")
            at = 0
            while at < len(order):
                some = order[at : at + max(1, min(SIDE_BY_SIDE, ENTRIES // max(1, int(weeks[order[at]]))))]
                at += len(some)
                n = weeks[some]
                t = np.arange(n[0])[:, None]
                cents = np.where(t < n, sold[np.minimum(begin[some] + t, len(sold) - 1)], 0)
                first = batch.column(1).take(pa.array(some)).to_numpy().astype(np.int64)
                made = _fold(first, n, cents, grid, horizon, test_weeks)
                made = [pa.array(made[c], pa.int32() if c in whole else pa.float64()) for c in columns]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(some, horizon))), *made], names=["l_partkey", *columns])

    facts = arrays.select("l_partkey", "first_week", "sold")
    out = facts.mapInArrow(run, StructType([StructField("l_partkey", arrays.schema["l_partkey"].dataType), *fields]))
    per = "nullif(n_tested, 0)"
    return out.selectExpr(
        "l_partkey", "week", "forecast", "n_weeks", "n_tested", "alpha", "beta", "gamma",
        f"ae / {per} as mae", f"sqrt(se / {per}) as rmse",
        f"nae / {per} as naive_mae", f"sqrt(nse / {per}) as naive_rmse",
    )
