"""Holt-Winters forecasting (M5, M6, M8-M11) as an Arrow job.

Each series (gap-filled, M4) is gathered into one row; Python gets batches of
such rows and fits up to ``SERIES_PER_CALL`` series at once with numpy:

* additive trend, plus additive seasonality (period 12) when the fitted
  stretch has >= 24 months; series shorter than 6 months get no rows;
* smoothing weights (alpha, beta <= alpha, gamma <= 1 - alpha) from a fixed
  grid, minimising the one-step squared error over all start values (level,
  trend, seasonals summing to zero); then a walk in shrinking steps over the
  whole admissible range until the error stops falling;
* backtest: the last 3 months held out, the shape chosen on the training
  length, forecasts clipped at 0; MAE, and MAPE over non-zero actuals;
* forecast: 3 months after the series' own last month, clipped at 0, with a
  band of +- z x population sigma of the in-sample one-step residuals.

The least squared error for given weights needs no start values: the series,
differenced by (1 - B)(1 - B^12) (trend only: (1 - B)^2), is a moving average
theta(B) of the one-step errors, start values are what the differences leave
free, and so the least error is z' (theta theta')^-1 z. theta theta' is a
banded Toeplitz matrix; with its Cholesky factor L, the squares of L^-1 z
added up to any month are the least error of the series cut there. On the
grid L^-1 is kept as a matrix (one product for all series and lengths), on
the walk the bands of L are solved for. Start values are worked out once, for
the weights found.
"""

from __future__ import annotations

import sys
import types

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuflow.functions.columns import round_half_up
from skuflow.operators.demand import confidence_label
from skuflow.params import ForecastParams
from skuflow.sources.schemas import FORECAST_NUM

# The smoothing-weight grid. Beta is a share of alpha and gamma a
# share of 1 - alpha, so the grid spans the whole admissible range.
ALPHAS = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95)
BETA_SHARES = (0.0, 0.05, 0.15, 0.3, 0.5, 0.75, 1.0)
GAMMA_SHARES = (0.0, 0.1, 0.3, 0.5, 0.75, 1.0)
SERIES_PER_CALL = 2048
# Series, pairs and fits that one array holds at a time; months of one product.
CHUNK, PAIRS, FINAL, STEPS = 64, 4096, 512, 8
SHARED = 48             # pairs from which a matrix of their weights pays

FIT_SCHEMA = T.StructType([
    T.StructField("grain", T.StringType()), T.StructField("grain_key", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("segment", T.StringType()),
    T.StructField("month", T.DateType()), T.StructField("value", T.DoubleType()),
    T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType()),
    T.StructField("mae", T.DoubleType()), T.StructField("mape", T.DoubleType()),
    T.StructField("model_used", T.StringType()),
])


def weight_grid(seasonal: bool) -> np.ndarray:
    return np.array([(a, a * b, (1 - a) * g) for a in ALPHAS for b in BETA_SHARES
                     for g in (GAMMA_SHARES if seasonal else (0.0,))], dtype=float)


def _basis(m: int, seasonal: bool) -> np.ndarray:
    """Start-state matrix (states x free parameters); seasonals sum to zero."""
    ns = 2 + (m if seasonal else 0)
    k = 2 + (m - 1 if seasonal else 0)
    x = np.zeros((ns, k))
    x[0, 0] = x[1, 1] = 1.0
    if seasonal:
        for j in range(m - 1):
            x[2 + j, 2 + j] = 1.0
            x[2 + m - 1, 2 + j] = -1.0
    return x


def _step(state: np.ndarray, y, t: int, w, m: int, seasonal: bool) -> np.ndarray:
    """One Holt-Winters update of ``state``, in place: ``state[0]`` level, ``[1]``
    trend, ``[2:]`` seasonal ring, each an array over series, weights (and start
    values). ``w`` (alpha, beta, gamma) broadcasts against them. Returns the
    one-step prediction."""
    a, b, g = w
    lvl, trd = state[0], state[1]
    base = lvl + trd
    if seasonal:
        ring = state[2 + t % m]
        pred = base + ring
        new_l = base + a * (y - pred)
        ring += g * (y - pred)
    else:
        pred = base
        new_l = base + a * (y - base)
    trd *= 1 - b
    trd += b * (new_l - lvl)
    state[0] = new_l
    return pred


def _differences(Y: np.ndarray, m: int, seasonal: bool) -> np.ndarray:
    """(1 - B)(1 - B^m) of each row, or (1 - B)^2: what no start values can reach."""
    d = Y[:, 1:] - Y[:, :-1]
    lag = m if seasonal else 1
    return d[:, lag:] - d[:, :-lag] if d.shape[1] > lag else np.zeros((len(Y), 0))


def _thetas(w: np.ndarray, m: int, seasonal: bool) -> np.ndarray:
    """(U, q + 1): the differenced series as a moving average of the one-step errors, per weights."""
    a, ab, g = w[:, 0], w[:, 0] * w[:, 1], w[:, 2]
    if not seasonal:
        return np.stack([np.ones(len(w)), a + ab - 2, 1 - a], axis=1)
    th = np.zeros((len(w), m + 2))
    th[:, 0] += 1
    th[:, 1] += a + ab - 1
    th[:, m] += g - 1
    th[:, m + 1] += 1 - a - ab - g
    th[:, 2:] += ab[:, None]
    return th


def _bands(w: np.ndarray, size: int, m: int, seasonal: bool):
    """Cholesky factors of the banded covariances theta theta' of ``size`` differences: entries
    (size, q, U), the lags from q down to 1, and inverse diagonals (size, U). A factor's leading
    part is the factor of a shorter series."""
    th = _thetas(w, m, seasonal).T
    q = len(th) - 1
    cov = [(th[:q + 1 - k] * th[k:]).sum(0) for k in range(q + 1)]
    band, inv = np.zeros((size, q, len(w))), np.empty((size, len(w)))
    for t in range(size):
        row = band[t]
        for lag in range(min(t, q), 0, -1):
            row[q - lag] = (cov[lag] - np.einsum("iu,iu->u", row[:q - lag], band[t - lag, lag:])) * inv[t - lag]
        inv[t] = 1.0 / np.sqrt(np.maximum(cov[0] - np.einsum("iu,iu->u", row, row), 1.0))   # the least is 1
    return band, inv


def _whiteners(w: np.ndarray, size: int, m: int, seasonal: bool) -> np.ndarray:
    """Inverse factors (size, U, size): times the differences, they give independent errors whose
    squares add up to the least SSE over all start values, for every length at once."""
    band, inv = _bands(w, size, m, seasonal)
    q, out = band.shape[1], np.zeros((size, len(w), size))
    for t in range(size):
        s = max(0, t - q)
        if t:
            np.einsum("ju,jun->un", band[t, q - (t - s):], out[s:t, :, :t], out=out[t, :, :t])
        out[t, :, :t] *= -inv[t][:, None]
        out[t, :, t] = inv[t]
    return out


GRID_BYTES = 64 << 20


def _kept() -> dict:
    """A dictionary that lives as long as the process, over all its tasks, and is never sent with the code."""
    return sys.modules.setdefault("_skuflow_forecast", types.ModuleType("_skuflow_forecast")).__dict__


def _grid_blocks(size: int, m: int, seasonal: bool):
    """(first grid point, whiteners) of blocks of the grid. One block is kept per Python worker; the
    longest size so far serves shorter ones."""
    grid = weight_grid(seasonal)
    each = max(1, GRID_BYTES // (8 * max(size, 1) ** 2))
    if each >= len(grid):
        name = f"grid {m} {seasonal}"
        hit = _kept().get(name)
        if hit is None or len(hit) < size:
            hit = _kept()[name] = _whiteners(grid, size, m, seasonal)
        yield 0, hit
        return
    for g in range(0, len(grid), each):
        yield g, _whiteners(grid[g:g + each], size, m, seasonal)


def _grid_search(Z: np.ndarray, ends: list[np.ndarray], m: int, seasonal: bool):
    """Best grid point and its least SSE of each row of differences ``Z``, per set of ``ends`` (how
    many differences count)."""
    P, size = Z.shape
    found = [(np.zeros(P, int), np.full(P, np.inf)) for _ in ends]
    order = np.argsort(ends[0], kind="stable")
    for g0, white in _grid_blocks(size, m, seasonal):
        G, wide = white.shape[1:]
        for c0 in range(0, P, CHUNK):
            rows = order[c0:c0 + CHUNK]
            z = np.zeros((wide, len(rows)))
            z[:size] = Z[rows].T
            mine = [e[rows] for e in ends]
            stops = np.unique(np.concatenate([np.arange(STEPS, size, STEPS), *mine]))
            acc, t = np.zeros((G, len(rows))), 0
            for stop in stops[stops >= 0].tolist():
                if stop > t:
                    v = white[t:stop, :, :stop].reshape(-1, stop) @ z[:stop]
                    np.square(v, out=v)
                    acc += v.reshape(stop - t, G, -1).sum(axis=0)
                    t = stop
                for (best, low), end in zip(found, mine):
                    at = np.flatnonzero(end == stop)
                    if len(at):
                        b = np.argmin(acc[:, at], axis=0)
                        s = acc[b, at]
                        first = low[rows[at]]
                        new = ~(s >= first)
                        best[rows[at[new]]], low[rows[at[new]]] = b[new] + g0, s[new]
    return found


def _pair_sse(Z: np.ndarray, ends: list[np.ndarray], rows: np.ndarray, W: np.ndarray, m: int, seasonal: bool) -> list[np.ndarray]:
    """Least SSE of row ``rows[i]`` of the differences under the weights ``W[i]``, per set of ``ends``:
    equal pairs are worked out once, equal weights share their factor."""
    distinct, at = _distinct(W)
    key, back = np.unique(at * np.int64(len(Z)) + rows, return_inverse=True)      # in order of the weights
    at, row = key // len(Z), key % len(Z)
    stop, size = [e[row] for e in ends], Z.shape[1]
    out, edge = [np.zeros(len(row)) for _ in ends], np.searchsorted(at, np.arange(len(distinct) + 1))
    held = np.diff(edge)
    each = max(1, GRID_BYTES // (8 * max(size, 1) ** 2))
    for many in (True, False):
        which = np.flatnonzero((held >= SHARED) == many)
        for g in range(0, len(which), each):
            some = which[g:g + each]
            if many:                # many rows under the same weights: a product with their matrix
                white = _whiteners(distinct[some], size, m, seasonal)
                for i, u in enumerate(some.tolist()):
                    for c0 in range(edge[u], edge[u + 1], PAIRS):
                        part = slice(c0, min(c0 + PAIRS, edge[u + 1]))
                        v = Z[row[part]] @ white[:, i].T
                        _sums(np.square(v, out=v), stop, out, part)
            else:                   # few: each pair solved along the bands
                mine = np.repeat(edge[some], held[some]) + np.arange(held[some].sum()) - np.repeat(np.cumsum(held[some]) - held[some], held[some])
                band, inv = _bands(distinct[some], size, m, seasonal)
                local, q = np.repeat(np.arange(len(some)), held[some]), band.shape[1]
                for c0 in range(0, len(mine), PAIRS):
                    part, of = mine[c0:c0 + PAIRS], local[c0:c0 + PAIRS]
                    z, v = np.ascontiguousarray(Z[row[part]].T), np.zeros((size + q, len(part)))
                    lo, hi = of[0], of[-1] + 1
                    for t in range(size):
                        v[t + q] = (z[t] - np.einsum("jn,jn->n", band[t][:, lo:hi][:, of - lo], v[t:t + q])) * inv[t][of]
                    _sums(np.square(v[q:]).T, stop, out, part)
    return [o[back] for o in out]


def _sums(squares: np.ndarray, stop: list[np.ndarray], out: list[np.ndarray], part) -> None:
    """Sums of the first ``stop`` columns of each row."""
    total = np.zeros((len(squares), squares.shape[1] + 1))
    np.cumsum(squares, axis=1, out=total[:, 1:])
    for o, s in zip(out, stop):
        o[part] = total[np.arange(len(squares)), s[part]]


def _distinct(W: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ``W`` and each row's place among them (by a hash, which is checked)."""
    bits = np.ascontiguousarray(W + 0.0).view(np.uint64)
    h = bits[:, 0] * np.uint64(0x9E3779B97F4A7C15)
    for i in (1, 2):
        h = (h ^ (h >> np.uint64(29)) ^ bits[:, i]) * np.uint64(0xBF58476D1CE4E5B9)
    _, first, at = np.unique(h, return_index=True, return_inverse=True)
    if (W[first][at] != W).any():
        distinct, at = np.unique(W, axis=0, return_inverse=True)
        return distinct, at.ravel()
    return W[first], at


def _final(y: np.ndarray, cu: np.ndarray, w: np.ndarray, m: int, seasonal: bool, horizon: int):
    """Each row of ``y`` fitted on its first ``cu`` values with its own weights ``w`` (p, 3): least-squares
    start values, forecasts (p, horizon) from the state after the last month, and residual sigma (p,)."""
    p, T, x = len(y), int(cu.max(initial=0)), _basis(m, seasonal)
    k, ab = x.shape[1], tuple(w[:, i] for i in range(3))
    live = (np.arange(T)[:, None] < cu).astype(float)                     # (T, p)
    cols = tuple(c[:, None] for c in ab)
    unit = np.broadcast_to(x[:, None, :], (len(x), p, k)).copy()
    R, E, ds = np.empty((T, p, k)), np.empty((T, p)), np.zeros((len(x), p))
    for t in range(T):
        E[t] = (y[:, t] - _step(ds, y[:, t], t, ab, m, seasonal)) * live[t]
        R[t] = _step(unit, 0.0, t, cols, m, seasonal) * live[t][:, None]
    Rt = np.ascontiguousarray(R.transpose(1, 2, 0))                       # (p, k, T)
    A, rte = Rt @ Rt.transpose(0, 2, 1), (Rt @ E.T[..., None])
    ridge = 1e-9 * (np.trace(A, axis1=1, axis2=2)[:, None, None] / k + 1.0) * np.eye(k)
    x0 = np.linalg.solve(A + ridge, rte)[..., 0]
    st, state = x @ x0.T, np.empty((p, len(x)))
    for t in range(T):
        _step(st, y[:, t], t, ab, m, seasonal)
        done = cu == t + 1
        if done.any():
            state[done] = st[:, done].T
    fc, idx = np.zeros((p, horizon)), np.arange(p)
    for h in range(1, horizon + 1):
        fc[:, h - 1] = state[:, 0] + h * state[:, 1] + (state[idx, 2 + (cu + h - 1) % m] if seasonal else 0.0)
    e = E - np.einsum("tpk,pk->tp", R, x0)
    var = (e * e).sum(0) / cu - (e.sum(0) / cu) ** 2
    return fc, np.sqrt(np.maximum(var, 0.0))


def _fit(Y: np.ndarray, cuts: list[np.ndarray], m: int, seasonal: bool, horizon: int, refine: bool = True,
         fixed: tuple | None = None):
    """Fit each row of ``Y`` once per cut set, on its first ``cut`` values. Returns, per cut set,
    forecasts (P, horizon) for the months after the cut and residual sigma (P,).
    ``fixed`` smoothing weights (alpha, beta, gamma) replace the search."""
    P, unknown = len(Y), np.isnan(Y).any(axis=1)
    if unknown.any():           # a missing value spoils no cut that ends before it
        known = _fit(Y[~unknown], [c[~unknown] for c in cuts], m, seasonal, horizon, refine, fixed) if not unknown.all() else None
        out = [(np.zeros((P, horizon)), np.zeros(P)) for _ in cuts]
        for i, c in enumerate(cuts):
            if known:
                out[i][0][~unknown], out[i][1][~unknown] = known[i]
            y = np.where(np.arange(Y.shape[1]) < c[:, None], Y, 0.0)
            lost = np.isnan(y).any(axis=1)
            out[i][0][lost], out[i][1][lost] = np.nan, np.nan
            part = unknown & ~lost
            if part.any():
                (out[i][0][part], out[i][1][part]), = _fit(y[part], [c[part]], m, seasonal, horizon, refine, fixed)
        return out
    if fixed is not None:
        weights = [np.broadcast_to(np.array(fixed, dtype=float), (P, 3))] * len(cuts)
    else:
        Z = _differences(Y, m, seasonal)
        ends = [np.maximum(c - (Y.shape[1] - Z.shape[1]), 0) for c in cuts]
        found, grid = _grid_search(Z, ends, m, seasonal), weight_grid(seasonal)
        weights = [grid[best] for best, _ in found]
        if refine:
            _refine(Z, ends, weights, [low for _, low in found], m, seasonal)
    out = []
    for c, w in zip(cuts, weights):
        fc, sd = np.zeros((P, horizon)), np.zeros(P)
        for i in range(0, P, FINAL):
            fc[i:i + FINAL], sd[i:i + FINAL] = _final(Y[i:i + FINAL], c[i:i + FINAL], w[i:i + FINAL], m, seasonal, horizon)
        out.append((fc, sd))
    return out


# First half-widths of the refinement around the best grid point;
# a row's steps halve when a round lowers its SSE by less than REFINE_GAIN of
# it, and it is done when they are under REFINE_LEAST of the first ones.
REFINE_STEPS = (0.05, 0.05, 0.06)
REFINE_GAIN = 1e-3
REFINE_LEAST = 0.25


def _refine(Z, ends, weights, lows, m, seasonal) -> None:
    """Walk every row from its best grid point to lower SSE, step by step, until it stops falling;
    ``weights`` are updated in place. All sets of ends walk together, so a pair of series and
    weights that several of them come to is worked out once."""
    P, K = len(Z), len(ends)
    w, sse = np.concatenate(weights), np.concatenate(lows)
    scale, rows = np.ones(len(w)), np.arange(len(w))
    while len(rows):
        near = np.round(_neighbours(w[rows], scale[rows], seasonal), 9)   # (p, L, 3)
        L, who, of = near.shape[1], rows % P, rows // P
        all_sse = _pair_sse(Z, ends, np.repeat(who, L), near.reshape(-1, 3), m, seasonal)
        sse2 = np.select([np.repeat(of, L) == k for k in range(K)], all_sse).reshape(-1, L)
        pick, idx = np.argmin(sse2, axis=1), np.arange(len(rows))
        low = sse2[idx, pick]
        better = low < sse[rows] - 1e-9 * (1.0 + np.abs(sse[rows]))
        gained = low < sse[rows] * (1.0 - REFINE_GAIN)
        at = rows[better]
        sse[at], w[at] = low[better], near[better, pick[better]]
        scale[rows[~(better & gained)]] /= 2
        rows = rows[scale[rows] >= REFINE_LEAST]
    for k in range(K):
        weights[k] = w[k * P:(k + 1) * P]


def _neighbours(w: np.ndarray, scale: np.ndarray, seasonal: bool) -> np.ndarray:
    """(p, 3) best weights -> (p, L, 3) candidates around them at each row's step
    scale, kept inside 0 < alpha < 1, 0 <= beta <= alpha, 0 <= gamma <= 1 - alpha."""
    da, db, dg = (s * scale[:, None] for s in REFINE_STEPS)
    if seasonal:  # the axes and the corners: all 27 points rarely find more
        offs = [(i, j, l) for i in (-1, 0, 1) for j in (-1, 0, 1) for l in (-1, 0, 1) if abs(i) + abs(j) + abs(l) in (1, 3)]
    else:
        offs = [(i, j, 0) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]
    o = np.array(offs, dtype=float)
    a = np.clip(w[:, None, 0] + o[None, :, 0] * da, 0.01, 0.99)
    b = np.clip(w[:, None, 1] + o[None, :, 1] * db, 0.0, None)
    b = np.minimum(b, a)
    g = np.clip(w[:, None, 2] + o[None, :, 2] * dg, 0.0, None) if seasonal else np.zeros_like(a)
    g = np.minimum(g, 1 - a)
    return np.stack([a, b, g], axis=-1)


def _fit_local(y: np.ndarray, cu: np.ndarray, W: np.ndarray, m: int, seasonal: bool, horizon: int):
    """Fit each row of ``y`` on its first ``cu`` values for each of its own
    weight candidates ``W`` (p, L, 3); returns the best candidate's forecast
    (p, horizon), residual sigma (p,), SSE (p,) and place (p,)."""
    p, L = W.shape[:2]
    Z, W = _differences(y, m, seasonal), np.round(W, 9)
    ends = np.maximum(cu - (y.shape[1] - Z.shape[1]), 0)
    sse, = _pair_sse(Z, [ends], np.repeat(np.arange(p), L), W.reshape(-1, 3), m, seasonal)
    sse = sse.reshape(p, L)
    best, idx = np.argmin(sse, axis=1), np.arange(p)
    return *_final(y, cu, W[idx, best], m, seasonal, horizon), sse[idx, best], best


def _fit_series(Y: np.ndarray, n: np.ndarray, p: ForecastParams):
    """Backtest fit (all but the last ``holdout`` months) and full fit of each
    series, each with the shape its own fitted length calls for."""
    S = len(Y)
    bt, full = np.zeros((S, p.horizon)), np.zeros((S, p.horizon))
    sd_full = np.zeros(S)
    cut_bt, cut_full = n - p.holdout, n
    seas_bt, seas_full = cut_bt >= p.seasonal_min_len, cut_full >= p.seasonal_min_len
    for flag in (False, True):
        rows = np.nonzero((seas_bt == flag) | (seas_full == flag))[0]
        if not len(rows):
            continue
        (f_bt, _), (f_full, s_full) = _fit(Y[rows], [cut_bt[rows], cut_full[rows]],
                                           p.season_length, flag, p.horizon, fixed=p.fixed_weights)
        a = seas_bt[rows] == flag
        bt[rows[a]] = f_bt[a]
        b = seas_full[rows] == flag
        full[rows[b]], sd_full[rows[b]] = f_full[b], s_full[b]
    return bt, full, sd_full, seas_full


def fit_batch(batch, p: ForecastParams):
    """One Arrow batch of series (a row each, points as (t, units) in any order) -> per series its
    holdout forecast and its forward forecast (with band, accuracy and model) as rows."""
    import pyarrow as pa
    points, n = batch.column("points"), batch.column("n").to_numpy().astype(int)
    S, h = len(n), p.holdout
    Y = np.zeros((S, int(n.max(initial=0))))
    flat = points.flatten()
    Y[np.repeat(np.arange(S), points.value_lengths().to_numpy()), flat.field("t").to_numpy()] = \
        flat.field("units").cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    bt, full, sd_full, seasonal = _fit_series(Y, n, p)
    bt, full = np.clip(bt, 0, None)[:, :h], np.clip(full, 0, None)
    actual = Y[np.arange(S)[:, None], (n - h)[:, None] + np.arange(h)[None, :]]
    mae = np.abs(actual - bt).mean(axis=1)
    nz = actual != 0
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(nz, np.abs((actual - bt) / np.where(nz, actual, 1.0)), 0.0)
        mape = np.where(nz.sum(1) > 0, share.sum(1) / nz.sum(1) * 100.0, np.nan)
    lower = np.clip(full - p.z * sd_full[:, None], 0, None)
    upper = full + p.z * sd_full[:, None]
    first = batch.column("m0").cast(pa.int32()).to_numpy().astype("datetime64[D]").astype("datetime64[M]")
    model = pa.array(["HW-trend", "HW-seasonal"])

    def rows(segment: str, start: np.ndarray, value: np.ndarray, lo=None, hi=None, mae=None, mape=None):
        steps = value.shape[1]
        each = np.repeat(np.arange(S), steps)
        months = (first[:, None] + (start[:, None] + np.arange(steps)).astype("timedelta64[M]")).ravel()

        def numbers(x):
            if x is None:
                return pa.nulls(S * steps, pa.float64())
            return pa.array(x.ravel() if x.ndim == 2 else np.repeat(x, steps), pa.float64(), from_pandas=True)    # no number: null
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(pa.array(each)) for c in ("grain", "grain_key", "category")),
             pa.array([segment]).take(pa.array(np.zeros(len(each), int))), pa.array(months.astype("datetime64[D]")),
             *(numbers(x) for x in (value, lo, hi, mae, mape)), model.take(pa.array(np.repeat(seasonal.astype(int), steps)))],
            names=[f.name for f in FIT_SCHEMA.fields])

    yield rows("holdout_forecast", n - h, bt)
    yield rows("forecast", n, full, lower, upper, mae, mape)


def _ship_code() -> None:
    """Pickle this package's functions by value, so Python workers that cannot
    import ``skuflow`` (another working directory, a cluster node) still run
    the group function."""
    try:
        from pyspark import cloudpickle
        import skuflow
        cloudpickle.register_pickle_by_value(skuflow)
    except (ImportError, AttributeError, ValueError):  # older cloudpickle or already registered
        pass


def fit_series(filled: DataFrame, p: ForecastParams = ForecastParams(),
               series_per_call: int = SERIES_PER_CALL) -> DataFrame:
    """M5 + M6 + M8: one fit of every series in ``filled``, the source of the forecast
    table and of the chart segments. A series is gathered into one row on the JVM; a row
    never meets the other series' points, and a call fits at most ``series_per_call``."""
    _ship_code()
    series = filled.where((F.col("n") >= p.min_len) & F.col("grain").isNotNull() & F.col("grain_key").isNotNull()) \
        .groupBy("grain", "grain_key").agg(F.max("category").alias("category"), F.max("n").alias("n"), F.min("month").alias("m0"),
                                           F.collect_list(F.struct("t", "units")).alias("points"))

    def fit(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, series_per_call):
                yield from fit_batch(batch.slice(i, series_per_call), p)
    return series.mapInArrow(fit, FIT_SCHEMA)


def forecast_rows(fits: DataFrame) -> DataFrame:
    """M9 + M12: the forecast table from `fit_series`."""
    out = fits.where(F.col("segment") == "forecast").select(
        "grain", "grain_key", "category", F.col("month").alias("forecast_month"),
        round_half_up("value", 1).cast(FORECAST_NUM).alias("predicted_units"),
        round_half_up("lo", 1).cast(FORECAST_NUM).alias("lower_bound"),
        round_half_up("hi", 1).cast(FORECAST_NUM).alias("upper_bound"),
        round_half_up("mae", 2).cast(FORECAST_NUM).alias("mae"),
        round_half_up("mape", 1).cast(FORECAST_NUM).alias("mape_pct"), "model_used")
    return out.withColumn("confidence", confidence_label(F.col("mape_pct")))


def holt_winters(filled: DataFrame, p: ForecastParams = ForecastParams(),
                 series_per_call: int = SERIES_PER_CALL) -> DataFrame:
    """M5 + M6 + M8 + M9 + M12: the forecast table for every series in ``filled``."""
    return forecast_rows(fit_series(filled, p, series_per_call))


def segment_rows(filled: DataFrame, fits: DataFrame, p: ForecastParams = ForecastParams()) -> DataFrame:
    """Training history and holdout actuals (from the series), holdout forecast,
    forward forecast and 95 % band (from the stored fit)."""
    part = F.when(F.col("t") < F.col("n") - p.holdout, "train").otherwise("holdout_actual")
    none = F.lit(None).cast("double")
    past = filled.where(F.col("n") >= p.min_len).select(
        "grain", "grain_key", part.alias("segment"), "month", F.col("units").cast("double").alias("value"), none.alias("lo"), none.alias("hi"))
    rows = past.unionByName(fits.select("grain", "grain_key", "segment", "month", "value", "lo", "hi"))
    return rows.select("grain", "grain_key", "segment", "month", round_half_up("value", 2).alias("value"),
                       round_half_up("lo", 2).alias("lo"), round_half_up("hi", 2).alias("hi"))
