"""Per-series ARIMA(p, d, q) in NumPy: p, q up to 3, d up to 2.

This is the small helper that ``forecast.arima_forecast`` runs inside
``mapInPandas``: one call sees a chunk of series (each at most one value per
day), never the whole table, and fits them together, vectorised over series
and grid points.

Model: after ``d`` differences, ``w_t = phi*w_{t-1} + z_t + theta*z_{t-1}``
without a constant (with d = 0 the series mean is removed first). The exact
Gaussian likelihood comes from the innovations recursion for ARMA(1,1)
(Brockwell & Davis, Time Series: Theory and Methods, ch. 5):

    r_0 = (1 + 2*theta*phi + theta^2) / (1 - phi^2),  x_1 = 0
    e_t = w_t - x_t;  S += e_t^2 / r;  L += ln r
    x_{t+1} = phi*w_t + (theta / r) * e_t;  r <- 1 + theta^2 - theta^2 / r

and ``n*ln(S/n) + L`` is minimised over a (phi, theta) grid that is
refined around the best point a few times, deterministic and robust, and then
by Newton steps: the recursion is differentiated along with itself (the score
recursion), and a step counts only where the likelihood rises.
Forecasts: ``w_{T+h} = phi^(h-1) * x_{T+1}``, then undo the difference.

Other orders use the same concentrated likelihood computed by a Kalman
filter on the state-space form (stationary start from the Lyapunov
equation), searched coordinate by coordinate on zooming grids; candidates
outside the stationary / invertible region are rejected. For ARMA(1,1) the
two likelihoods agree exactly (tested). The ``phi`` / ``theta`` outputs
carry the first AR / MA coefficient.
"""

from __future__ import annotations

import numpy as np

GRID = 15
ZOOMS = 5
LIMIT = 0.99
MIN_DIFFS = 3
NEWTON_STEPS = 12
SCORE_STEP = 1e-5

STATUS_OK = "ok"
STATUS_FLAT = "flat"
STATUS_FAILED = "failed"


MAX_P = MAX_Q = 3
MAX_D = 2
SWEEPS = 3


def check_order(order: tuple[int, int, int]) -> tuple[int, int, int]:
    p, d, q = (int(x) for x in order)
    if not (0 <= p <= MAX_P and 0 <= q <= MAX_Q and 0 <= d <= MAX_D):
        raise ValueError(
            f"order {order!r} not supported: need p, q in 0..{MAX_P} and d in 0..{MAX_D}"
        )
    return p, d, q


def neg_profile_loglik(w: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """``n*ln(S/n) + sum(ln r)`` for one series and every (phi[i], theta[i])."""
    return neg_profile_loglik_many(w[None, :], np.array([len(w)]), phi[None, :], theta[None, :])[0]


def _live_counts(n: np.ndarray, T: int) -> np.ndarray:
    """For lengths sorted in descending order: how many series are live at t."""
    return np.searchsorted(-n, -np.arange(T), side="left")


def neg_profile_loglik_many(
    w: np.ndarray, n: np.ndarray, phi: np.ndarray, theta: np.ndarray
) -> np.ndarray:
    """The same for S series at once.

    ``w`` is (S, T) padded on the right with series sorted by length
    (longest first), ``n`` the lengths (S,), ``phi`` and ``theta`` (S, G)
    grids; returns (S, G). One pass over time, vectorised over series and
    grid points; at step t only the still-live prefix of series is updated.
    """
    th2 = theta * theta
    r = (1.0 + 2.0 * theta * phi + th2) / (1.0 - phi * phi)
    x = np.zeros_like(phi)
    s = np.zeros_like(phi)
    logr = np.zeros_like(phi)
    live = _live_counts(n, w.shape[1])
    for t in range(w.shape[1]):
        k = live[t]
        wt = w[:k, t : t + 1]
        rk, xk = r[:k], x[:k]
        e = wt - xk
        s[:k] += e * e / rk
        logr[:k] += np.log(rk)
        x[:k] = phi[:k] * wt + (theta[:k] / rk) * e
        r[:k] = 1.0 + th2[:k] - th2[:k] / rk
    nn = n[:, None].astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return nn * np.log(s / nn) + logr


def one_step_state_many(w: np.ndarray, n: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """One-step prediction ``x_{T+1}`` per series at its fitted (phi, theta);
    same layout as ``neg_profile_loglik_many`` with one grid point."""
    return _state(w, n, phi[:, None], theta[:, None])[:, 0]


def _state(w, n, phi, theta):
    th2 = theta * theta
    r = (1.0 + 2.0 * theta * phi + th2) / (1.0 - phi * phi)
    x = np.zeros_like(phi)
    live = _live_counts(n, w.shape[1])
    for t in range(w.shape[1]):
        k = live[t]
        wt = w[:k, t : t + 1]
        rk = r[:k]
        e = wt - x[:k]
        x[:k] = phi[:k] * wt + (theta[:k] / rk) * e
        r[:k] = 1.0 + th2[:k] - th2[:k] / rk
    return x


def one_step_state(w: np.ndarray, phi: float, theta: float) -> float:
    """The one-step prediction ``x_{T+1}`` after all observations."""
    return float(one_step_state_many(w[None, :], np.array([len(w)]), np.array([phi]), np.array([theta]))[0])


def _axis(center: np.ndarray, half: float, use: bool) -> np.ndarray:
    if not use:
        return np.zeros((len(center), 1))
    steps = np.linspace(-half, half, GRID)[None, :]
    return np.clip(center[:, None] + steps, -LIMIT, LIMIT)


def fit_arma11_many(w: np.ndarray, n: np.ndarray, use_phi: bool, use_theta: bool) -> tuple[np.ndarray, np.ndarray]:
    """Grid-and-zoom maximum likelihood for every series of ``w``."""
    S = w.shape[0]
    if not use_phi and not use_theta:
        return np.zeros(S), np.zeros(S)
    c_phi, c_th, half = np.zeros(S), np.zeros(S), LIMIT
    for _ in range(ZOOMS + 1):
        ph, th = _axis(c_phi, half, use_phi), _axis(c_th, half, use_theta)
        pp = np.repeat(ph, th.shape[1], axis=1)
        tt = np.tile(th, (1, ph.shape[1]))
        f = neg_profile_loglik_many(w, n, pp, tt)
        f = np.where(np.isfinite(f), f, np.inf)
        i = np.argmin(f, axis=1)
        rows = np.arange(S)
        c_phi, c_th = pp[rows, i], tt[rows, i]
        half = 2.0 * half / (GRID - 1)
    return newton_steps(w, n, c_phi, c_th, use_phi, use_theta)


def score_many(w: np.ndarray, n: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of ``n*ln(S/n) + L`` by phi and by theta; layout as ``neg_profile_loglik_many``.

    Every quantity of the recursion carries its two derivatives.
    """
    th2, gap = theta * theta, 1.0 - phi * phi
    top = 1.0 + 2.0 * theta * phi + th2
    r, r_p, r_t = top / gap, (2.0 * theta * gap + 2.0 * phi * top) / (gap * gap), 2.0 * (phi + theta) / gap
    x, x_p, x_t, s, s_p, s_t, l_p, l_t = (np.zeros_like(phi) for _ in range(8))
    live = _live_counts(n, w.shape[1])
    for t in range(w.shape[1]):
        k = live[t]
        wt, th, q = w[:k, t : t + 1], theta[:k], th2[:k]
        rk, rp, rt = r[:k], r_p[:k], r_t[:k]
        e, ep, et = wt - x[:k], -x_p[:k], -x_t[:k]
        s[:k] += e * e / rk
        s_p[:k] += (2.0 * ep - e * rp / rk) * e / rk
        s_t[:k] += (2.0 * et - e * rt / rk) * e / rk
        l_p[:k] += rp / rk
        l_t[:k] += rt / rk
        gain = th / rk
        x[:k] = phi[:k] * wt + gain * e
        x_p[:k] = wt - gain * rp / rk * e + gain * ep
        x_t[:k] = (1.0 - gain * rt) / rk * e + gain * et
        r[:k], r_p[:k], r_t[:k] = 1.0 + q - q / rk, q * rp / (rk * rk), 2.0 * th - 2.0 * gain + q * rt / (rk * rk)
    nn = n[:, None].astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return nn * s_p / s + l_p, nn * s_t / s + l_t


def newton_steps(
    w: np.ndarray, n: np.ndarray, phi: np.ndarray, theta: np.ndarray, use_phi: bool, use_theta: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Newton steps from a good start, all series at once.

    The second derivatives are differences of the score. Where they do not
    curve upwards the score alone gives the direction. Of the full step and its
    halves the best is taken if it is better than staying.
    """
    at = np.stack([phi, theta])
    used = [i for i, u in enumerate((use_phi, use_theta)) if u]
    for _ in range(NEWTON_STEPS):
        points = np.repeat(at[:, :, None], 1 + 2 * len(used), axis=2)
        for j, i in enumerate(used):
            points[i, :, 1 + 2 * j] += SCORE_STEP
            points[i, :, 2 + 2 * j] -= SCORE_STEP
        score = np.stack(score_many(w, n, *np.clip(points, -LIMIT, LIMIT)))[used]
        width = np.stack([np.clip(at[i] + SCORE_STEP, -LIMIT, LIMIT) - np.clip(at[i] - SCORE_STEP, -LIMIT, LIMIT) for i in used])
        curve = np.stack([(score[:, :, 1 + 2 * j] - score[:, :, 2 + 2 * j]) / width[j] for j in range(len(used))])
        curve = (curve + curve.transpose(1, 0, 2)) / 2
        here = score[:, :, 0]
        if len(used) == 2:
            det = curve[0, 0] * curve[1, 1] - curve[0, 1] ** 2
            upward = (det > 1e-9) & (curve[0, 0] > 0)
            safe = np.where(upward, det, 1.0)
            step = -np.stack([curve[1, 1] * here[0] - curve[0, 1] * here[1], curve[0, 0] * here[1] - curve[0, 1] * here[0]]) / safe
        else:
            upward = curve[0, 0] > 1e-9
            step = -here / np.where(upward, curve[0, 0], 1.0)
        step = np.where(upward & np.isfinite(step).all(axis=0), step, -here / (1e-9 + np.abs(here).sum(axis=0)) * 1e-3)
        move = np.zeros_like(at)
        move[used] = np.nan_to_num(step)
        tried = np.clip(at[:, :, None] + move[:, :, None] * np.array([0.0, *(0.5**k for k in range(10))]), -LIMIT, LIMIT)
        f = neg_profile_loglik_many(w, n, *tried)
        best = np.argmin(np.where(np.isfinite(f), f, np.inf), axis=1)
        at = tried[:, np.arange(len(w)), best]
        if not best.any():
            break
    return at[0], at[1]


def fit_arma11(w: np.ndarray, use_phi: bool, use_theta: bool) -> tuple[float, float]:
    phi, theta = fit_arma11_many(w[None, :], np.array([len(w)]), use_phi, use_theta)
    return float(phi[0]), float(theta[0])


# --------------------------------------------------------------------------
# General ARMA(p, q): exact likelihood from the state-space form
#   a_t = T a_{t-1} + R z_t,  w_t = a_t[0],  r = max(p, q + 1)
#   T = [phi | shift], R = (1, theta_1, ..., theta_{r-1})
# with the stationary initial covariance (discrete Lyapunov equation) and
# the Kalman filter run for every series and candidate at once.
# --------------------------------------------------------------------------
def _state_matrices(phi: np.ndarray, theta: np.ndarray, r: int):
    """phi (..., p), theta (..., q) -> T (..., r, r), R (..., r)."""
    lead = phi.shape[:-1]
    T = np.zeros(lead + (r, r))
    T[..., : phi.shape[-1], 0] = phi
    for i in range(r - 1):
        T[..., i, i + 1] = 1.0
    R = np.zeros(lead + (r,))
    R[..., 0] = 1.0
    R[..., 1 : 1 + theta.shape[-1]] = theta
    return T, R


def _roots_outside(coef: np.ndarray, sign: float) -> np.ndarray:
    """True where 1 + sign*(c1 z + c2 z^2 + ...) has all roots outside the unit circle."""
    out = np.ones(coef.shape[:-1], dtype=bool)
    if coef.shape[-1] == 0:
        return out
    flat = coef.reshape(-1, coef.shape[-1])
    ok = np.empty(len(flat), dtype=bool)
    for i, c in enumerate(flat):
        poly = np.concatenate([[1.0], sign * c])[::-1]  # highest power first
        poly = np.trim_zeros(poly, "f")
        ok[i] = len(poly) <= 1 or bool(np.all(np.abs(np.roots(poly)) > 1.0 + 1e-6))
    return ok.reshape(coef.shape[:-1])


def kalman_negloglik_many(w: np.ndarray, n: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """``n*ln(S/n) + sum(ln F_t)`` for S series x G candidates.

    ``w`` (S, T) sorted longest first and right-padded, ``phi`` (S, G, p),
    ``theta`` (S, G, q). Non-stationary or non-invertible candidates get inf.
    """
    S, G = phi.shape[:2]
    p, q = phi.shape[-1], theta.shape[-1]
    r = max(p, q + 1)
    T, R = _state_matrices(phi, theta, r)
    ok = _roots_outside(phi, -1.0) & _roots_outside(theta, 1.0)
    # stationary covariance: vec(P) = (I - T kron T)^-1 vec(R R')
    kron = np.einsum("...ij,...kl->...ikjl", T, T).reshape(S, G, r * r, r * r)
    rhs = np.einsum("...i,...j->...ij", R, R).reshape(S, G, r * r)
    eye = np.eye(r * r)
    safe = np.where(ok[..., None, None], eye - kron, eye)
    P = np.linalg.solve(safe, rhs[..., None])[..., 0].reshape(S, G, r, r)
    RR = np.einsum("...i,...j->...ij", R, R)
    a = np.zeros((S, G, r))
    ssq = np.zeros((S, G))
    logf = np.zeros((S, G))
    live = _live_counts(n, w.shape[1])
    for t in range(w.shape[1]):
        k = live[t]
        Pk, ak, Tk = P[:k], a[:k], T[:k]
        F = np.maximum(Pk[..., 0, 0], 1e-300)
        v = w[:k, t][:, None] - ak[..., 0]
        ssq[:k] += v * v / F
        logf[:k] += np.log(F)
        K = np.einsum("...ij,...j->...i", Tk, Pk[..., :, 0]) / F[..., None]
        a[:k] = np.einsum("...ij,...j->...i", Tk, ak) + K * v[..., None]
        TPT = np.einsum("...ij,...jk,...lk->...il", Tk, Pk, Tk)
        P[:k] = TPT + RR[:k] - np.einsum("...i,...j->...ij", K, K) * F[..., None, None]
    nn = n[:, None].astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        f = nn * np.log(ssq / nn) + logf
    return np.where(ok, f, np.inf), a, T


def fit_arma_many(w: np.ndarray, n: np.ndarray, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinate-wise zooming grid search for (phi_1..p, theta_1..q) per series."""
    S, k = w.shape[0], p + q
    x = np.zeros((S, k))
    half = np.full(k, LIMIT)
    for _ in range(SWEEPS):
        for j in range(k):
            for _zoom in range(ZOOMS // 2 + 1):
                grid = np.clip(x[:, j : j + 1] + np.linspace(-half[j], half[j], GRID)[None, :], -2.0, 2.0)
                cand = np.repeat(x[:, None, :], GRID, axis=1)
                cand[:, :, j] = grid
                f, _, _ = kalman_negloglik_many(w, n, cand[..., :p], cand[..., p:])
                f = np.where(np.isfinite(f), f, np.inf)
                best = np.argmin(f, axis=1)
                x[:, j] = grid[np.arange(S), best]
                half[j] = max(2.0 * half[j] / (GRID - 1), 1e-3)
            half[j] = LIMIT / 2
    return x[:, :p], x[:, p:]


def _forecast_general(ws: list[np.ndarray], horizon: int, p: int, q: int):
    n = np.array([len(w) for w in ws])
    W = np.zeros((len(ws), int(n.max())))
    for j, w in enumerate(ws):
        W[j, : len(w)] = w
    phi, theta = fit_arma_many(W, n, p, q)
    _, a, T = kalman_negloglik_many(W, n, phi[:, None, :], theta[:, None, :])
    a, T = a[:, 0], T[:, 0]
    steps = np.zeros((len(ws), horizon))
    for h in range(horizon):
        steps[:, h] = a[:, 0]
        a = np.einsum("sij,sj->si", T, a)
    return steps, phi, theta


def _undo_difference(y: np.ndarray, w_forecast: np.ndarray, d: int) -> np.ndarray:
    """Integrate ``d`` times, starting from the last observed levels."""
    levels = [y]
    for _ in range(d):
        levels.append(np.diff(levels[-1]))
    out = w_forecast
    for k in range(d, 0, -1):
        out = levels[k - 1][-1] + np.cumsum(out)
    return out


def forecast_guarded(
    ys: list[np.ndarray], horizon: int, order=(1, 1, 1), coefficients: tuple[float, float] | None = None
) -> list[tuple[np.ndarray, str, float, float]]:
    """``forecast_many`` where a series that cannot be fitted is reported as
    'failed' with NaN forecasts and leaves the others as they are."""
    none = (np.full(horizon, np.nan), STATUS_FAILED, np.nan, np.nan)
    sound = [i for i, y in enumerate(ys) if np.isfinite(y).all()]
    out = [none] * len(ys)
    try:
        results = forecast_many([ys[i] for i in sound], horizon, order, coefficients)
    except Exception:  # one of them: find it by fitting each alone
        results = []
        for i in sound:
            try:
                results += forecast_many([ys[i]], horizon, order, coefficients)
            except Exception:
                results.append(none)
    for i, r in zip(sound, results):
        out[i] = r if np.isfinite(r[0]).all() else none
    return out


def forecast_many(
    ys: list[np.ndarray], horizon: int, order=(1, 1, 1), coefficients: tuple[float, float] | None = None
) -> list[tuple[np.ndarray, str, float, float]]:
    """Forecast ``horizon`` steps after each series in ``ys`` (each ordered,
    positional). Too-short or zero-variance series get a flat forecast at
    their last value with status 'flat'. Returns (values, status, phi, theta)
    per series, in input order."""
    p, d, q = check_order(order)
    out: list = [None] * len(ys)
    fit_idx, ws = [], []
    for i, y in enumerate(ys):
        y = np.asarray(y, dtype=float)
        if len(y) == 0 or horizon <= 0:
            out[i] = (np.zeros(0), STATUS_FLAT, 0.0, 0.0)
            continue
        w = np.diff(y, n=d) if d >= 1 else y - y.mean()
        if len(w) < max(MIN_DIFFS, p + q + 1) or not np.isfinite(w).all() or np.var(w) == 0.0:
            out[i] = (np.full(horizon, y[-1]), STATUS_FLAT, 0.0, 0.0)
            continue
        fit_idx.append(i)
        ws.append(w)
    if ws and (p > 1 or q > 1):
        by_len = sorted(range(len(ws)), key=lambda j: -len(ws[j]))
        fit_idx = [fit_idx[j] for j in by_len]
        ws = [ws[j] for j in by_len]
        steps, phi, theta = _forecast_general(ws, horizon, p, q)
        for j, i in enumerate(fit_idx):
            y = np.asarray(ys[i], dtype=float)
            vals = _undo_difference(y, steps[j], d) if d >= 1 else y.mean() + steps[j]
            out[i] = (vals, STATUS_OK, float(phi[j][0]) if p else 0.0, float(theta[j][0]) if q else 0.0)
        return out
    if ws:
        by_len = sorted(range(len(ws)), key=lambda j: -len(ws[j]))  # live series form a prefix
        fit_idx = [fit_idx[j] for j in by_len]
        ws = [ws[j] for j in by_len]
        n = np.array([len(w) for w in ws])
        W = np.zeros((len(ws), int(n.max())))
        for j, w in enumerate(ws):
            W[j, : len(w)] = w
        if coefficients is None:
            phi, theta = fit_arma11_many(W, n, p == 1, q == 1)
        else:  # given, zero where the order has no such term
            phi = np.full(len(ws), coefficients[0] * (p == 1))
            theta = np.full(len(ws), coefficients[1] * (q == 1))
        x1 = one_step_state_many(W, n, phi, theta)
        powers = np.arange(horizon)
        for j, i in enumerate(fit_idx):
            y = np.asarray(ys[i], dtype=float)
            steps = x1[j] * phi[j] ** powers
            vals = _undo_difference(y, steps, d) if d >= 1 else y.mean() + steps
            out[i] = (vals, STATUS_OK, float(phi[j]), float(theta[j]))
    return out


def forecast_values(y: np.ndarray, horizon: int, order=(1, 1, 1)) -> tuple[np.ndarray, str, float, float]:
    """Single-series form of ``forecast_many``."""
    return forecast_many([np.asarray(y, dtype=float)], horizon, order)[0]
