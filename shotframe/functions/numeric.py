"""Small array routines that Spark has no function for; used inside tasks or on one collected profile."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from shotframe.functions.splines import spline_roots


def least_squares(residual: Callable[[np.ndarray], np.ndarray], start: np.ndarray, steps: int = 60) -> np.ndarray:
    """Levenberg-Marquardt with a forward-difference slope; residuals that are no number are left out."""
    p, damp = np.asarray(start, float), 1e-3
    clean = lambda q: np.nan_to_num(residual(q), nan=0.0, posinf=0.0, neginf=0.0)
    r = clean(p)
    for _ in range(steps):
        slope = np.empty((len(r), len(p)))
        for k in range(len(p)):
            d = 1e-6 * max(1.0, abs(p[k]))
            q = p.copy()
            q[k] += d
            slope[:, k] = (clean(q) - r) / d
        a, g = slope.T @ slope, slope.T @ r
        for _ in range(12):
            move = np.linalg.lstsq(a + damp * np.diag(np.maximum(np.diag(a), 1e-12)), -g, rcond=None)[0]
            fresh = clean(p + move)
            if fresh @ fresh < r @ r:
                break
            damp *= 4
        else:
            break
        gain = (r @ r - fresh @ fresh) / max(r @ r, 1e-300)
        p, r, damp = p + move, fresh, damp / 3
        if gain < 1e-12:
            break
    return p


def gaussian(x: np.ndarray, amp: float, center: float, sigma: float, base: float) -> np.ndarray:
    return amp * np.exp(-((x - center) ** 2) / (2 * sigma**2)) + base


def fit_gaussian(x: np.ndarray, y: np.ndarray) -> dict[str, float]:
    """amp, center, sigma, base: begun at the largest value, or at the least if its size is larger, a twentieth of the range
    wide, above the least value."""
    ok = np.isfinite(x) & np.isfinite(y)
    x, y = x[ok], y[ok]
    if len(x) < 4:
        return dict.fromkeys(("amp", "center", "sigma", "base"), float("nan"))
    at = int(y.argmax() if y.max() > abs(y.min()) else y.argmin())
    amp, center, sigma, base = least_squares(lambda p: gaussian(x, *p) - y, np.array([y[at], x[at], max((x.max() - x.min()) / 20, 1e-12), y.min()]))
    return {"amp": float(amp), "center": float(center), "sigma": float(abs(sigma)), "base": float(base)}


def step_response(y: np.ndarray) -> np.ndarray:
    """y convolved with a kernel of ones in its first half and zeros in its second, same length; the place of its
    extreme is where a step in y lies."""
    kernel = np.zeros(len(y))
    kernel[: len(y) // 2] = 1
    return np.convolve(np.nan_to_num(y), kernel, mode="same")


def step_time(x: np.ndarray, y: np.ndarray) -> float:
    return float(x[int(np.argmax(step_response(y)))]) if len(x) else float("nan")


def fwhm(x: np.ndarray, y: np.ndarray, places: np.ndarray | None = None) -> float:
    """Distance of the two places where the cubic spline through a curve crosses half its maximum, along places if given; of a
    gaussian fitted over x if there are not just two, or fewer than four points."""
    if not len(y):
        return float("nan")
    along = x if places is None else places
    if len(y) > 3 and np.isfinite(y).all() and (np.diff(along) > 0).all():
        roots = spline_roots(along, y - y.max() / 2)
        if len(roots) == 2:
            return float(roots[1] - roots[0])
    return fit_gaussian(x, y)["sigma"] * float(np.sqrt(8 * np.log(2)))


def prominent_peaks(profiles: np.ndarray, prominence: float = 1.0, distance: int = 10, height: float = -np.inf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(profile, place, prominence) of the peaks of many profiles (profile, element) at once: strict local maxima (middles of
    flat tops) of at least height, no two of a profile nearer than distance (the higher stay, of equal ones the later), standing
    out from their surroundings by prominence or more. Values that are no number count as the least."""
    n, size = profiles.shape
    wall = np.full((n, 1), np.inf)  # no peak reaches, and no search goes, beyond a profile's ends
    z = np.concatenate((wall, np.where(np.isnan(profiles), -np.inf, profiles), wall), axis=1).ravel()
    first = np.flatnonzero(np.concatenate(([True], z[1:] != z[:-1]))) if len(z) else np.empty(0, int)
    level, last = z[first], np.append(first[1:], len(z)) - 1
    top = np.flatnonzero((level[1:-1] > level[:-2]) & (level[1:-1] > level[2:]) & (level[1:-1] < np.inf) & (level[1:-1] >= height)) + 1
    at = (first[top] + last[top]) // 2
    owner, place = at // (size + 2), at % (size + 2) - 1
    # spacing: by falling height, one peak of each profile at a time
    order = np.lexsort((-place, -z[at], owner))
    rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
    taken, keep = np.zeros((n, size), bool), np.zeros(len(at), bool)
    for r in range(int(rank.max(initial=-1)) + 1):
        k = order[rank == r]
        k = k[~taken[owner[k], place[k]]]
        keep[k] = True
        for off in range(1 - distance, distance):
            near = place[k] + off
            ok = (near >= 0) & (near < size)
            taken[owner[k[ok]], near[ok]] = True
    at, owner, place = at[keep], owner[keep], place[keep]
    rise = z[at] - np.maximum(_lowest_before(z)[at], _lowest_before(z[::-1])[::-1][at])
    out = rise >= prominence
    return owner[out], place[out], rise[out]


def _lowest_before(z: np.ndarray) -> np.ndarray:
    """Of each element the least value between it and the last greater one before it, its own if there is none between. All
    elements search at once: each leaps over what others have found to be no greater."""
    jump, low = np.arange(len(z)) - 1, z.copy()
    active = np.arange(1, len(z))
    while True:
        active = active[(jump[active] >= 0)]
        active = active[z[jump[active]] <= z[active]]
        if not len(active):
            return low
        over = jump[active]
        leap, least = jump[over], np.minimum(low[active], np.minimum(low[over], z[over]))  # as found so far, before any moves
        jump[active], low[active] = leap, least


def local_peaks(y: np.ndarray, prominence: float = 1.0, distance: int = 10, height: float = -np.inf) -> np.ndarray:
    """Places of one profile's peaks: see prominent_peaks."""
    return prominent_peaks(np.asarray(y, float)[None, :], prominence, distance, height)[1]


def bilinear(image: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Values between pixels; outside the image not a number."""
    r0, c0 = np.floor(rows).astype(int), np.floor(cols).astype(int)
    ok = (r0 >= 0) & (c0 >= 0) & (r0 < image.shape[0] - 1) & (c0 < image.shape[1] - 1)
    r0, c0, a, b = r0[ok], c0[ok], rows[ok] - np.floor(rows[ok]), cols[ok] - np.floor(cols[ok])
    out = np.full(rows.shape, np.nan)
    out[ok] = image[r0, c0] * (1 - a) * (1 - b) + image[r0 + 1, c0] * a * (1 - b) + image[r0, c0 + 1] * (1 - a) * b + image[r0 + 1, c0 + 1] * a * b
    return out
