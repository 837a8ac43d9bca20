"""Generalised Stirling numbers S_d(c, t) for any c, and draws of t under weights made of them.

S_d counts the seatings of c customers at t tables of a Pitman-Yor restaurant, weighted by their
discount factors.  Up to EXACT customers they come from the recurrence.  Beyond it they come from the
generating function S_d(c, t) = c! / t! * [z^c] ((1 - (1 - z)^d) / d)^t in two ways:

- where the saddle point r of that coefficient is well inside the unit circle, the saddle-point value,
  corrected by what the same formula is off at ROW customers for the same position;
- where the singularity at 1 rules (few tables for so many customers), the form
  Gamma(c - d) / (Gamma(1 - d) Gamma(t) d^(t - 1)) times a factor that depends on
  (t - 1) * Gamma(c - 2d) / Gamma(c - d) alone up to small terms, read off the recurrence at ROW.

Factors of c alone are left out: they are the same for all t.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Customers with exact numbers; customers of the row that both approximations are held against.
EXACT, ROW = 256, 1024
#: c * (1 - r) * (1 - d) from which the saddle point is used.
INSIDE = 0.1
#: Log weight below the best that ends a window, and points evaluated in it.
DEEP, POINTS = 20.0, 128
#: log(log(c / t)) between which saddle points are tabulated (further out they are clipped), and places in the table.
NEAR, FAR, PLACES = -30.0, 4.0, 1 << 15


def log_stirling(d: float, n: int) -> np.ndarray:
    """log S_d(c, t) for c, t up to n: S(c + 1, t) = S(c, t - 1) + (c - d * t) * S(c, t)."""
    out = np.full((n + 1, n + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, n + 1)
    for c in range(1, n):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(c - d * t > 0, np.log(np.maximum(c - d * t, 1e-300)), -np.inf) + out[c, 1:]
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay)
    return out


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma of positive numbers: Stirling's series, after a shift by eight where one is below eight."""
    x = y = np.asarray(x, dtype=float)
    if low := bool(np.min(x, initial=8.0) < 8):
        small = x < 8
        y = np.where(small, x + 8, x)
    r = 1 / y
    q = r * r
    out = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + r * (1 / 12 - q * (1 / 360 - q * (1 / 1260 - q / 1680)))
    if low:
        x = np.where(small, x, 1.0)
        # x (x + 1) ... (x + 7) by pairs, x (x + 7) first
        u = x * (x + 7)
        out = np.where(small, out - np.log(u * (u + 6) * (u + 10) * (u + 12)), out)
    return out


def log_rising(a: np.ndarray, t: np.ndarray) -> np.ndarray:
    """log of a * (a + 1) * ... * (a + t - 1), also where a is far larger than t."""
    a, t = np.asarray(a, dtype=float), np.asarray(t, dtype=float)
    big = a > 1e6
    near = None if big.all() else log_gamma(a + t) - log_gamma(a)
    far = t * np.log(a) + (a + t - 0.5) * np.log1p(t / a) - t if big.any() else None
    return near if far is None else far if near is None else np.where(big, far, near)


class Stirling:
    """log S_d(c, t) up to a factor of c."""

    def __init__(self, d: float):
        self.d, row, t = d, np.full(ROW + 1, -np.inf), np.arange(1, ROW + 1)
        self.table = np.full((EXACT + 1, EXACT + 1), -np.inf)
        row[1] = self.table[1, 1] = 0.0
        for c in range(1, ROW):
            stay = np.log(c - d * t[:c]) + row[1 : c + 1]
            row[c + 1] = row[c]
            row[2 : c + 1] = np.logaddexp(row[1:c], stay[1:])
            row[1] = stay[0]
            if c + 1 <= EXACT:
                self.table[c + 1, 1 : c + 2] = row[1 : c + 2]
        self.points = self.tabulated()
        real, at = row[1:] - log_gamma(ROW + 1.0), np.full(ROW, float(ROW))
        self.t, (saddle, _) = t.astype(float), self.saddle(at[:-1], t[:-1].astype(float))
        self.off = np.append(real[:-1] - saddle, 0.0)
        self.factor = real - self.few(at, t.astype(float))

    def tabulated(self) -> np.ndarray:
        """log(-v) of the saddle points r, v = log(1 - r), at PLACES values of log(log(c / t)), evenly spaced from NEAR to FAR."""
        d, target = self.d, np.exp(np.linspace(NEAR, FAR, PLACES))
        v = -np.minimum(2 * target, target - np.log(d)) / (1 - d)  # the function is convex, so Newton's steps settle
        for _ in range(9):
            v = np.minimum(v, -1e-12)
            e, f = -np.expm1(v), -np.expm1(d * v)
            value = np.log(e * d / f) + (d - 1) * v - target
            v = v - value / (-np.exp(v) / e + (d - 1) + d * np.exp(d * v) / f)
        return np.log(-np.minimum(v, -1e-12))

    def saddle(self, c: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Saddle-point value over c! for t < c, and c * (1 - r) * (1 - d).

        r depends on c / t alone and is read off the table, to 1e-7 of v between its places; the value is
        stationary in r, so that costs less than 1e-14 of c.
        """
        d = self.d
        at = np.clip((np.log(np.log1p((c - t) / t)) - NEAR) * ((PLACES - 1) / (FAR - NEAR)), 0, PLACES - 1.001)
        k = at.astype(np.int64)
        low = self.points[k]
        v = np.clip(-np.exp(low + (at - k) * (self.points[k + 1] - low)), -690 / (2 - d), -1e-12)
        s, lift, r = np.exp(v), np.exp((d - 1) * v), -np.expm1(v)
        g = -np.expm1(d * v) / d
        up = lift / g
        bend = r * up * (1 + r * ((1 - d) / s - up))
        return t * np.log(g) - log_gamma(t + 1) - c * np.log(r) - 0.5 * np.log(2 * np.pi * t * bend), c * s * (1 - d)

    def few(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """log of Gamma(c - d) / (c! Gamma(1 - d) Gamma(t) d^(t - 1))."""
        d = self.d
        return -(1 + d) * np.log(c - d / 2) - log_gamma(1 - d) - log_gamma(t) - (t - 1) * np.log(d)

    def log(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """log S_d(c, t) - log c! for c > EXACT and 1 <= t <= c (numbers of any size)."""
        d = self.d
        c, t = np.broadcast_arrays(np.asarray(c, dtype=float), np.asarray(t, dtype=float))
        shape, c, t = c.shape, c.ravel(), t.ravel()
        saddle, inside = self.saddle(c, np.minimum(t, c - 1))
        like = 1 + (t - 1) * ((ROW - (3 * d + 1) / 2) / (c - (3 * d + 1) / 2)) ** d
        out = saddle + np.interp(like, self.t, self.off)
        few = np.flatnonzero((inside < INSIDE) & (like <= ROW))
        if len(few):
            out[few] = self.few(c[few], t[few]) + np.interp(like[few], self.t, self.factor)
        return np.where(t >= c, -log_gamma(c + 1), out).reshape(shape)

    def whole(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """log S_d(c, t), factors of c included, for c >= 0 of any size; -inf where t is more than c or only one of them is 0."""
        c, t = np.broadcast_arrays(np.asarray(c, dtype=np.int64), np.asarray(t, dtype=np.int64))
        out = self.table[np.minimum(c, EXACT), np.minimum(t, EXACT)]
        far = c > EXACT
        if far.any():
            out[far] = np.where((t[far] >= 1) & (t[far] <= c[far]), self.log(c[far], np.clip(t[far], 1, c[far])) + log_gamma(c[far] + 1.0), -np.inf)
        out[(t > c) & ~far] = -np.inf
        out[(c == 0) & (t == 0)] = 0.0
        return out


@lru_cache(maxsize=8)
def stirling(d: float) -> Stirling:
    """``Stirling(d)``, made once a process: every dish of a round has one of three discounts."""
    return Stirling(d)


def draw_large(c: np.ndarray, a: np.ndarray, log_open: np.ndarray, numbers: Stirling, rng: np.random.Generator, more=None, least: np.ndarray | None = None) -> np.ndarray:
    """t for each c > EXACT with weight S_d(c, t) * exp(t * log_open + more(t)) * a * (a + 1) * ... * (a + t - 1), from ``least`` (1) on.

    ``more(rows, t)`` takes places in c and a matrix with a row for each of them.

    The best t is bracketed to a part of its spread by the sign of the difference, then the window where the
    weight is within exp(-DEEP) of the best, at most twice too wide on both sides.  A window of at most POINTS
    numbers is summed number by number; of a wider one the weight is taken at POINTS of its numbers, as
    log-linear between them.
    """
    c, a, log_open = (np.asarray(x, dtype=float) for x in (c, a, log_open))

    def weight(rows, t):
        out = numbers.log(c[rows, None], t) + t * log_open[rows, None] + log_rising(a[rows, None], t)
        return out if more is None else out + more(rows, t)

    every = np.arange(len(c))
    start = np.ones(len(c)) if least is None else np.clip(np.asarray(least, dtype=float), 1, c)
    best, rise = bracketed(start, c, lambda rows, t: np.diff(weight(rows, t[:, None] + np.array([0.0, 1.0])))[:, 0])
    floor = weight(every, best[:, None]) - DEEP
    ends = np.stack([start, c], axis=1)
    reach = np.abs(ends - best[:, None])
    out = np.minimum(reach, 1 + np.ceil(4 * np.sqrt(rise))[:, None])

    def at(rows, k):
        return np.clip(best[rows, None] + k * [-1.0, 1.0], ends[rows, :1], ends[rows, 1:])

    rows = every
    while len(rows):  # outwards
        short = (out[rows] < reach[rows]) & (weight(rows, at(rows, out[rows])) >= floor[rows])
        out[rows] = np.where(short, np.minimum(2 * out[rows], reach[rows]), out[rows])
        rows = rows[short.any(axis=1)]
    rows = every
    while len(rows):  # and back
        half = np.floor(out[rows] / 2)
        wide = (out[rows] > POINTS / 4) & (weight(rows, at(rows, half)) < floor[rows])
        out[rows] = np.where(wide, half, out[rows])
        rows = rows[wide.any(axis=1)]
    low, high = at(every, out).T
    step = np.maximum(1, np.ceil((high - low + 1) / POINTS))
    last = np.floor((high - low) / step).astype(np.int64)
    t, drawn, order = np.empty(len(c)), rng.random((2, len(c))), np.argsort(last, kind="stable")
    for rows in np.split(order, np.searchsorted(last[order], [16, 32, 64])):
        if len(rows):
            t[rows] = windows_drawn(low[rows], step[rows], last[rows], lambda t, rows=rows: weight(rows, np.minimum(t, c[rows, None])), drawn[:, rows])
    return np.clip(t, 1, c).astype(np.int64)


def bracketed(low: np.ndarray, high: np.ndarray, gain) -> tuple[np.ndarray, np.ndarray]:
    """About where ``gain(rows, t)``, falling with t from ``low`` to below ``high``, changes its sign: within a part of the spread, whose square is at most what is returned beside it.

    False position over log t with halved values (every third step the middle of the logarithms), on the rows still open.
    """
    low, high = low.copy(), high.copy()
    every = np.arange(len(low))
    some = high > low
    left, right = np.full(len(low), -1.0), np.full(len(low), -1.0)
    if some.any():
        rows = every[some]
        left[rows], right[rows] = gain(rows, low[rows]), gain(rows, high[rows] - 1)
    top, side = high.copy(), np.zeros(len(low))
    high = np.where(left <= 0, low, high)
    low = np.where(right > 0, high, low)
    tolerance = lambda k: 1 + 0.25 * np.sqrt(np.minimum(low[k], top[k] - high[k] + 1))
    rows, n = every[high - low > tolerance(every)], 0
    while len(rows):
        x, y, f, g = np.log(low[rows]), np.log(high[rows]), left[rows], right[rows]
        middle = np.exp((x + y) / 2 if n % 3 == 2 else (y * f - x * g) / (f - g))
        middle = np.clip(np.floor(middle), low[rows] + 1, high[rows] - 1)
        value = gain(rows, middle)
        up = value > 0
        # the value of an end that stays twice is halved
        right[rows] = np.where(up, np.where(side[rows] > 0, g / 2, g), value)
        left[rows] = np.where(up, value, np.where(side[rows] < 0, f / 2, f))
        side[rows] = np.where(up, 1, -1)
        low[rows], high[rows] = np.where(up, middle, low[rows]), np.where(up, high[rows], middle)
        rows, n = rows[high[rows] - low[rows] > tolerance(rows)], n + 1
    best = np.where(right > 0, high, np.floor((low + high + 1) / 2))
    return best, np.minimum(best, top - best + 1)


def windows_drawn(low: np.ndarray, step: np.ndarray, last: np.ndarray, weight, drawn: np.ndarray) -> np.ndarray:
    """A number for each window, whose points stand ``step`` apart from ``low`` on, the ``last`` one included."""
    k = np.arange(int(last.max()) + 2)
    at = low[:, None] + k * step[:, None]
    logw = np.where(k <= last[:, None], weight(at), -np.inf)
    logw -= logw.max(axis=1, keepdims=True)
    w = np.exp(logw)
    # a wide window: cells between neighbouring points, each with the mass of a trapezoid
    wide = step > 1
    w[wide, :-1] = (w[wide, :-1] + w[wide, 1:]) / 2
    w[wide, -1] = 0
    total = np.cumsum(w, axis=1)
    cell = np.minimum((total <= (drawn[0] * total[:, -1])[:, None]).sum(axis=1), last)
    rows = np.arange(len(low))
    t = at[rows, cell]
    # inside a cell by the weights at its ends (linear density)
    left, right = np.exp(logw[rows, cell]), np.exp(logw[rows, np.minimum(cell + 1, len(k) - 1)])
    u, gap = drawn[1], right - left
    with np.errstate(divide="ignore", invalid="ignore"):
        x = np.where(np.abs(gap) > 1e-9 * (left + right), (np.sqrt(left**2 + u * (right**2 - left**2)) - left) / gap, u)
    return np.where(wide, np.floor(t + x * step + 0.5), t)
