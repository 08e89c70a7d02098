"""Singular values and right singular vectors of a small square factor: Householder bidiagonal form, dqds, twisted factorisations."""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
TINY = 1e-300
#: Neighbouring eigenvalues nearer than this, relatively, get vectors that are made orthogonal to each other.
CLUSTER = 1e-5


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor ``v`` of ``r = u @ b @ v.T`` with ``b`` upper bidiagonal."""
    a, size = np.array(r, dtype=np.float64), len(r)
    right = np.eye(size)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        length = np.linalg.norm(x)
        if length == 0 or not np.any(x[1:]):
            return None
        w = x.copy()
        w[0] += np.copysign(length, x[0])
        return w / np.linalg.norm(w)

    for k in range(size):
        w = reflector(a[k:, k])
        if w is not None:
            a[k:, k:] -= 2.0 * np.outer(w, w @ a[k:, k:])
        w = reflector(a[k, k + 1 :]) if k + 1 < size else None
        if w is not None:
            a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ w, w)
            right[:, k + 1 :] -= 2.0 * np.outer(right[:, k + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, float] | None:
    """One differential quotient-difference transform with a shift; None if the shift was too large.

    Also the least ``d`` and the sum of ``1 / d``. Without a shift that sum is the
    trace of the inverse, so that its reciprocal is a lower bound of all eigenvalues.
    """
    d = q[0] - shift
    new_q, new_e, least, inverse = [], [], d, 0.0
    for k in range(len(e)):
        if d < 0.0:
            return None
        inverse += 1.0 / d if d > TINY else 1.0 / TINY
        top = d + e[k]
        ratio = q[k + 1] / top if top > TINY else 1.0
        new_q.append(top)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    if d < 0.0 or d != d:
        return None
    inverse += 1.0 / d if d > TINY else 1.0 / TINY
    return [*new_q, d], new_e, least, inverse


def _trailing(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the last two rows of the squared bidiagonal matrix."""
    a, c, off = q[-2], q[-1] + e[-1], q[-2] * e[-1]
    half = (a + c) / 2
    return max(0.0, (a * c - off) / (half + max(((a - c) / 2) ** 2 + off, 0.0) ** 0.5)) if half else 0.0


def qd_values(q: list[float], e: list[float]) -> list[float]:
    """All eigenvalues of the squared unreduced bidiagonal matrix with squares ``q`` on and ``e`` above the diagonal.

    Shifts are tried at the trailing two rows; one that is too large is replaced by
    the lower bound that an unshifted step gives. Every sum in a step is of
    positive numbers, so that small eigenvalues keep their relative accuracy.
    """
    q, e, found, moved = list(q), list(e), [], 0.0
    if len(q) > 1 and q[0] < q[-1]:  # small ends go last, where they converge first
        q, e = _flipped(q, e)
    while q:
        if len(q) == 1 or e[-1] <= EPS * EPS * (moved + q[-1]) or e[-1] <= TINY:
            found.append(moved + q.pop())
            if e:
                e.pop()
            continue
        shift = _trailing(q, e) * (1 - 1e-3)
        step = _qd_step(q, e, shift) if shift > 0 else None
        if step is None:
            plain = _qd_step(q, e, 0.0)
            q, e = plain[0], plain[1]
            shift = (1 - 8 * EPS * len(q)) / plain[3]
            step = _qd_step(q, e, shift)
            if step is None:
                continue
        q, e, moved = step[0], step[1], moved + shift
    return found


def _flipped(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The same eigenvalues with the order of rows reversed: the qd array of the reversed transpose."""
    tops = [q[k] + (e[k] if k < len(e) else 0.0) for k in range(len(q))]  # diagonal of b @ b.T
    offs = [e[k] * q[k + 1] for k in range(len(e))]  # squared off-diagonal entries
    diag, off = tops[::-1], offs[::-1]
    new_q, new_e, last = [], [], 0.0
    for k, top in enumerate(diag):
        new_q.append(max(top - last, TINY))
        if k < len(off):
            last = off[k] / new_q[-1]
            new_e.append(last)
    return new_q, new_e


def _twisted(d: np.ndarray, l: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """Eigenvector of ``L D L.T`` near ``value`` from the twisted factorisation of the least twist, and that twist."""
    size = len(d)

    def safe(x: float) -> float:
        return x if abs(x) > TINY else TINY

    down, up, s, p = np.zeros(size - 1), np.zeros(size - 1), np.empty(size), np.empty(size)
    s[0] = -value
    for k in range(size - 1):
        pivot = safe(s[k] + d[k])
        down[k] = l[k] * d[k] / pivot
        s[k + 1] = down[k] * l[k] * s[k] - value
    p[-1] = d[-1] - value
    for k in range(size - 2, -1, -1):
        pivot = safe(l[k] * l[k] * d[k] + p[k + 1])
        ratio = d[k] / pivot
        up[k] = l[k] * ratio
        p[k] = p[k + 1] * ratio - value
    twists = s + p + value
    at = int(np.argmin(np.abs(twists)))
    z = np.zeros(size)
    z[at] = 1.0
    for k in range(at - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(at, size - 1):
        z[k + 1] = -up[k] * z[k]
    return z, float(twists[at])


def _vector(d: np.ndarray, l: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector; the eigenvalue is first improved by its Rayleigh quotient."""
    for _ in range(6):
        z, twist = _twisted(d, l, value)
        length = float(z @ z)
        change = twist / length
        if abs(change) <= 4 * EPS * abs(value):
            break
        value += change
    return z / np.sqrt(length)


def _apart(z: np.ndarray, earlier: list[np.ndarray], matrix: np.ndarray, value: float) -> np.ndarray:
    """A unit eigenvector orthogonal to earlier ones of its cluster, by inverse iteration where ``z`` repeats them."""
    basis = np.array(earlier)
    for _ in range(2):
        z = z - basis.T @ (basis @ z)
    if np.linalg.norm(z) < 0.5:
        z = np.random.default_rng(len(earlier)).normal(size=len(z))
        near = matrix - value * (1 + 1e-11) * np.eye(len(z))  # far enough from singular to be solved
        for _ in range(4):
            z = z - basis.T @ (basis @ z)
            z = np.linalg.solve(near, z / np.linalg.norm(z))
            z = z - basis.T @ (basis @ z)
    return z / np.linalg.norm(z)


def right_singular(r: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a square ``r``, falling, and the right singular vectors (columns) of the largest ``number``.

    Negligible superdiagonal entries split the bidiagonal matrix; a zero on its
    diagonal is replaced by one below the rounding error of the whole.
    """
    size = len(r)
    scale = float(np.abs(r).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(size), np.eye(size)[:, :number]
    diagonal, above, right = bidiagonalise(r / scale)
    whole = max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))
    diagonal = np.where(np.abs(diagonal) < 0.01 * EPS * whole, 0.01 * EPS * whole, diagonal)
    q = diagonal**2
    cuts = [k + 1 for k in range(size - 1) if abs(above[k]) <= EPS * 0.01 * whole]
    found: list[tuple[float, int, int]] = []
    for low, high in zip([0, *cuts], [*cuts, size]):
        found += [(v, low, high) for v in qd_values(q[low:high].tolist(), (above[low : high - 1] ** 2).tolist())]
    found.sort(key=lambda f: -f[0])
    vectors = np.zeros((size, min(number, size)))
    clusters: dict[int, tuple[float, list[np.ndarray]]] = {}
    for place, (value, low, high) in enumerate(found[:number]):
        d, l = q[low:high], above[low : high - 1] / diagonal[low : high - 1]
        z = _vector(d, l, value) if high - low > 1 else np.ones(1)
        before, earlier = clusters.get(low, (np.inf, []))
        if earlier and before - value <= CLUSTER * value:
            b = np.diag(diagonal[low:high]) + np.diag(above[low : high - 1], 1)
            z = _apart(z, earlier, b.T @ b, value)
            clusters[low] = (value, [*earlier, z])
        else:
            clusters[low] = (value, [z])
        vectors[:, place] = right[:, low:high] @ z
    return np.array([f[0] for f in found]) * scale * scale, vectors
