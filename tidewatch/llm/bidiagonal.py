"""Singular values and right singular vectors of a small square matrix, by its bidiagonal form.

Householder reflections from both sides make the matrix upper bidiagonal; differential quotient-difference steps with shifts
(dqds) find its singular values, all of them accurate relative to themselves, as no step subtracts but for the shift; a
factorisation that is twisted where its pivot is least gives the vector of each.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
#: Diagonal entries below this share of the largest are raised to it, so that no quotient has a zero below it.
FLOOR = 1e-20
#: A value is taken as 0 below this many times its size in rounding errors of the largest one.
ZERO = 10
#: Neighbouring values this close, relative to themselves, are taken as one cluster, whose vectors are made orthogonal.
CLUSTER = 1e-3
#: Rounds after which a value that has not come out is an error.
MOST_ROUNDS = 500


def bidiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V): a = U B V^T with an upper bidiagonal B and orthogonal U, V; U is not kept."""
    a = np.array(a, float)
    n = a.shape[0]
    v = np.eye(n)
    for k in range(n):
        w = _reflector(a[k:, k])
        if w is not None:
            a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
        if k + 2 < n:
            w = _reflector(a[k, k + 1 :])
            if w is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ w, w)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit vector w such that x - 2 w (w x) has its first entry alone; None where nothing has to be done."""
    top = np.abs(x).max(initial=0.0)
    if len(x) < 2 or top == 0:
        return None
    w = x / top
    norm = np.sqrt(w @ w)
    w[0] += norm if w[0] >= 0 else -norm
    return w / np.sqrt(w @ w)


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds step: the arrays of the matrix less the shift, and the quantities d whose signs tell whether it is too far."""
    new_q, new_e, ds = [], [], []
    d = q[0] - shift
    for k in range(len(e)):
        ds.append(d)
        if d < 0:
            return new_q, new_e, ds
        total = d + e[k]
        ratio = q[k + 1] / total if total > 0 else 0.0
        new_q.append(total)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
    ds.append(d)
    new_q.append(d)
    return new_q, new_e, ds


def _least_by_rows(q: list[float], e: list[float]) -> float:
    """Bound from below: every singular value is at least some diagonal entry less half of the entries beside it."""
    a, b = [x**0.5 for x in q], [0.0, *(x**0.5 for x in e), 0.0]
    least = min(x - (b[i] + b[i + 1]) / 2 for i, x in enumerate(a))
    return max(least, 0.0) ** 2 * (1 - 4 * EPS)


def _negligible(e: float, above: float, below: float, passed: float) -> bool:
    """Whether an entry is too small to move a value, which the shifts so far are a part of."""
    if e <= EPS**2 * (passed + min(above, below)):
        return True
    return e <= EPS * passed and e * above <= (EPS * passed) ** 2


def squared_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal matrix with diagonal a and superdiagonal b, largest first."""
    found: list[float] = []
    waiting = [((np.asarray(a) ** 2).tolist(), (np.asarray(b) ** 2).tolist(), 0.0)]
    while waiting:
        q, e, passed = waiting.pop()
        rounds = 0
        while q:
            if len(q) == 1:
                found.append(passed + q[0])
                break
            if _negligible(e[-1], q[-2], q[-1], passed):
                found.append(passed + q.pop())
                e.pop()
                rounds = 0
                continue
            cut = next((k for k in range(len(e) - 2, -1, -1) if _negligible(e[k], q[k], q[k + 1], passed)), None)
            if cut is not None:
                waiting.append((q[: cut + 1], e[:cut], passed))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            rounds += 1
            if rounds > MOST_ROUNDS:
                raise ArithmeticError("the quotient-difference steps do not end")
            # Without a shift the d are the reciprocal diagonal of the inverse, whose trace bounds the least value from below.
            q, e, ds = _step(q, e, 0.0)
            shift = max(1.0 / sum(1.0 / max(d, 1e-300) for d in ds), _least_by_rows(q, e))
            while shift > EPS * passed or not passed:
                moved, rest, ds = _step(q, e, shift)
                if min(ds) >= 0:
                    q, e, passed = moved, rest, passed + shift
                    break
                shift *= 0.5
                if shift < 1e-300:
                    break
    return np.sort(np.array(found))[::-1]


def _twisted(q: np.ndarray, ratio: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The factors of L D L^T less a value from the top and from the bottom (multipliers, pivots below), and the pivots that
    the place of the twist would have; D is q, L has `ratio` below its diagonal."""
    n = len(q)
    tiny = EPS * EPS * max(float(q.max()), value)
    down, up, gamma = np.empty(n - 1), np.empty(n - 1), np.empty(n)
    s, from_top = -value, np.empty(n)
    from_top[0] = s
    for i in range(n - 1):
        pivot = s + q[i]
        if abs(pivot) < tiny:
            pivot = -tiny
        down[i] = ratio[i] * q[i] / pivot
        s = down[i] * ratio[i] * s - value
        from_top[i + 1] = s
    p = q[n - 1] - value
    gamma[n - 1] = from_top[n - 1] + p + value
    for i in range(n - 2, -1, -1):
        pivot = q[i] * ratio[i] * ratio[i] + p
        if abs(pivot) < tiny:
            pivot = -tiny
        t = q[i] / pivot
        up[i] = ratio[i] * t
        p = p * t - value
        gamma[i] = from_top[i] + p + value
    return down, up, gamma, from_top


def _vector(q: np.ndarray, ratio: np.ndarray, value: float, against: list[np.ndarray]) -> np.ndarray:
    """The unit vector of a value, orthogonal to those of its cluster found before."""
    n = len(q)
    if n == 1:
        return np.ones(1)
    best, best_rest = None, np.inf
    for _ in range(6):
        down, up, gamma, _ = _twisted(q, ratio, value)
        order = np.argsort(np.abs(gamma))
        for place in order[: len(against) + 1].tolist():
            z = np.zeros(n)
            z[place] = 1.0
            for i in range(place - 1, -1, -1):
                z[i] = -down[i] * z[i + 1]
            for i in range(place, n - 1):
                z[i + 1] = -up[i] * z[i]
            length = np.sqrt(z @ z)
            step = gamma[place] / (length * length)
            z /= length
            for _ in range(2):
                for other in against:
                    z -= (other @ z) * other
            left = np.sqrt(z @ z)
            if left < 0.1:
                continue
            z /= left
            rest = abs(step) / left
            if rest < best_rest:
                best, best_rest = z, rest
            break
        else:
            break
        # A Rayleigh correction, as long as it moves the value within its own accuracy.
        if against or abs(step) <= 2 * EPS * value or abs(step) > 1e-8 * value:
            break
        value += step
    if best is None:
        best = _completion(n, against)
    return best


def _completion(n: int, against: list[np.ndarray]) -> np.ndarray:
    """Some unit vector orthogonal to the given ones."""
    basis = np.array(against)
    z = np.zeros(n)
    z[int(np.argmin((basis**2).sum(axis=0)))] = 1.0
    for _ in range(2):
        z -= basis.T @ (basis @ z)
        z /= np.sqrt(z @ z)
    return z


def right_vectors(a: np.ndarray, b: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(all squared singular values, largest first; matrix whose columns are the first `wanted` right singular vectors)."""
    n = len(a)
    a, b = np.asarray(a, float), np.asarray(b, float)
    top = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if top == 0:
        return np.zeros(n), np.eye(n)[:, :wanted]
    # Signs go into the vectors, the scale into the values.
    sign, left = np.ones(n), np.where(a[0] < 0, -1.0, 1.0)
    for i in range(n - 1):
        sign[i + 1] = (-1.0 if b[i] < 0 else 1.0) * left
        left = (-1.0 if a[i + 1] < 0 else 1.0) * sign[i + 1]
    a, b = np.maximum(np.abs(a) / top, FLOOR), np.abs(b) / top
    # A negligible entry above the diagonal splits the matrix; each part has its own values and vectors.
    edges = [0, *(np.flatnonzero(b <= EPS * np.sqrt(a[:-1] * a[1:])) + 1).tolist(), n]
    found = []
    for low, high in zip(edges, edges[1:], strict=False):
        found += [(float(v), low, high) for v in squared_values(a[low:high], b[low : high - 1])]
    found.sort(key=lambda f: -f[0])
    vectors = np.zeros((n, wanted))
    for j, (value, low, high) in enumerate(found[:wanted]):
        if value <= (ZERO * n * EPS) ** 2 * found[0][0]:
            vectors[:, j] = _completion(n, list(vectors[:, :j].T))
            continue
        q, ratio = a[low:high] ** 2, b[low : high - 1] / a[low : high - 1]
        near, i = [], j - 1
        while i >= 0 and found[i][0] - found[i + 1][0] <= CLUSTER * found[i][0]:
            if found[i][1] == low:
                near.append(vectors[low:high, i])
            i -= 1
        vectors[low:high, j] = _vector(q, ratio, value, near)
    return np.array([f[0] for f in found]) * top * top, vectors * sign[:, None]


def singular_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(squares of all singular values, largest first; the right singular vectors of the first `wanted`, as columns)."""
    a, b, v = bidiagonalise(matrix)
    values, vectors = right_vectors(a, b, wanted)
    return values, v @ vectors
