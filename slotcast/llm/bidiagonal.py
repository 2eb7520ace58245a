"""Singular values and right singular vectors of a small square matrix by bidiagonal qd transforms.

Householder reflections make the matrix upper bidiagonal, dqds with shifts that never pass
the smallest value finds all singular values to high relative accuracy, and twisted
factorisations give the vectors. Everything here is of the size of the vectors' dimension.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
NEGLIGIBLE = (10 * EPS) ** 2
CLOSE = 1e-3  # relative distance below which neighbouring vectors are made orthogonal to each other
SWEEPS = 200  # per value; far beyond what the shifts need


def bidiagonalise(r):
    """Diagonal, superdiagonal and V with R = U B V'; U is not kept."""
    r = np.array(r, float)
    n = len(r)
    v = np.eye(n)
    for k in range(n):
        w = _reflector(r[k:, k])
        r[k:, k:] -= 2 * np.outer(w, w @ r[k:, k:])
        if k < n - 2:
            w = _reflector(r[k, k + 1:])
            r[k:, k + 1:] -= 2 * np.outer(r[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(r).copy(), np.diag(r, 1).copy(), v


def _reflector(x):
    """Unit w so that x - 2 w (w'x) is a multiple of the first axis; zero for a zero vector."""
    size = np.abs(x).max(initial=0.0)
    if size == 0:
        return np.zeros(len(x))
    w = x / size
    w[0] += np.copysign(np.sqrt(w @ w), w[0] or 1.0)
    return w / np.sqrt(w @ w)


def blocks(diagonal, upper):
    """(first, past) of the parts between negligible superdiagonal entries."""
    size = EPS * max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0))
    cut = [i + 1 for i in range(len(upper)) if abs(upper[i]) <= 4 * size]
    edges = [0, *cut, len(diagonal)]
    return list(zip(edges[:-1], edges[1:]))


def _dqds(q, e, shift):
    """One transform with a shift: new q and e, and the d's whose sign tells whether the shift was too large."""
    n = len(q)
    new_q, new_e, ds = [0.0] * n, [0.0] * (n - 1), [0.0] * n
    d = q[0] - shift
    for i in range(n - 1):
        ds[i] = d
        total = d + e[i]
        new_q[i] = total
        ratio = q[i + 1] / total if total else 0.0
        new_e[i] = e[i] * ratio
        d = d * ratio - shift if total else q[i + 1] - shift
    ds[-1] = new_q[-1] = d
    return new_q, new_e, ds


def squared_singular_values(diagonal, upper):
    """Eigenvalues of B'B, unsorted. Shifts: 1 / sum(1/d) of a step without shift is never above the smallest."""
    out = []
    work = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in upper], 0.0)]
    while work:
        q, e, moved = work.pop()
        left = SWEEPS * len(q)
        while len(q) > 1:
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]  # the small end belongs at the bottom
            while len(q) > 1 and e[-1] <= NEGLIGIBLE * (moved + q[-1]):
                out.append(moved + q.pop())
                e.pop()
            cut = next((i for i in range(len(e)) if e[i] <= NEGLIGIBLE * (moved + min(q[i], q[i + 1]))), None)
            if cut is not None:
                work.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if len(q) < 2:
                break
            left -= 1
            if left < 0:
                raise ArithmeticError("qd transforms did not converge")
            q, e, d = _dqds(q, e, 0.0)
            low = min(d)
            if low <= 0:
                continue
            shift = 1.0 / sum(1.0 / x for x in d)
            while shift > 0:
                trial = _dqds(q, e, shift)
                if min(trial[2]) >= 0:
                    q, e, _ = trial
                    moved += shift
                    break
                shift = shift / 2 if shift > EPS * low else 0.0
        out += [moved + x for x in q]
    return np.array(out)


class Twisted:
    """Factorisation of B'B - value for an eigenvalue of an unreduced block.

    The factorisations from the top and from the bottom meet where their mismatch is least.
    """

    def __init__(self, diagonal, upper, value):
        n = len(diagonal)
        a2, b2, ab = diagonal ** 2, upper ** 2, diagonal[:-1] * upper
        least = EPS ** 2 * value
        s, p, self.pivots = np.empty(n), np.empty(n), np.empty(n)
        self.down, self.up = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
        below = np.empty(max(n - 1, 0))
        s[0] = -value
        for i in range(n - 1):
            self.pivots[i] = _away(s[i] + a2[i], least)
            self.down[i] = ab[i] / self.pivots[i]
            s[i + 1] = b2[i] * (s[i] / self.pivots[i]) - value
        p[-1] = a2[-1] - value
        for i in range(n - 2, -1, -1):
            below[i] = _away(b2[i] + p[i + 1], least)
            self.up[i] = ab[i] / below[i]
            p[i] = a2[i] * (p[i + 1] / below[i]) - value
        gamma = s + p + value
        self.at = int(np.argmin(np.abs(gamma)))
        self.pivots[self.at] = _away(gamma[self.at], least)
        self.pivots[self.at + 1:] = below[self.at:]

    def spread(self, x):
        """Solves the transposed factor: from the twist outwards."""
        for i in range(self.at - 1, -1, -1):
            x[i] -= self.down[i] * x[i + 1]
        for i in range(self.at, len(x) - 1):
            x[i + 1] -= self.up[i] * x[i]
        size = np.abs(x).max()
        if not 0 < size < np.inf:
            return np.zeros(len(x))
        x /= size
        return x / np.sqrt(x @ x)

    def vector(self):
        z = np.zeros(len(self.pivots))
        z[self.at] = 1.0
        return self.spread(z)

    def solved(self, z):
        """The direction of (B'B - value)^-1 z."""
        y = np.array(z)
        for i in range(self.at):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(len(y) - 2, self.at - 1, -1):
            y[i] -= self.up[i] * y[i + 1]
        y /= self.pivots
        return self.spread(y / (np.abs(y).max() or 1.0))


def right_singular(r):
    """(squared singular values, right singular vectors in columns), largest value first.

    Vectors are given for the values above rounding level only. Those of neighbouring values
    within an unreduced block are made orthogonal to each other.
    """
    diagonal, upper, v = bidiagonalise(r)
    largest = max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0))
    if not largest:
        return np.zeros(len(v)), np.zeros((len(v), 0))
    diagonal, upper, least = diagonal / largest, upper / largest, (len(v) * EPS) ** 2
    values, vectors = [], []
    for a, z in blocks(diagonal, upper):
        d, u = diagonal[a:z], upper[a:z - 1]
        found = np.sort(squared_singular_values(d, u))[::-1]
        basis, first = np.zeros((len(v), z - a)), 0
        for k, x in enumerate(found[found > least]):
            if k and found[k - 1] - x > CLOSE * found[k - 1]:
                first = k
            factors = Twisted(d, u, x)
            basis[a:z, k] = _apart(factors.vector(), basis[a:z, first:k], factors)
        values += list(found)
        vectors.append(v @ basis)
    values = np.array(values)
    order = np.argsort(-values, kind="stable")
    rank = int((values > least * values.max()).sum())
    return values[order] * largest ** 2, np.concatenate(vectors, 1)[:, order[:rank]]


def _away(x, least):
    """x, moved away from zero."""
    return x if abs(x) > least else np.copysign(least, x)


def _apart(z, others, factors):
    """z made orthogonal to the columns of ``others``; where little of z is left, inverse iteration beside them."""
    def without(x):
        return x - others @ (others.T @ x)

    x = without(z)
    for attempt in range(4):
        if x @ x > 0.1:
            break
        start = x = without(np.random.default_rng(attempt).standard_normal(len(z)))
        for _ in range(4):
            x = without(factors.solved(x / np.sqrt(x @ x)))
            if not x @ x > 1e-20:
                x = start
    x = without(x / np.sqrt(x @ x))
    return x / np.sqrt(x @ x)
