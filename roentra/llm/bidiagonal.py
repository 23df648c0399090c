"""Singular values and right singular vectors of a small matrix: Householder, dqds, twisted factors."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
# Relative gap below which the vectors of neighbouring values are found together.
CLUSTER_GAP = 1e-3


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(v, beta, alpha): (I - beta v v') x = alpha e1."""
    scale = np.abs(x).max(initial=0.0)
    v = x / scale if scale else x.copy()
    tail = float(v[1:] @ v[1:])
    if not tail:
        return v, 0.0, float(x[0])
    norm = np.sqrt(v[0] * v[0] + tail)
    # Without cancellation whatever the sign of the first entry.
    first = v[0] - norm if v[0] <= 0 else -tail / (v[0] + norm)
    v[0] = first
    return v, 2.0 / (first * first + tail), float(norm * scale)


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, right): ``matrix`` = Q B right' with B upper bidiagonal (diagonal a, above it b)."""
    n = matrix.shape[1]
    # Rows of zeros make up for what a wide matrix lacks.
    work = np.zeros((max(matrix.shape), n))
    work[: len(matrix)] = matrix
    a, b, right = np.zeros(n), np.zeros(max(0, n - 1)), np.eye(n)
    for k in range(n):
        v, beta, a[k] = _reflector(work[k:, k].copy())
        work[k:, k + 1 :] -= np.outer(beta * v, v @ work[k:, k + 1 :])
        if k + 1 < n:
            v, beta, b[k] = _reflector(work[k, k + 1 :].copy())
            work[k + 1 :, k + 1 :] -= np.outer(work[k + 1 :, k + 1 :] @ v, beta * v)
            right[:, k + 1 :] -= np.outer(right[:, k + 1 :] @ v, beta * v)
    return a, b, right


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list, list] | None:
    """One differential quotient-difference transform; None if the shift was too large."""
    new_q, new_e, d = [], [], q[0] - shift
    for above, below in zip(e, q[1:]):
        if d < 0:
            return None
        top = d + above
        ratio = below / top if top else 0.0
        new_q.append(top)
        new_e.append(above * ratio)
        d = d * ratio - shift
    return None if d < 0 else ([*new_q, d], new_e)


def _lowest_of_last_two(q: list[float], e: list[float]) -> float:
    """Smaller eigenvalue of the last two rows and columns of B'B: no less than its smallest."""
    x, y, off = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    high = (x + y) / 2 + np.hypot((x - y) / 2, np.sqrt(off))
    return max(0.0, float((x * y - off) / high)) if high else 0.0


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the bidiagonal matrix, falling, each to high relative accuracy (dqds).

    The smallest value of a block leaves at its end. Shifts add up and never exceed the
    smallest value, so that no transform subtracts what could cancel. A block is cut
    where an entry above its diagonal is lost in rounding beside the values next to it.
    """
    found = []
    blocks = [((np.asarray(a) ** 2).tolist(), (np.asarray(b) ** 2).tolist(), 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        while e:
            lost = [EPS * EPS * (moved + min(pair)) for pair in zip(q, q[1:])]
            cut = next((i for i in reversed(range(len(e))) if e[i] <= lost[i]), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[0] < q[-1] / 2:  # small values are found where they are last
                q, e = q[::-1], e[::-1]
            guess = _lowest_of_last_two(q, e)
            for shift in (guess * (1 - 1e-9), guess * 0.9, guess * 0.3, 0.0):
                done = _transform(q, e, shift)
                if done:
                    (q, e), moved = done, moved + shift
                    break
        found.append(q[0] + moved)
    return np.sort(np.array(found))[::-1]


def _twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B to an eigenvalue, from the factors of B'B - value that meet where
    the middle entry is least."""
    n = len(a)
    tiny = np.finfo(np.float64).tiny
    s, p = np.empty(n), np.empty(n)
    lower, upper = np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):  # stationary, from the top
        pivot = s[i] + a[i] * a[i] or tiny
        lower[i] = a[i] * b[i] / pivot
        s[i + 1] = s[i] * (b[i] * b[i] / pivot) - value
    p[n - 1] = a[n - 1] * a[n - 1] - value
    for i in range(n - 2, -1, -1):  # progressive, from the bottom
        pivot = b[i] * b[i] + p[i + 1] or tiny
        upper[i] = a[i] * b[i] / pivot
        p[i] = p[i + 1] * (a[i] * a[i] / pivot) - value
    twist = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.sqrt(z @ z)


def _clusters(values: np.ndarray) -> list[list[int]]:
    """Runs of neighbours in a falling list that lie closer than ``CLUSTER_GAP``."""
    runs = [[0]] if len(values) else []
    for i in range(1, len(values)):
        near = values[i - 1] - values[i] <= CLUSTER_GAP * values[i - 1]
        runs[-1].append(i) if near else runs.append([i])
    return runs


def _together(a: np.ndarray, b: np.ndarray, values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Vectors of a cluster: inverse iteration on their whole space, then the directions in it."""
    n = len(a)
    gram = np.diag(a * a + np.concatenate([[0.0], b * b]))
    gram += np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    near = gram - np.eye(n) * (values.mean() * (1 + 4 * EPS) + np.finfo(np.float64).tiny)
    # Vectors that came out alike are told apart by a fixed start.
    space = start + 1e-3 * np.random.default_rng(0).normal(size=start.shape) / np.sqrt(n)
    for _ in range(3):
        space, _ = np.linalg.qr(space)
        try:
            space = np.linalg.solve(near, space)
        except np.linalg.LinAlgError:
            near += np.eye(n) * values.mean() * 64 * EPS
    space, _ = np.linalg.qr(space)
    # Differences to the mean, which are all that tells the directions apart.
    inside = space.T @ (near @ space)
    _, turn = np.linalg.eigh((inside + inside.T) / 2)
    return space @ turn[:, ::-1]


def right_vectors(
    a: np.ndarray, b: np.ndarray, right: np.ndarray, values: np.ndarray
) -> np.ndarray:
    """Right singular vectors (columns) of the matrix to the given squared singular values, which
    must end between two clusters or anywhere in one: whole clusters are found."""
    columns = np.stack([_twisted_vector(a, b, v) for v in values], axis=1)
    for run in _clusters(values):
        if len(run) > 1:
            columns[:, run] = _together(a, b, values[run], columns[:, run])
    return right @ columns


def right_singular(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(squares, vectors): the largest ``most`` squared singular values that are not lost in
    rounding, falling, and a unit right singular vector (column) for each."""
    a, b, right = bidiagonalise(matrix)
    values = squared_singular_values(a, b)
    kept = values[values > values.max(initial=0.0) * (len(values) * EPS) ** 2]
    if not len(kept):
        return kept, np.zeros((len(a), 0))
    # A cluster that the limit would cut is found whole first.
    end = min(most, len(kept))
    while 0 < end < len(kept) and kept[end - 1] - kept[end] <= CLUSTER_GAP * kept[end - 1]:
        end += 1
    vectors = right_vectors(a, b, right, kept[:end])
    return kept[:most], vectors[:, :most]
