"""Spectral divide and conquer for small symmetric matrices by the QR-based dynamically weighted Halley iteration (QDWH).

The unitary polar factor of A - sI has the eigenvalue 1 on the eigenvectors of A above the shift s and -1 on those below, so
half of it plus half the identity projects onto the upper invariant subspace. An orthonormal basis of that subspace and
of its complement turns A into two smaller matrices, which are split again until single eigenvectors are left.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
MAX_STEPS = 40


def polar(a: np.ndarray) -> np.ndarray:
    """Unitary polar factor of a square matrix."""
    m = len(a)
    norm = np.sqrt(np.abs(a).sum(0).max() * np.abs(a).sum(1).max())
    if norm == 0:
        return np.eye(m)
    x, eye, low = a / norm, np.eye(m), EPS / 4
    for _ in range(MAX_STEPS):
        # Weights of the step for singular values between `low` and 1.
        d = np.cbrt(4 * (1 - low * low) / low**4)
        h = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d))) / 2
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        low = min(1.0, low * (h + b * low * low) / (1 + c * low * low))
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
        before, x = x, b / c * x + (h - b / c) / np.sqrt(c) * q[:m] @ q[m:].T
        if abs(1 - low) < 10 * EPS and np.linalg.norm(x - before) < np.cbrt(EPS):
            break
    return x


def _parts(a: np.ndarray, shift: float, scale: float, rng: np.random.Generator) -> tuple[np.ndarray, int] | None:
    """Orthogonal basis whose first columns span the invariant subspace above the shift; None if it separates nothing."""
    m = len(a)
    u = polar(a - shift * np.eye(m))
    projector = (u + u.T) / 4 + np.eye(m) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < m:
        return None
    # Twice applied, so that nothing of the complement is left in the basis.
    start, _ = np.linalg.qr(projector @ rng.standard_normal((m, k)))
    basis, _ = np.linalg.qr(projector @ start, mode="complete")
    left = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
    return (basis, k) if left <= 100 * m * EPS * scale else None


def _refined(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """One step of iterative refinement of all eigenvectors; what is too close to part is only made orthogonal."""
    r = np.eye(len(a)) - x.T @ x
    s = x.T @ a @ x
    s = (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    near = 2 * (np.linalg.norm(s - np.diag(values)) + np.linalg.norm(a) * np.linalg.norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1.0), r / 2)
    return x + x @ e


def eigenvectors(a: np.ndarray, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and their unit eigenvectors as columns of a symmetric matrix."""
    a = (a + a.T) / 2
    n, scale, rng = len(a), float(np.linalg.norm(a)), np.random.default_rng(seed)
    vectors, open_parts = [], [(a, np.eye(n))]
    while open_parts:
        part, basis = open_parts.pop()
        m = len(part)
        diagonal = np.diag(part)
        if m == 1 or np.linalg.norm(part - np.diag(diagonal)) <= EPS * scale:
            vectors.append(basis)
            continue
        # The median parts evenly; the mean always lies inside the spectrum; the rest moves off an eigenvalue.
        spread = float(np.linalg.norm(part - diagonal.mean() * np.eye(m))) / np.sqrt(m)
        shifts = [float(np.median(diagonal)), float(diagonal.mean())]
        shifts += [float(diagonal.mean()) + f * spread for f in (0.1, -0.1, 0.37, -0.37, 0.7, -0.7)]
        found = next((p for p in (_parts(part, s, scale, rng) for s in shifts) if p is not None), None)
        if found is None:
            # Equal to rounding: any basis of the subspace serves.
            vectors.append(basis)
            continue
        turn, k = found
        for columns in (turn[:, :k], turn[:, k:]):
            smaller = columns.T @ part @ columns
            open_parts.append(((smaller + smaller.T) / 2, basis @ columns))
    x = np.hstack(vectors) if vectors else np.zeros((0, 0))
    for _ in range(2):
        x = _refined(a, x)
    x = x @ (3 * np.eye(n) - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]
