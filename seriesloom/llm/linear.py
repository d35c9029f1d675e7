"""Linear models on bounded samples, and hashed byte n-grams."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newton(matrix: np.ndarray, loss, penalty: float, steps: int = 12, inner: int = 12) -> np.ndarray:
    """Minimises penalty/2 |w|^2 + sum(loss(X w)) by Newton steps with conjugate gradients.

    ``loss(scores)`` returns value, first and second derivative per row. Products are taken in
    the type of ``matrix``.
    """
    kind = matrix.dtype
    weights = np.zeros(matrix.shape[1], dtype=kind)

    def at(trial):
        value, first, second = loss((matrix @ trial).astype(np.float64))
        total = value.sum() + penalty / 2 * float(trial @ trial)
        return total, penalty * trial + matrix.T @ first.astype(kind), second.astype(kind)

    best, gradient, second = at(weights)
    start = float(np.linalg.norm(gradient))
    for _ in range(steps):
        if np.linalg.norm(gradient) <= 1e-4 * max(start, 1e-12):
            break
        move, residual = np.zeros_like(weights), -gradient
        direction, size = residual.copy(), float(residual @ residual)
        enough = 1e-3 * size
        for _ in range(inner):
            curved = penalty * direction + matrix.T @ (second * (matrix @ direction))
            step = size / max(float(direction @ curved), 1e-30)
            move += kind.type(step) * direction
            residual -= kind.type(step) * curved
            after = float(residual @ residual)
            if after < enough:
                break
            direction, size = residual + kind.type(after / size) * direction, after
        scale = 1.0
        while scale > 1e-3:
            trial = weights + kind.type(scale) * move
            total, trial_gradient, trial_second = at(trial)
            if total < best:
                weights, best, gradient, second = trial, total, trial_gradient, trial_second
                break
            scale /= 2
        else:
            break
    return weights


def svm(matrix: np.ndarray, target: np.ndarray, cost: np.ndarray | float = 1.0) -> np.ndarray:
    """Squared-hinge support vector machine; ``target`` is -1 or 1."""
    def loss(scores):
        slack = np.maximum(0, 1 - target * scores)
        return cost * slack ** 2, -2 * cost * target * slack, 2 * cost * (slack > 0)
    return newton(matrix, loss, 1.0)


def logistic(matrix: np.ndarray, target: np.ndarray, weight: np.ndarray | float = 1.0, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression; ``target`` may lie anywhere from 0 to 1."""
    def loss(scores):
        chance = 1 / (1 + np.exp(-np.clip(scores, -40, 40)))
        value = weight * (np.logaddexp(0, scores) - target * scores)
        return value, weight * (chance - target), weight * np.maximum(chance * (1 - chance), 1e-9)
    return newton(matrix, loss, penalty)


def sigmoid(scores: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(scores, -40, 40)))


def hashed_ngrams(data: np.ndarray, sizes: tuple[int, ...], dims: int) -> np.ndarray:
    """Square roots of the counts of hashed byte n-grams, scaled to length one; float32."""
    counts = np.zeros(dims, dtype=np.float64)
    wide = data.astype(np.uint32)
    for size in sizes:
        if len(wide) < size:
            continue
        code = np.full(len(wide) - size + 1, size * 2654435761 % (1 << 32), dtype=np.uint32)
        for k in range(size):
            code = (code ^ wide[k:k + len(code)]) * np.uint32(16777619)
        code ^= code >> np.uint32(15)
        counts += np.bincount(code % np.uint32(dims), minlength=dims)
    counts = np.sqrt(counts)
    norm = np.linalg.norm(counts)
    return (counts / norm if norm else counts).astype(np.float32)


def bounded_sample(frame: DataFrame, key: str, group: str, most: int) -> DataFrame:
    """Rows whose hashed key is below a share per ``group``: about ``most`` / (number of groups) each.

    The same rows whatever the partitioning; no group is gathered.
    """
    sizes = {row[0]: row[1] for row in frame.groupBy(group).count().collect()}
    if not sizes:
        return frame
    each, keep, parts = most / len(sizes), F.lit(False), 1_000_000
    place = F.pmod(F.xxhash64(key, F.lit(77)), F.lit(parts))
    for value, count in sizes.items():
        keep = keep | ((F.col(group) == F.lit(value)) & (place < int(min(1.0, each / count) * parts) + 1))
    return frame.filter(keep)
