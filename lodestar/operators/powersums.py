"""Kernel sums over classes without pairs.

A kernel that is a polynomial of the inner product, Σ_j c_j (x · y)^j, is an inner product of tensor powers, so
its sum over two classes is Σ_j c_j ⟨Σ x^{⊗j}, Σ y^{⊗j}⟩: one scan adds up the powers of every class, whatever the number
of rows.  For the Gaussian kernel random frequencies do the same, with an error bar in place of exactness.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.partials import array_sums, matrix
from lodestar.session import domain

#: Numbers that all classes' tensors may have together; beyond, kernels are summed over pairs of blocks.
MOST_NUMBERS = 1 << 22


def degrees(kind: str, param: float) -> list[int] | None:
    """The powers of the inner product whose sum a named kernel is, or None."""
    if kind == "linear":
        return [1]
    if kind == "vovk" and float(param).is_integer() and param >= 1:
        return list(range(int(param)))  # (1 − d^p) / (1 − d)
    return None


def tensor_sum(x: np.ndarray, degree: int) -> np.ndarray:
    """Σ over rows of x ⊗ x ⊗ … (``degree`` times), flat."""
    if degree == 0:
        return np.array([float(len(x))])

    def power(k: int) -> np.ndarray:
        out = np.ones((len(x), 1))
        for _ in range(k):
            out = (out[:, :, None] * x[:, None, :]).reshape(len(x), -1)
        return out

    return (power(degree // 2).T @ power(degree - degree // 2)).ravel()


def fits(df: DataFrame, cls: str, vec: str, kind, param: float) -> list | None:
    """The classes, if the tensors of a kernel that is a sum of powers are small enough; else None."""
    powers = None if callable(kind) else degrees(kind, param)
    if powers is None:
        return None
    first = df.select(F.size(vec).alias("p")).first()
    if first is None:
        return None
    room = MOST_NUMBERS // max(1, sum(max(first["p"], 1) ** j for j in powers))
    classes = df.where(F.col(cls).isNotNull()).select(cls).distinct().limit(room + 1).count()
    return domain(df.where(F.col(cls).isNotNull()), cls, room) if 0 < classes <= room else None


def class_tensors(df: DataFrame, classes: list, cls: str, vec: str, powers: list[int]) -> dict:
    """(class, degree) → Σ x^{⊗degree} over the rows of the class, from one scan."""
    place = {c: i for i, c in enumerate(classes)}

    def reduce(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = matrix(part.column(1))
                own = np.array([place[c] for c in part.column(0).to_pylist()], dtype=int)
                for i in np.unique(own):
                    for j in {0, *powers}:
                        name = f"{i}:{j}"
                        total[name] = total.get(name, 0.0) + tensor_sum(x[own == i], j)
        return total

    got = array_sums(df.where(F.col(cls).isNotNull()).select(F.col(cls), F.col(vec).cast("array<double>")), reduce)
    return {(classes[int(n.split(":")[0])], int(n.split(":")[1])): v for n, v in got.items()}


def class_sums(left: DataFrame, right: DataFrame, classes: tuple[list, list], kind: str, param: float, lcls: str, rcls: str, vec: str) -> DataFrame:
    """(class_i, class_j, ksum, pairs) of a kernel that is a sum of powers."""
    powers = degrees(kind, param)
    a = class_tensors(left, classes[0], lcls, vec, powers)
    b = a if right is left and lcls == rcls else class_tensors(right, classes[1], rcls, vec, powers)
    rows = [(i, j, float(sum(a[i, k] @ b[j, k] for k in powers)), int(a[i, 0][0] * b[j, 0][0])) for i in classes[0] for j in classes[1]]
    return left.sparkSession.createDataFrame(rows, "class_i int, class_j int, ksum double, pairs long")


def row_sums(test: DataFrame, train: DataFrame, classes: list, kind: str, param: float, cls: str, tid: str, vec: str) -> DataFrame:
    """(test_id, label, ksum): the kernel sum of every row of ``test`` with every class of ``train``; the tensors ride along with one scan."""
    powers = degrees(kind, param)
    s = class_tensors(train, classes, cls, vec, powers)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x, ids = matrix(part.column(1)), part.column(0)
                power, sums, done = np.ones((len(x), 1)), np.zeros((len(x), len(classes))), 0
                for k in powers:
                    for _ in range(k - done):
                        power = (power[:, :, None] * x[:, None, :]).reshape(len(x), -1)
                    done = k
                    sums += power @ np.stack([s[c, k] for c in classes], axis=1)
                for i, c in enumerate(classes):
                    yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array([c] * len(x), pa.int32()), pa.array(sums[:, i])], names=["test_id", "label", "ksum"])

    return test.select(F.col(tid).alias("test_id"), F.col(vec).cast("array<double>")).mapInArrow(run, "test_id long, label int, ksum double")


def gaussian_class_sums(df: DataFrame, sigma: float, cls: str = "label", vec: str = "v", size: int = 2048, seed: int = 0) -> DataFrame:
    """(class_i, class_j, ksum, low, high, pairs) for exp(−‖x − y‖² / σ²) from one scan over random frequencies.

    Every frequency gives an unbiased guess of each sum, from the classes' sums of cosines and sines; [low, high] is the mean
    of ``size`` of them with three standard errors.
    """
    from lodestar.operators.grid import Fourier

    classes = domain(df.where(F.col(cls).isNotNull()), cls)
    if not classes:
        return df.sparkSession.createDataFrame([], "class_i int, class_j int, ksum double, low double, high double, pairs long")
    dim = df.select(F.size(vec).alias("p")).first()["p"]
    place, waves = {c: i for i, c in enumerate(classes)}, Fourier(dim, sigma, size, seed)

    def reduce(batches):
        total = np.zeros((len(classes), 2 * size + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                turn = matrix(part.column(1)) @ waves.frequencies().T
                own = np.array([place[c] for c in part.column(0).to_pylist()], dtype=int)
                made = np.hstack([np.cos(turn), np.sin(turn), np.ones((len(turn), 1))])
                for i in np.unique(own):
                    total[i] += made[own == i].sum(axis=0)
        return {"t": total}

    t = array_sums(df.where(F.col(cls).isNotNull()).select(F.col(cls), F.col(vec).cast("array<double>")), reduce)["t"].reshape(len(classes), -1)
    rows = []
    for i, a in enumerate(classes):
        for j, b in enumerate(classes):
            guess = t[i, :size] * t[j, :size] + t[i, size:-1] * t[j, size:-1]
            mean, error = float(guess.mean()), 3 * float(guess.std(ddof=1)) / math.sqrt(size)
            rows.append((a, b, mean, mean - error, mean + error, int(t[i, -1] * t[j, -1])))
    return df.sparkSession.createDataFrame(rows, "class_i int, class_j int, ksum double, low double, high double, pairs long")
