"""Many settings of a linear or kernel classifier trained together.

A grid is a table of fits: which feature map, which penalty, which fold is left out.  All of them are solved
at once by Newton steps; the weights of all fits are columns of one matrix, so every gradient, every
Hessian-vector product of the conjugate gradients and every step search is one scan over the rows, whatever the
number of settings.  Features are made from the rows inside the scan and never stored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.partials import array_sums, matrix

_HEX = float(1 << 60)


class Plain:
    """The row's own numbers behind a constant 1 that is not penalised."""

    def __init__(self, dim: int):
        self.size = dim + 1
        self.held = np.arange(self.size) > 0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.ones((len(x), 1)), x])


class Fourier:
    """Random Fourier features of the kernel exp(−‖a − b‖² / σ²): their inner products have it as mean.

    Frequency (j, i) is a normal number from the MD5 of "seed:j:i" by Box and Muller's rule, phase j a uniform one
    from "seed:j"; every task makes them anew, so no matrix is stored or sent.
    """

    def __init__(self, dim: int, sigma: float, size: int = 1024, seed: int = 0):
        self.dim, self.sigma, self.size, self.seed = dim, sigma, size, seed
        self.held = np.ones(size, dtype=bool)
        self._made = None

    def __getstate__(self):
        return self.__dict__ | {"_made": None}

    def _numbers(self) -> tuple[np.ndarray, np.ndarray]:
        if self._made is None:
            hexes = [hashlib.md5(f"{self.seed}:{j}:{i}".encode()).hexdigest() for j in range(self.size) for i in range(self.dim)]
            u = np.array([(int(h[:15], 16), int(h[15:30], 16)) for h in hexes], dtype=float) / _HEX
            normal = np.sqrt(-2.0 * np.log((u[:, 0] * _HEX + 1.0) / (_HEX + 1.0))) * np.cos(2.0 * math.pi * u[:, 1])
            phase = np.array([int(hashlib.md5(f"{self.seed}:{j}".encode()).hexdigest()[:15], 16) for j in range(self.size)], dtype=float) / _HEX
            self._made = normal.reshape(self.size, self.dim) * math.sqrt(2.0) / self.sigma, 2.0 * math.pi * phase
        return self._made

    def frequencies(self) -> np.ndarray:
        return self._numbers()[0]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        w, b = self._numbers()
        return math.sqrt(2.0 / self.size) * np.cos(x @ w.T + b)


@dataclass(frozen=True)
class Fit:
    """One setting: feature map, penalty λ/2 · ‖w‖², and the fold that is left out (None: none)."""

    features: int
    lam: float
    fold: int | None = None


class Logistic:
    """log(1 + exp(−m)) of the margin m = y · score."""

    @staticmethod
    def value(m):
        return np.logaddexp(0.0, -m)

    @staticmethod
    def slope(m):
        return -np.exp(-np.logaddexp(0.0, m))

    @staticmethod
    def bend(m):
        return np.exp(-np.logaddexp(0.0, m) - np.logaddexp(0.0, -m))


class SquaredHinge:
    """max(0, 1 − m)² of the margin m = y · score."""

    @staticmethod
    def value(m):
        return np.maximum(0.0, 1.0 - m) ** 2

    @staticmethod
    def slope(m):
        return -2.0 * np.maximum(0.0, 1.0 - m)

    @staticmethod
    def bend(m):
        return 2.0 * (m < 1.0)


class Grid:
    """Rows with ±1 labels and the fits over them; ``fold`` numbers the folds where fits leave one out."""

    def __init__(self, df: DataFrame, features: Sequence, fits: Sequence[Fit], loss=Logistic, vec: str = "v", label: str = "y", fold: str | None = None):
        own = F.col(fold).cast("int") if fold else F.lit(-1)
        self.rows = df.select(F.col(vec).cast("array<double>").alias("x"), F.col(label).cast("double").alias("y"), own.alias("fold")).cache()
        self.features, self.fits, self.loss = list(features), list(fits), loss
        self.of = [np.array([i for i, f in enumerate(self.fits) if f.features == m], dtype=int) for m in range(len(self.features))]

    def _scan(self, make: Callable[[int, np.ndarray, np.ndarray, np.ndarray], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
        """Σ over batches of ``make(map, features, ±1, mask)`` for every map; mask is 1 where a row counts for a fit of the map."""
        features, of, folds = self.features, self.of, [f.fold for f in self.fits]

        def reduce(batches):
            total: dict[str, np.ndarray] = {}
            for batch in batches:
                for at in range(0, batch.num_rows, 4096):
                    part = batch.slice(at, 4096)
                    x = matrix(part.column(0))
                    y = np.where(part.column(1).to_numpy(zero_copy_only=False) > 0, 1.0, -1.0)
                    fold = part.column(2).to_numpy(zero_copy_only=False)
                    for m, phi in enumerate(features):
                        mask = np.stack([np.ones(len(y)) if folds[i] is None else (fold != folds[i]).astype(float) for i in of[m]], axis=1)
                        for name, value in make(m, phi(x), y[:, None], mask).items():
                            total[f"{m}:{name}"] = total.get(f"{m}:{name}", 0.0) + value
            return total

        return array_sums(self.rows, reduce)

    def _shaped(self, got: dict[str, np.ndarray], name: str) -> list[np.ndarray]:
        """Per fit, its column of what a scan found under ``name``."""
        out = [np.zeros(0)] * len(self.fits)
        for m, fits in enumerate(self.of):
            flat = got.get(f"{m}:{name}", np.zeros(0)).reshape(-1, len(fits)) if len(fits) else np.zeros((0, 0))
            for j, i in enumerate(fits):
                out[i] = flat[:, j]
        return out

    def _stack(self, w: list[np.ndarray]) -> list[np.ndarray]:
        """Per map, the matrix whose columns are the vectors of its fits."""
        return [np.stack([w[i] for i in fits], axis=1) if len(fits) else np.zeros((self.features[m].size, 0)) for m, fits in enumerate(self.of)]

    def _penalty(self, i: int) -> np.ndarray:
        return self.fits[i].lam * self.features[self.fits[i].features].held

    def gradients(self, w: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """(objective, gradient, number of rows) of every fit."""
        loss, at = self.loss, self._stack(w)

        def make(m, phi, y, mask):
            margin = y * (phi @ at[m])
            return {"f": (mask * loss.value(margin)).sum(axis=0), "g": phi.T @ (mask * y * loss.slope(margin)), "n": mask.sum(axis=0)}

        got = self._scan(make)
        n = np.array([v.sum() for v in self._shaped(got, "n")])
        f = np.array([v.sum() for v in self._shaped(got, "f")]) / np.maximum(n, 1)
        g = [(v if len(v) else np.zeros_like(x)) / max(c, 1) for v, c, x in zip(self._shaped(got, "g"), n, w)]
        pen = [self._penalty(i) for i in range(len(w))]
        return f + np.array([0.5 * (p * v * v).sum() for p, v in zip(pen, w)]), [a + p * v for a, p, v in zip(g, pen, w)], n

    def curvatures(self, w: list[np.ndarray], v: list[np.ndarray], n: np.ndarray) -> list[np.ndarray]:
        """Hessian times vector of every fit."""
        loss, at, along = self.loss, self._stack(w), self._stack(v)

        def make(m, phi, y, mask):
            return {"h": phi.T @ (mask * loss.bend(y * (phi @ at[m])) * (phi @ along[m]))}

        got = self._shaped(self._scan(make), "h")
        return [h / max(c, 1) + self._penalty(i) * x for i, (h, c, x) in enumerate(zip(got, n, v))]

    def objectives(self, w: list[np.ndarray], v: list[np.ndarray], steps: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Objective of every fit (rows) at w + step · v for every step (columns)."""
        loss, at, along = self.loss, self._stack(w), self._stack(v)

        def make(m, phi, y, mask):
            a, b = y * (phi @ at[m]), y * (phi @ along[m])
            return {f"s{k}": (mask * loss.value(a + s * b)).sum(axis=0) for k, s in enumerate(steps)}

        got = self._scan(make)
        f = np.stack([[x.sum() for x in self._shaped(got, f"s{k}")] for k in range(len(steps))], axis=1) / np.maximum(n, 1)[:, None]
        pen = np.array([[0.5 * (self._penalty(i) * (a + s * b) ** 2).sum() for s in steps] for i, (a, b) in enumerate(zip(w, v))])
        return f + pen

    def solve(self, tol: float = 1e-8, newton_steps: int = 50, cg_steps: int = 100) -> list[dict]:
        """Every fit at its optimum: rows (fit, weights, objective, grad_norm, n); stops when all gradients are under ``tol``."""
        w = [np.zeros(self.features[f.features].size) for f in self.fits]
        f, g, n = self.gradients(w)
        for _ in range(newton_steps):
            norms = np.array([np.linalg.norm(v) for v in g])
            if (norms <= tol).all():
                break
            step = self._newton(w, g, norms, n, tol, cg_steps)
            slope = np.array([float(a @ b) for a, b in zip(g, step)])
            sizes = 0.5 ** np.arange(12.0)
            tried = self.objectives(w, step, sizes, n)
            fine = tried <= f[:, None] + 1e-4 * sizes * slope[:, None] + 1e-15
            pick = np.where(fine.any(axis=1), sizes[fine.argmax(axis=1)], 0.0)
            if not pick.any():
                break  # rounding is all that is left
            w = [a + s * b for a, s, b in zip(w, pick, step)]
            f, g, n = self.gradients(w)
        return [{"fit": fit, "weights": w[i], "objective": float(f[i]), "grad_norm": float(np.linalg.norm(g[i])), "n": int(n[i])}
                for i, fit in enumerate(self.fits)]

    def _newton(self, w, g, norms, n, tol, cg_steps) -> list[np.ndarray]:
        """Conjugate gradients on H · step = −g for all fits together; one that is done rides along unchanged."""
        x = [np.zeros_like(v) for v in g]
        r = [-v for v in g]
        p = [v.copy() for v in r]
        rr = norms ** 2
        goal = np.maximum((np.minimum(0.1, np.sqrt(norms)) * norms) ** 2, (0.1 * tol) ** 2)
        live = (norms > tol) & (rr > goal)
        for _ in range(cg_steps):
            if not live.any():
                break
            hp = self.curvatures(w, p, n)
            for i in np.flatnonzero(live):
                bend = float(p[i] @ hp[i])
                if bend <= 0:
                    live[i] = False
                    continue
                a = rr[i] / bend
                x[i] = x[i] + a * p[i]
                r[i] = r[i] - a * hp[i]
                new = float(r[i] @ r[i])
                p[i] = r[i] + new / rr[i] * p[i]
                rr[i] = new
                live[i] = new > goal[i]
        return x

    def errors(self, w: list[np.ndarray]) -> list[dict]:
        """Per fit, (wrong, rows) over the rows it was not fitted on: its fold, or all rows where it left none out."""
        at, folds, of = self._stack(w), [f.fold for f in self.fits], self.of

        def make(m, phi, y, mask):
            test = np.stack([mask[:, j] if folds[i] is None else 1.0 - mask[:, j] for j, i in enumerate(of[m])], axis=1)
            return {"wrong": (test * ((phi @ at[m] > 0) != (y > 0))).sum(axis=0), "rows": test.sum(axis=0)}

        got = self._scan(make)
        return [{"fit": fit, "wrong": int(a.sum()), "rows": int(b.sum())}
                for fit, a, b in zip(self.fits, self._shaped(got, "wrong"), self._shaped(got, "rows"))]

    def close(self) -> None:
        self.rows.unpersist()


def cross_validate(df: DataFrame, features: Sequence, lams: Sequence[float], folds: int, loss=Logistic, vec: str = "v", label: str = "y",
                   fold: str = "fold", tol: float = 1e-8) -> list[dict]:
    """M23 + M24: held-out error of every (feature map, λ) over folds 1 … ``folds``, all fits in one run.

    Rows (features, lambda, errors per fold, wrong, rows, error, se, is_best): ``is_best`` marks the smallest error, then the
    first map, then the largest λ.
    """
    fits = [Fit(m, lam, f) for m in range(len(features)) for lam in lams for f in range(1, folds + 1)]
    grid = Grid(df, features, fits, loss, vec, label, fold)
    found = grid.errors([r["weights"] for r in grid.solve(tol)])
    grid.close()
    out = []
    for m in range(len(features)):
        for lam in lams:
            own = [e for e in found if e["fit"].features == m and e["fit"].lam == lam]
            wrong, rows = sum(e["wrong"] for e in own), sum(e["rows"] for e in own)
            shares = [e["wrong"] / e["rows"] for e in own if e["rows"]]
            se = float(np.std(shares, ddof=1) / math.sqrt(len(shares))) if len(shares) > 1 else 0.0
            out.append({"features": m, "lambda": lam, "shares": shares, "wrong": wrong, "rows": rows, "error": wrong / max(rows, 1), "se": se})
    best = min(range(len(out)), key=lambda i: (out[i]["wrong"], out[i]["features"], -out[i]["lambda"]))
    return [r | {"is_best": i == best} for i, r in enumerate(out)]


def feature_error(df: DataFrame, features: Fourier, pairs: int = 200, vec: str = "v", key: str = "vec_id", seed: int = 0) -> float:
    """Root mean squared gap between inner products of features and the kernel, over all pairs of ``pairs`` rows drawn by hash."""
    from lodestar.operators.sampling import hash_order

    x = np.array([r[vec] for r in df.select(key, vec).orderBy(hash_order(key, seed), key).limit(pairs).collect()], dtype=float)
    phi = features(x)
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    return float(np.sqrt(np.mean((phi @ phi.T - np.exp(-d / features.sigma ** 2)) ** 2)))
