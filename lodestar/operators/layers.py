"""Data-parallel layered networks (M16, M17, M15, F12, M27): losses and gradients for ``nets.train``.

A network is one flat weight array; its shape is a list of layer sizes.  Partitions compute gradient
sums with NumPy on Arrow batches (``nets.gradient_sum``), so rows never leave the executors, and the
weights leave training as a table (K1) that scores any number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from lodestar.operators.blocks import matrix

# value and slope (in terms of the value) of each activation
ACTIVATIONS: dict[str, tuple[Callable, Callable]] = {
    "sigmoid": (lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500))), lambda a: a * (1 - a)),
    "relu": (lambda z: np.maximum(z, 0), lambda a: (a > 0).astype(float)),
    "linear": (lambda z: z, lambda a: np.ones_like(a)),
}


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Layers:
    """Forward pass and gradients of fully connected layers with biases.

    ``loss`` is "cross_entropy" (softmax over classes 0, 1, ...), "squared" (half the squared error of
    every output) or "softplus" (log(1 + exp(−y·f)) with targets ±1).  Class labels are turned into one
    target column per output; a list of targets is used as it is.
    """

    def __init__(self, sizes: Sequence[int], hidden: str = "sigmoid", loss: str = "cross_entropy"):
        self.sizes, self.hidden, self.loss = list(sizes), hidden, loss
        self.shapes = [(a + 1, b) for a, b in zip(sizes, sizes[1:])]
        self.n_weights = sum(a * b for a, b in self.shapes)

    def start(self, seed: int = 0) -> np.ndarray:
        rng = np.random.default_rng(seed)
        return np.concatenate([rng.normal(0, 1 / np.sqrt(a), (a, b)).ravel() for a, b in self.shapes])

    def split(self, w: np.ndarray) -> list[np.ndarray]:
        cuts = np.cumsum([a * b for a, b in self.shapes])[:-1]
        return [part.reshape(shape) for part, shape in zip(np.split(np.asarray(w), cuts), self.shapes)]

    def forward(self, x: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
        """The input, every hidden layer's values, and the last layer's raw outputs."""
        values, parts = [x], self.split(w)
        for i, part in enumerate(parts):
            z = values[-1] @ part[1:] + part[0]
            values.append(z if i == len(parts) - 1 else ACTIVATIONS[self.hidden][0](z))
        return values

    def outputs(self, x: np.ndarray, w: np.ndarray) -> np.ndarray:
        z = self.forward(x, w)[-1]
        return _softmax(z) if self.loss == "cross_entropy" else z

    def targets(self, y: np.ndarray) -> np.ndarray:
        y = np.asarray(y)
        if y.ndim == 2:
            return y
        if self.sizes[-1] == 1:
            return y.astype(float)[:, None]
        hot = (y.astype(int)[:, None] == np.arange(self.sizes[-1])).astype(float)
        return hot * 2 - 1 if self.loss == "softplus" else hot

    def gradient(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
        """Sums over the rows of the gradient and of the loss."""
        values, parts = self.forward(x, w), self.split(w)
        z, t = values[-1], self.targets(y)
        if self.loss == "cross_entropy":
            p = _softmax(z)
            back, total = p - t, -np.log(np.maximum((p * t).sum(axis=1), 1e-300)).sum()
        elif self.loss == "squared":
            back = z - t
            total = 0.5 * (back * back).sum()
        else:
            back, total = -t / (1 + np.exp(np.clip(t * z, -500, 500))), np.logaddexp(0, -t * z).sum()
        grads = []
        for i in range(len(parts) - 1, -1, -1):
            grads.append(np.vstack([back.sum(axis=0), values[i].T @ back]).ravel())
            if i:
                back = (back @ parts[i][1:].T) * ACTIVATIONS[self.hidden][1](values[i])
        return np.concatenate(grads[::-1]), float(total)

    @property
    def quadratic(self) -> bool:
        """Whether gradient and loss sums at any weights follow from ``moments``: the loss is a quadratic form of the weights."""
        return self.loss == "squared" and len(self.sizes) == 2

    def moments(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Σ zzᵀ over rows z = (1, inputs, targets)."""
        z = np.column_stack([np.ones(len(x)), x, self.targets(y)])
        return z.T @ z

    def gradient_of(self, moments: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
        """``gradient`` of all rows behind ``moments`` (quadratic losses only)."""
        (part,) = self.split(w)
        a = len(part)
        cross = moments[:a, a:]
        g = moments[:a, :a] @ part - cross
        return g.ravel(), float(0.5 * ((part * (g - cross)).sum() + np.trace(moments[a:, a:])))

    def biases(self) -> np.ndarray:
        """Where the flat array holds biases, which carry no penalty."""
        return np.concatenate([np.r_[np.ones(b), np.zeros((a - 1) * b)] for a, b in self.shapes]).astype(bool)


def weights_table(spark: SparkSession, net: Layers, w: np.ndarray, model_id: str) -> DataFrame:
    """The weights as rows (model_id, layer, i, values), as ``sinks.save_model`` keeps them; i = 0 is the bias."""
    rows = [(model_id, layer, i, [float(v) for v in row]) for layer, part in enumerate(net.split(w)) for i, row in enumerate(part)]
    return spark.createDataFrame(rows, "model_id string, layer int, i int, values array<double>")


def from_table(weights: DataFrame) -> np.ndarray:
    """The flat weights of one model's table."""
    rows = weights.select("layer", "i", "values").collect()  # one model
    return np.concatenate([np.asarray(r["values"]) for r in sorted(rows, key=lambda r: (r["layer"], r["i"]))])


def mlp_score(df: DataFrame, net: Layers, w: np.ndarray, vec: str = "v", out: str = "outputs") -> DataFrame:
    """the network's outputs for every row, a batch at a time."""
    from pyspark.sql import functions as F

    schema = df.withColumn(out, F.lit(None).cast("array<double>")).schema

    def run(batches):
        for pdf in batches:
            yield pdf.assign(**{out: list(net.outputs(matrix(pdf[vec]), w))})

    return df.mapInPandas(run, schema)


def layer_values(df: DataFrame, net: Layers, w: np.ndarray, layer: int, vec: str = "v", out: str = "values") -> DataFrame:
    """The values of a hidden layer (1 = first) for every row; 0 gives the input."""
    from pyspark.sql import functions as F

    schema = df.withColumn(out, F.lit(None).cast("array<double>")).schema

    def run(batches):
        for pdf in batches:
            yield pdf.assign(**{out: list(net.forward(matrix(pdf[vec]), w)[layer])})

    return df.mapInPandas(run, schema)


def error_rate(scored: DataFrame, label: str, out: str = "outputs") -> float:
    """Share of rows whose largest output is not their label."""
    from pyspark.sql import functions as F

    guess = F.array_position(out, F.array_max(out)) - 1
    return float(scored.agg(F.avg((guess != F.col(label)).cast("double"))).first()[0])


def rows_of(pdf: pd.DataFrame, vec: str, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and targets of a batch; list targets become a matrix."""
    y = pdf[label]
    return matrix(pdf[vec]), matrix(y) if len(y) and hasattr(y.iloc[0], "__len__") else y.to_numpy(dtype=np.float64)
