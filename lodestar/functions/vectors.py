"""Column expressions over dense vectors stored as ``array<double>``.

Everything here is a built-in higher-order function, so it stays inside the
JVM (no Python worker); operators that need block linear algebra use the
Arrow paths in ``lodestar.operators.blocks`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_doubles(v: ColumnOrName) -> Column:
    """``array<float>`` → ``array<double>`` (exact widening; compute in double)."""
    return _c(v).cast("array<double>")


def vsum(v: ColumnOrName) -> Column:
    return F.aggregate(_c(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a: ColumnOrName, b: ColumnOrName) -> Column:
    return vsum(F.zip_with(_c(a), _c(b), lambda x, y: x * y))


def sq_dist(a: ColumnOrName, b: ColumnOrName) -> Column:
    return vsum(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)))


def l2norm(a: ColumnOrName) -> Column:
    return F.sqrt(vsum(F.transform(_c(a), lambda x: x * x)))


def l2_distance(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.sqrt(sq_dist(a, b))


def cosine(a: ColumnOrName, b: ColumnOrName) -> Column:
    return dot(a, b) / (l2norm(a) * l2norm(b))


def rbf(a: ColumnOrName, b: ColumnOrName, sigma: float) -> Column:
    """exp(-||a-b||^2 / sigma^2), without a factor 2."""
    return F.exp(-sq_dist(a, b) / F.lit(float(sigma) ** 2))


def vovk(a: ColumnOrName, b: ColumnOrName, p: int) -> Column:
    """(1 - <a,b>^p) / (1 - <a,b>), with its limit p at <a,b> = 1."""
    d = dot(a, b)
    return F.when(d == 1.0, F.lit(float(p))).otherwise((1.0 - F.pow(d, float(p))) / (1.0 - d))


def sigmoid(x: ColumnOrName) -> Column:
    return 1.0 / (1.0 + F.exp(-_c(x)))


def relu(x: ColumnOrName) -> Column:
    return F.greatest(_c(x), F.lit(0.0))


def softmax(v: ColumnOrName) -> Column:
    """Max-shifted softmax of an array column."""
    arr = _c(v)
    m = F.array_max(arr)
    ex = F.transform(arr, lambda x: F.exp(x - m))
    total = vsum(ex)
    return F.transform(ex, lambda x: x / total)


def one_hot(label: ColumnOrName, k: int) -> Column:
    lab = _c(label)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == lab).cast("int"))


def argmax(v: ColumnOrName) -> Column:
    """0-based position of the first maximum."""
    arr = _c(v)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def argmin(v: ColumnOrName) -> Column:
    arr = _c(v)
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")


def add_intercept(v: ColumnOrName) -> Column:
    return F.concat(F.array(F.lit(1.0)), _c(v))


def average_adjacent(v: ColumnOrName, g: int) -> Column:
    """Mean of each run of ``g`` adjacent positions (100 columns → 50 at g=2)."""
    arr = _c(v)
    n = (F.size(arr) / g).cast("int")
    return F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: vsum(F.slice(arr, i * g + 1, g)) / float(g),
    )


def hinge_basis(x: ColumnOrName, knots: Sequence[float]) -> Column:
    """[1, max(x - t1, 0), ..., max(x - tm, 0)] (truncated-linear basis)."""
    xs = _c(x)
    ks = F.array(*[F.lit(float(t)) for t in knots])
    return F.concat(F.array(F.lit(1.0)), F.transform(ks, lambda t: F.greatest(xs - t, F.lit(0.0))))


def hard_threshold(a: ColumnOrName, z: float | Column) -> Column:
    x = _c(a)
    return F.when(F.abs(x) > z, x).otherwise(F.lit(0.0))


def soft_threshold(a: ColumnOrName, z: float | Column) -> Column:
    x = _c(a)
    return F.signum(x) * F.greatest(F.abs(x) - z, F.lit(0.0))


def shrink(a: ColumnOrName, gamma: float | Column, sigma: float | Column) -> Column:
    """gamma / (gamma + sigma^2 / a^2) — the James–Stein-like factor on a coefficient."""
    x = _c(a)
    s = sigma if isinstance(sigma, Column) else F.lit(float(sigma))
    return gamma / (gamma + (s * s) / (x * x))


def linear_score(v: ColumnOrName, w: Sequence[float], bias: float = 0.0) -> Column:
    """<v, w> + b with a literal weight vector (weights travel with the plan)."""
    wl = F.array(*[F.lit(float(x)) for x in w])
    return dot(v, wl) + F.lit(float(bias))


def zscore(v: ColumnOrName, mean: ColumnOrName, sd: ColumnOrName) -> Column:
    return F.zip_with(
        F.zip_with(_c(v), _c(mean), lambda x, m: x - m), _c(sd), lambda d, s: d / s
    )


def unit(v: ColumnOrName) -> Column:
    arr = _c(v)
    n = l2norm(arr)
    return F.transform(arr, lambda x: x / n)


def normalize_patch(patch: ColumnOrName, mean: ColumnOrName, sd: ColumnOrName) -> Column:
    """z-score each position with the given statistics, then scale to unit length."""
    return unit(zscore(patch, mean, sd))


def bucket_key(h: ColumnOrName) -> Column:
    """Colon-joined text of an integer hash vector."""
    return F.array_join(F.transform(_c(h), lambda x: x.cast("string")), ":")


def reshape_rows(v: ColumnOrName, width: int) -> Column:
    """Flat row-major vector → array of rows (``array<array<double>>``)."""
    arr = _c(v)
    return F.transform(
        F.sequence(F.lit(0), (F.size(arr) / width).cast("int") - 1),
        lambda r: F.slice(arr, r * width + 1, width),
    )


def window_patch(v: ColumnOrName, width: int, r0: Column, c0: Column, p: int) -> Column:
    """The p×p window whose top-left cell is (r0, c0), flattened row-major."""
    arr = _c(v)
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(p - 1)),
            lambda dr: F.slice(arr, (r0 + dr) * width + c0 + 1, p),
        )
    )


def rnd(x: ColumnOrName, n: int = 6) -> Column:
    """Round for reporting; ``+ 0.0`` folds a negative zero into zero."""
    return F.round(_c(x), n) + F.lit(0.0)
