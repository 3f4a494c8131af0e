"""Centroid clustering with a progressive search over Walsh-Hadamard coefficients (op 12).

Vectors and centroids are whole numbers, so their Walsh-Hadamard transforms are exact and squared
differences of coefficients add up to 64 times the squared distance.  Coefficients run from coarse to
fine: the first 2^j of them tell apart the means of 2^j stretches of a vector.  A partial sum can only
grow, so a centroid whose partial sum exceeds the whole sum of another is strictly worse and is
dropped; what is left after all 64 coefficients is nearest.

Defined results: a vector that is null, has another length or holds null or non-finite components is no
part of the clustering and of the result.  A null id hashes as the empty text.  Ids that repeat are
ordered by their vectors, equal rows are several vectors.  With fewer vectors than centroids every vector
starts one; equal centroids leave the later one empty, and it stays.  Components beyond ±32,768 count as
that bound, so that squared distances fit a long.  No vectors give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches
from lodestar.session import cut_lineage

SIZE = 64
CENTROIDS, ROUNDS, SEED, SCALE = 16, 3, 1, 64
#: Largest component; 64 squared differences of transforms of twice this size add up to 2^62.
BOUND = 1 << 21


def _coarse_to_fine(n: int) -> np.ndarray:
    """Bit-reversed numbers: the k-th is the place of the k-th coarsest coefficient."""
    bits = n.bit_length() - 1
    return np.array([int(f"{i:0{bits}b}"[::-1], 2) if bits else 0 for i in range(n)])


def transform(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard coefficients of every row of whole numbers, coarse to fine; the row length is a power of two."""
    rows, n = x.shape
    out = x.astype(np.int64)
    half = 1
    while half < n:
        pair = out.reshape(rows, n // (2 * half), 2, half)
        out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(rows, n)
        half *= 2
    return out[:, _coarse_to_fine(n)]


def _add(total: np.ndarray, v: np.ndarray, c: np.ndarray, row: np.ndarray, centre: np.ndarray, part: slice) -> np.ndarray:
    gap = v[row, part] - c[centre, part]
    return total + np.einsum("ij,ij->i", gap, gap)


def nearest(v: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) for transformed vectors and centroids; ties go to the smaller number."""
    rows, n = v.shape
    row, centre = np.repeat(np.arange(rows), len(c)), np.tile(np.arange(len(c)), rows)
    total = np.zeros(len(row), dtype=np.int64)
    done, width = 0, 1
    most = np.full(rows, np.iinfo(np.int64).max)  # the least whole sum known of each vector
    while done < n:
        total = _add(total, v, c, row, centre, slice(done, done + width))
        done += width
        if done < n:
            # the leader so far is summed to the end: whatever is beyond that is strictly worse
            lead = np.lexsort((centre, total, row))
            lead = lead[np.searchsorted(row[lead], np.arange(rows))]
            whole = _add(total[lead], v, c, row[lead], centre[lead], slice(done, n))
            most = np.minimum(most, whole)
            keep = total <= most[row]
            row, centre, total = row[keep], centre[keep], total[keep]
            width = done
    best = np.lexsort((centre, total, row))
    best = best[np.searchsorted(row[best], np.arange(rows))]
    return centre[best], total[best] // n


def _components(column: pa.Array, n: int) -> np.ndarray:
    """A column of lists of n finite numbers as whole numbers."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, n)
    return np.clip(np.floor(SCALE * x), -BOUND, BOUND).astype(np.int64)


def usable(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", n: int = SIZE) -> DataFrame:
    """(vec_id, v) of the vectors that have exactly ``n`` components, none null or non-finite."""
    x = F.col(f"`{vec}`").cast("array<double>")
    # NaN is above every number, so one comparison on each side finds it and the infinities
    fine = F.forall(x, lambda e: e.isNotNull() & (e < F.lit(float("inf"))) & (e > F.lit(float("-inf"))))
    return vectors.where(F.col(f"`{vec}`").isNotNull() & (F.size(x) == n) & fine).select(F.col(f"`{key}`").alias("vec_id"), x.alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int, n: int = SIZE) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:vec_id``, in that order: k rows come to the driver."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    x = np.array([r["v"] for r in rows], dtype=np.float64).reshape(len(rows), n)
    return np.clip(np.floor(SCALE * x), -BOUND, BOUND).astype(np.int64)


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def make():
        c = transform(centroids)

        def one(batch):
            if not batch.num_rows:
                return None
            cluster, distance = nearest(transform(_components(batch.column(1), centroids.shape[1])), c)
            return {"vec_id": batch.column(0), "cluster": cluster, "distance": distance}

        return one

    return map_batches(vectors, f"vec_id {kind}, cluster int, distance long", make)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, sums of components) of every cluster: one row for each task and cluster is shuffled, one for each cluster collected."""
    k, n = centroids.shape

    def run(batches):
        c = transform(centroids)
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, n), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _components(batch.column(1), n)
                cluster, _ = nearest(transform(x), c)
                count += np.bincount(cluster, minlength=k)
                np.add.at(total, cluster, x)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(count[met]), pa.array(list(total[met]), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "total"])

    parts = vectors.mapInArrow(run, "cluster int, n long, total array<long>")
    sums = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(n)]
    count, total = np.zeros(k, dtype=np.int64), np.zeros((k, n), dtype=np.int64)
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():  # one row for each cluster
        count[r["cluster"]] = r["n"]
        total[r["cluster"]] = [r[f"s{i}"] for i in range(n)]
    return count, total


def fit(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, n: int = SIZE) -> np.ndarray:
    """The centroids after ``rounds`` rounds; ``vectors`` as ``usable`` gives them."""
    centroids = first_centroids(vectors, k, seed, n)
    for _ in range(rounds if len(centroids) else 0):
        count, total = _sums(vectors, centroids)
        full = count > 0
        centroids[full] = total[full] // count[full, None]
    return centroids


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, key: str = "vec_id", vec: str = "embedding",
             n: int = SIZE) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector."""
    good = usable(vectors, key, vec, n)
    centroids = fit(good, k, rounds, seed, n)
    kind = good.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        empty = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], empty)
    placed = cut_lineage(assign(good, centroids))
    sums = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    told = placed.sparkSession.createDataFrame(
        [(i, sums[i], sum(sums.values()), digest(centroids[i])) for i in sums], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
