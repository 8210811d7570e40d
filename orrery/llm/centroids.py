"""Centroid clustering over a persisted table of exact integer dot products.

Every vector is stored with its integer components, its squared length and its dot product with each centroid. A round
changes only some components of some centroids, and a dot product changes by (component of the vector) times (change of
the centroid's component), summed over the components that changed. So a round sends out the nonzero changes alone, adds
them to the stored products, and takes the nearest centroid anew from ``length - 2 * product + centroid's length``. All
of it is 64-bit integer arithmetic without rounding.

A component x becomes ``floor(scale * x)``. Vectors that are null, have another number of components, or hold a null or
non-finite one take no part and are not returned. A vector with a component of ``LARGEST`` or more after scaling takes no
part either, but is returned with null results: its squared distance could exceed a long. Rows with repeated or null ids
are vectors of their own; as seeds, null ids come last and equal ids by their components. With fewer vectors than
``k`` there are as many centroids as vectors. Ties go to the smaller centroid number; a centroid without vectors stays
where it is. An empty table gives no rows.

A round reads and writes the table once, and only ``k`` sums of components reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

LARGEST = 1 << 27
STATE = "_id {id}, _v array<int>, _length long, _dots array<long>, _cluster int"


def usable(vector: Column, dim: int) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) == dim) & fine


def scaled(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def seeds(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``<salt>:<id>``, in that order."""
    rank = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("_id").cast("string")), 256)
    first = vectors.orderBy(rank.asc_nulls_last(), "_v").limit(k).select("_v").collect()
    return np.array([r["_v"] for r in first], np.int64)


def _rows(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width).astype(np.int64)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def advance(state: DataFrame, changes: list[tuple[int, int, int]], lengths: np.ndarray, dim: int) -> DataFrame:
    """The stored products after ``changes`` (centroid, component, amount), and the nearest centroid by them.

    ``state`` without products (``_dots`` null) starts from products of 0, that is from centroids at the origin.
    """
    k = len(lengths)
    centroid, at, amount = (np.array(x, np.int64) for x in zip(*changes)) if changes else (np.zeros(0, np.int64),) * 3
    moved = [(c, at[centroid == c], amount[centroid == c]) for c in np.unique(centroid)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _rows(batch.column("_v"), dim)
            old = batch.column("_dots")
            dots = _rows(old, k).copy() if not old.null_count else np.zeros((len(v), k), np.int64)
            for c, where, by in moved:
                dots[:, c] += v[:, where] @ by
            near = (lengths - 2 * dots).argmin(1).astype(np.int32)  # the first of equal ones
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_v"), batch.column("_length"), _lists(dots, pa.int64()), pa.array(near)],
                ["_id", "_v", "_length", "_dots", "_cluster"],
            )

    return state.mapInArrow(run, STATE.format(id=state.schema["_id"].dataType.simpleString()))


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid's floored mean; one without vectors unchanged. A row per centroid reaches the driver."""
    sums = [F.sum(F.col("_v")[j].cast("long")).alias(f"s{j}") for j in range(centroids.shape[1])]
    out = centroids.copy()
    for r in state.groupBy("_cluster").agg(F.count("*").alias("n"), *sums).collect():
        out[r["_cluster"]] = [r[f"s{j}"] // r["n"] for j in range(centroids.shape[1])]
    return out


def cluster(rows: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, salt: str = "3", key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid`` (its components) and
    ``centroid_sha256`` for every vector that takes part, after ``rounds`` rounds and a last assignment."""
    kept = rows.select(F.col(key).alias("_id"), F.col(vector).alias("_x")).where(usable(F.col("_x"), dim))
    ints = kept.select("_id", scaled(F.col("_x"), scale).alias("_w"))
    small = F.forall("_w", lambda x: (x > -LARGEST) & (x < LARGEST))
    large = ints.where(~small).select("_id")
    vectors = ints.where(small).select("_id", F.col("_w").cast("array<int>").alias("_v"))
    length = F.aggregate("_v", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x)
    state = materialize(vectors.select("_id", "_v", length.alias("_length"), F.lit(None).cast("array<long>").alias("_dots")), "clusters-start")
    kind = rows.schema[key].dataType.simpleString()
    columns = f"`{key}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string"
    before = seeds(state, k, salt)
    if not len(before):
        return large.select(F.col("_id").alias(key), *(F.lit(None).cast(c.split(" ")[1]).alias(c.split(" ")[0]) for c in columns.split(", ")[1:]))
    centroids, held = before, np.zeros_like(before)
    for turn in range(rounds + 1):
        where = np.nonzero(centroids != held)
        changes = [(int(c), int(j), int(centroids[c, j] - held[c, j])) for c, j in zip(*where)]
        if turn and not changes:
            break  # the products, the assignment and so all later rounds stay as they are
        state = materialize(advance(state, changes, (centroids * centroids).sum(1), dim), f"clusters-{turn}")
        held = centroids
        if turn < rounds:
            centroids = _means(state, centroids)
    numbers = F.array(*(F.lit(int(x)) for x in (held * held).sum(1)))
    distance = F.col("_length") - 2 * F.get("_dots", F.col("_cluster")) + F.get(numbers, F.col("_cluster"))
    placed = state.select("_id", "_cluster", distance.alias("distance"))
    total = {r["_cluster"]: int(r["d"]) for r in placed.groupBy("_cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}

    def fits(value: int) -> int | None:
        return value if value < 1 << 63 else None

    texts = [",".join(str(x) for x in c) for c in held.tolist()]
    facts = [(c, fits(total.get(c, 0)), fits(sum(total.values())), held[c].tolist(), hashlib.sha256(t.encode()).hexdigest()) for c, t in enumerate(texts)]
    known = rows.sparkSession.createDataFrame(facts, "_no int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    found = placed.join(F.broadcast(known), F.col("_cluster") == F.col("_no"))  # a row per centroid
    found = found.select(F.col("_id").alias(key), F.col("_cluster").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema.fields[1:]]
    return found.unionAll(large.select(F.col("_id").alias(key), *none))
