"""Centroid clustering with ns-bounds, in exact integers.

A vector keeps, for every centroid, its distance to a centroid of an earlier round and that round's number. The history of
all centroids is kept too, so a stored distance is loosened by the norm of the centroid's total displacement since then,
which is never more than the sum of its drifts round by round. A vector stays where it is if no loosened lower bound falls
to its upper bound; what fails is computed exactly, first the own centroid, then the others that still fail.

Vectors are turned into integers, floor(scale * x), so distances and means are exact and do not depend on how the
rows are dealt out. Bounds are floating-point with a margin for rounding, and only ever decide what is computed again.
Sums of clusters leave a task as integers cut into limbs, so no size of a component can overflow them.

Each round writes the vectors with their bounds as a table. To the driver come the centroids alone: clusters x components.

Defined results: vectors that are null, of another length, or hold null or non-finite components are left out. Rows of
equal id are vectors of their own; a null id comes last where seeds are chosen. With fewer vectors than clusters
there are as many clusters as vectors, without vectors no rows. A squared distance beyond a long is null, and so are sums over
one; the assignment is exact all the same. Other columns than the two named are ignored, so none can clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import Scratch, quoted, table

#: Below this, squared distances of vectors with few thousand components fit 64 bits.
SMALL = 1 << 24
#: Bits of a limb of a sum; 2**35 vectors can be summed up.
LIMB = 28
LARGEST = (1 << 63) - 1
#: Rounding of bounds: far more than what a square root and a subtraction can lose.
MARGIN = 1e-9
#: Vectors of a step inside a task.
BLOCK = 4096

STATE = "id bigint, v array<double>, cluster int, distance bigint, norms binary, rounds binary"


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as 64-bit integers if they are small and Python's own otherwise."""
    if not values.size or np.abs(values).max() < SMALL / scale:
        return np.floor(values * scale).astype(np.int64)
    # A float of that size times a power of two is exact as a fraction of integers.
    flat = [(n * scale) // d for n, d in map(float.as_integer_ratio, values.ravel().tolist())]
    out = np.empty(len(flat), object)
    out[:] = flat
    return out.reshape(values.shape)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of two arrays."""
    return ((a - b) ** 2).sum(-1)


def _norm(squared: int) -> float:
    """A square root; infinite beyond what floats hold."""
    if squared < 1 << 1000:
        return math.sqrt(squared)
    try:
        return math.isqrt(squared >> 64) * 2.0**32
    except OverflowError:
        return math.inf


@dataclass
class History:
    """The centroids of all rounds so far."""

    rounds: list[list[tuple[int, ...]]] = field(default_factory=list)

    def add(self, centroids: list[tuple[int, ...]]) -> None:
        self.rounds.append(centroids)

    def displacements(self) -> np.ndarray:
        """Per round and centroid, how far the centroid is from there now, rounded up."""
        now = self.rounds[-1]
        return np.array(
            [
                [_norm(sum((x - y) ** 2 for x, y in zip(a, b, strict=True))) for a, b in zip(then, now, strict=True)]
                for then in self.rounds
            ]
        ) * (1 + MARGIN)

    def matrix(self) -> np.ndarray:
        now = self.rounds[-1]
        small = all(abs(x) < SMALL for c in now for x in c)
        out = np.empty((len(now), len(now[0])), np.int64 if small else object)
        out[:] = now
        return out


class Assigner:
    """Assigns vectors to the nearest centroid of the last round."""

    def __init__(self, history: History, scale: int):
        self.scale, self.round = scale, len(history.rounds) - 1
        self.moved, self.centroids = history.displacements(), history.matrix()
        #: Distances that were computed.
        self.evaluated = 0

    def _squared(self, vectors: np.ndarray, which: np.ndarray) -> np.ndarray:
        self.evaluated += len(which)
        centroids = self.centroids[which]
        if vectors.dtype != centroids.dtype:
            vectors, centroids = vectors.astype(object), centroids.astype(object)
        return squares(vectors, centroids)

    def first(self, values: np.ndarray):
        """Cluster, squared distance, distances and their rounds of vectors that were never assigned."""
        vectors, k = integers(values, self.scale), len(self.centroids)
        exact = np.empty((len(vectors), k), object)
        for j in range(k):
            exact[:, j] = self._squared(vectors, np.full(len(vectors), j))
        if vectors.dtype == self.centroids.dtype == np.int64:
            exact = exact.astype(np.int64)
        cluster = exact.argmin(1)
        rounds = np.full((len(vectors), k), self.round, np.uint8)
        return cluster, exact[np.arange(len(vectors)), cluster], self._norms(exact), rounds

    @staticmethod
    def _norms(exact: np.ndarray) -> np.ndarray:
        if exact.dtype == np.int64:
            return np.sqrt(exact.astype(float))
        return np.array([_norm(int(x)) for x in exact.ravel()]).reshape(exact.shape)

    def again(self, values: np.ndarray, cluster: np.ndarray, norms: np.ndarray, rounds: np.ndarray):
        """The same for vectors with stored distances, of which some may still do."""
        vectors, k = integers(values, self.scale), len(self.centroids)
        rows, every = np.arange(len(vectors)), np.arange(k)
        with np.errstate(invalid="ignore"):
            lower = norms * (1 - MARGIN) - self.moved[rounds, every]
        lower[rows, cluster] = np.inf
        upper = norms[rows, cluster] * (1 + MARGIN) + self.moved[rounds[rows, cluster], cluster]
        norms, rounds = norms.copy(), rounds.copy()
        # What cannot be compared fails, too.
        failed = np.flatnonzero(~(lower > upper[:, None]).all(1))
        # The own centroid first: its exact distance may settle it. It is asked for in the result, too.
        exact = self._squared(vectors, cluster)
        own = self._norms(exact)
        norms[rows, cluster], rounds[rows, cluster] = own, self.round
        row, centroid = np.nonzero(~(lower[failed] > own[failed, None] * (1 + MARGIN)))
        row = failed[row]
        if len(row):
            others = self._squared(vectors[row], centroid)
            norms[row, centroid], rounds[row, centroid] = self._norms(others), self.round
            # The nearest of those computed, the smallest number of equal ones; the rest is farther away.
            all_rows, all_centroids = np.append(failed, row), np.append(cluster[failed], centroid)
            found = np.concatenate([exact[failed].astype(object), others.astype(object)])
            best: dict[int, tuple] = {}
            for r, c, d in zip(all_rows.tolist(), all_centroids.tolist(), found.tolist(), strict=True):
                if r not in best or (d, c) < best[r]:
                    best[r] = (d, c)
            for r, (d, c) in best.items():
                cluster[r] = c
                exact[r] = d
        return cluster, exact, norms, rounds


# --- rows ---------------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def _values(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _assign(history, scale: int):
    size = BLOCK

    def run(batches):
        assigner = Assigner(history.value, scale)
        k = len(assigner.centroids)
        for batch in _blocks(batches, size):
            values = _values(batch.column("v"))
            if "norms" in batch.schema.names:
                cluster = batch.column("cluster").to_numpy().astype(np.int64)
                norms = np.frombuffer(b"".join(batch.column("norms").to_pylist())).reshape(-1, k)
                rounds = np.frombuffer(b"".join(batch.column("rounds").to_pylist()), np.uint8).reshape(-1, k)
                cluster, exact, norms, rounds = assigner.again(values, cluster, norms, rounds)
            else:
                cluster, exact, norms, rounds = assigner.first(values)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("v"), pa.array(cluster, pa.int32()),
                    pa.array([d if d <= LARGEST else None for d in exact.tolist()], pa.int64()),
                    pa.array([x.tobytes() for x in norms], pa.binary()),
                    pa.array([x.tobytes() for x in rounds], pa.binary()),
                ],
                names=["id", "v", "cluster", "distance", "norms", "rounds"],
            )

    return run


def limbs(value: int) -> list[int]:
    """An integer as signed digits of ``LIMB`` bits, the lowest first."""
    sign, left, out = (-1, -value, []) if value < 0 else (1, value, [])
    while left:
        out.append(sign * (left & (1 << LIMB) - 1))
        left >>= LIMB
    return out


def _sums(scale: int):
    """Per cluster and component, the limbs of the sum over a task's vectors; their number as component -1."""
    size = BLOCK

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in _blocks(batches, size):
            vectors, cluster = integers(_values(batch.column("v")), scale), batch.column("cluster").to_numpy()
            for c in np.unique(cluster).tolist():
                of_cluster = vectors[cluster == c]
                # A block's sum of small integers fits; across blocks they are Python's.
                sums[c] = sums.get(c, 0) + of_cluster.sum(0).astype(object)
                counts[c] = counts.get(c, 0) + len(of_cluster)
        rows = [(c, -1, 0, n) for c, n in counts.items()]
        for c, total in sums.items():
            rows += [(c, k, n, x) for k, value in enumerate(total) for n, x in enumerate(limbs(int(value)))]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
            names=["cluster", "component", "limb", "total"],
        )

    return run


def _moved(state: DataFrame, centroids: list[tuple[int, ...]], scale: int) -> list[tuple[int, ...]]:
    """The exact means of the clusters, rounded down; an empty one stays."""
    partial = state.select("cluster", "v").mapInArrow(
        _sums(scale), "cluster int, component int, limb int, total bigint"
    )
    # As many rows as clusters x components x limbs.
    totals = partial.groupBy("cluster", "component", "limb").agg(F.sum("total").alias("total")).collect()
    counts = {r.cluster: r.total for r in totals if r.component < 0}
    sums = {c: [0] * len(centroids[c]) for c in counts}
    for r in totals:
        if r.component >= 0:
            sums[r.cluster][r.component] += r.total << LIMB * r.limb
    return [
        tuple(x // counts[c] for x in sums[c]) if c in counts else centroid for c, centroid in enumerate(centroids)
    ]


def usable(vector: Column, components: int) -> Column:
    """True for a vector with exactly so many components, all finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == components) & finite, F.lit(False))


def cluster(
    rows: DataFrame, clusters: int, rounds: int, components: int, scale: int = 64, seed: str = "1",
    id_col: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid), a row for each usable vector.

    Seeds are the vectors whose ids hash lowest together with ``seed``; ``centroid`` is the final one of the
    vector's cluster, its integers as text.
    """
    if not 0 <= rounds < 256:
        raise ValueError("a round's number is kept in a byte")
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession)
    given = rows.select(quoted(id_col).alias("id"), quoted(vector).cast("array<double>").alias("v"))
    given = scratch.put("given", given.where(usable(F.col("v"), components)))
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    # As many rows as clusters, found by a distributed top-k.
    seeds = given.orderBy(rank.asc_nulls_last(), "v").limit(clusters).collect()
    if not seeds:
        return spark.createDataFrame([], f"{RESULT_ID} bigint, {RESULT}").withColumnRenamed(RESULT_ID, id_col)
    first = [tuple(integers(np.array(r.v), scale).tolist()) for r in seeds]
    history = History([first])
    state, name = given, "given"
    for k in range(rounds + 1):
        # Clusters x components x rounds.
        sent = spark.sparkContext.broadcast(history)
        state = scratch.put(f"state-{k}", state.mapInArrow(_assign(sent, scale), STATE))
        scratch.drop(name)
        name = f"state-{k}"
        if k < rounds:
            history = History([*history.rounds, _moved(state, history.rounds[-1], scale)])
    final = [(c, ",".join(map(str, x))) for c, x in enumerate(history.rounds[-1])]
    per_cluster = state.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("exact"),
        (F.count("distance") == F.count("*")).alias("known"),
    )
    # As many rows as clusters.
    totals = per_cluster.collect()
    known = all(r.known for r in totals)
    inertia = int(sum(r.exact for r in totals)) if known else None
    fits = lambda x: x if x is not None and x <= LARGEST else None
    of_cluster = {r.cluster: fits(int(r.exact)) if r.known else None for r in totals}
    facts = spark.createDataFrame(
        [(c, of_cluster.get(c), fits(inertia), text) for c, text in final],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid string",
    )
    out = state.select("id", "cluster", "distance").join(F.broadcast(facts), "cluster")
    return out.select(F.col("id").alias(id_col), *[c.split()[0] for c in RESULT.split(", ")])


RESULT_ID = "id"
RESULT = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid string"

#: Parameters of the query.
PRODUCTION = {"clusters": 16, "rounds": 3, "components": 64, "scale": 64, "seed": "1"}


def op13_centroid_clustering(spark, sf_dir):
    """The clusters of ``embeddings``, with a digest of each centroid."""
    out = cluster(table(spark, sf_dir, "embeddings"), **PRODUCTION)
    return out.withColumn("centroid_sha256", F.sha2("centroid", 256)).drop("centroid")


def _oracle() -> str:
    """Every round from all distances."""
    steps = [
        """WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        """c0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, v AS centroid
  FROM (SELECT *, sha256('1:' || vec_id) AS h FROM kept ORDER BY h LIMIT 16))""",
    ]
    for k in range(4):
        steps.append(f"""a{k} AS (
  SELECT row, vec_id, v, d.cluster, d.distance FROM (
    SELECT k.row, k.vec_id, k.v, min((list_sum(list_transform(list_zip(k.v, c.centroid),
      lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.cluster)) AS best
    FROM kept k CROSS JOIN c{k} c GROUP BY ALL), LATERAL (
      SELECT CAST(best[2] AS INTEGER) AS cluster, CAST(best[1] AS BIGINT) AS distance) d)""")
        if k < 3:
            steps.append(f"""c{k + 1} AS (
  SELECT c.cluster, coalesce(m.centroid, c.centroid) AS centroid
  FROM c{k} c LEFT JOIN (
    SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY place) AS centroid FROM (
      SELECT cluster, place, sum(x) AS total, count(*) AS n FROM (
        SELECT cluster, unnest(v) AS x, unnest(range(64)) AS place FROM a{k}) GROUP BY cluster, place)
    GROUP BY cluster) m ON m.cluster = c.cluster)""")
    return (
        ",\n".join(steps)
        + """
SELECT vec_id, a.cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(centroid, ',')) AS centroid_sha256
FROM a3 a JOIN c3 c ON c.cluster = a.cluster"""
    )


ORACLE = _oracle()
