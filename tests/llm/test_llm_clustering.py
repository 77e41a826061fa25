"""Clusters of vectors against all distances in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tradewind.llm import centroid_clustering as cc


def floors(vector, scale):
    """floor(scale * x) in exact arithmetic."""
    return tuple(n * scale // d for n, d in (float(x).as_integer_ratio() for x in vector))


def brute(given, clusters, rounds, components, scale=64, seed="1"):
    kept = [
        (i, floors(v, scale), v)
        for i, v in given
        if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)
    ]
    rank = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[2])
    centroids = [v for _, v, _ in sorted(kept, key=rank)[:clusters]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for k in range(rounds + 1):
        found = [min((square(v, c), j) for j, c in enumerate(centroids)) for _, v, _ in kept]
        if k < rounds:
            for j in range(len(centroids)):
                own = [v for (_, v, _), (_, c) in zip(kept, found, strict=True) if c == j]
                if own:
                    centroids[j] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    fits = lambda x: x if x < 2**63 else None
    known = all(d < 2**63 for d, _ in found)
    total = fits(sum(d for d, _ in found)) if known else None
    out = []
    for (i, _, _), (d, j) in zip(kept, found, strict=True):
        of_cluster = [x for x, c in found if c == j]
        inertia = fits(sum(of_cluster)) if max(of_cluster) < 2**63 else None
        out.append((i, j, fits(d), inertia, total, ",".join(map(str, centroids[j]))))
    return sorted(out, key=repr)


def vectors(rng, n, components, spread):
    middles = [[rng.gauss(0, 1) for _ in range(components)] for _ in range(5)]
    return [
        (k, [x + rng.gauss(0, spread) for x in middles[rng.randrange(5)]]) for k in range(n)
    ]


def table_of(spark, given, kind="double"):
    return spark.createDataFrame(
        [(i, v, "x", 1) for i, v in given],
        f"vec_id bigint, embedding array<{kind}>, cluster string, distance int",
    ).repartition(5)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize(("n", "spread", "rounds"), [(300, 0.1, 3), (300, 0.7, 5), (40, 2, 0), (7, 1, 3)])
def test_clusters(spark, monkeypatch, n, spread, rounds):
    monkeypatch.setattr(cc, "BLOCK", 50)
    given = vectors(random.Random(n), n, 6, spread)
    given += [given[3], given[3], (None, given[4][1]), (None, [0.0] * 6), (900, [0.0] * 6)]
    given += [
        (901, None), (902, []), (903, [1.0] * 5), (904, [1.0] * 7), (905, [None] * 6),
        (906, [float("nan")] * 6), (907, [1.0] * 5 + [float("inf")]), (908, [-1 / 128] * 6),
    ]
    got = cc.cluster(table_of(spark, given), 10, rounds, 6)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert result(got) == brute(given, 10, rounds, 6)


@pytest.mark.parametrize("largest", [2.0**24, 1e9, 1e30, 1e200, 1.7e308])
def test_large_components(spark, largest):
    rng = random.Random(4)
    given = [(k, [rng.uniform(-1, 1) * rng.choice([1, largest]) for _ in range(3)]) for k in range(60)]
    assert result(cc.cluster(table_of(spark, given), 6, 3, 3)) == brute(given, 6, 3, 3)


def test_ties_go_to_the_smaller_number(spark):
    # Everything is as far from one seed as from others, again and again.
    given = [(k, [float(x), float(y)]) for k, (x, y) in enumerate((x, y) for x in range(6) for y in range(6))]
    given += [(100 + k, v) for k, v in given]
    assert result(cc.cluster(table_of(spark, given), 16, 4, 2, 1)) == brute(given, 16, 4, 2, 1)


def test_nothing_to_cluster(spark):
    for given in ([], [(1, None), (2, [1.0])]):
        out = cc.cluster(table_of(spark, given), 4, 3, 3)
        assert out.count() == 0 and out.columns[:2] == ["vec_id", "cluster"]


def test_query_of_floats(spark, tmp_path):
    given = [(i, np.array(v, np.float32).tolist()) for i, v in vectors(random.Random(2), 80, 64, 0.3)]
    table_of(spark, given, "float").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = cc.op13_centroid_clustering(spark, str(tmp_path))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    digest = lambda r: (*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest())
    assert result(got) == sorted(map(digest, brute(given, 16, 3, 64)), key=repr)


def _drifting(rng, rounds):
    """Vectors, and centroids that swing to and fro while they drift."""
    vectors = rng.normal(0, 1, (400, 4))
    middles = rng.normal(0, 1, (8, 4))
    swing = rng.normal(0, 0.05, (8, 4))
    history = [middles + swing * (-1) ** k for k in range(rounds)]
    return vectors, [[tuple(int(x) for x in c) for c in np.floor(h * 64)] for h in history]


def test_bounds_save_distances_and_displacement_is_the_net_one():
    vectors, rounds = _drifting(np.random.default_rng(3), 9)
    history = cc.History(rounds[:1])
    cluster, _, norms, seen = cc.Assigner(history, 64).first(vectors)
    for centroids in rounds[1:]:
        history = cc.History([*history.rounds, centroids])
        assigner = cc.Assigner(history, 64)
        cluster, exact, norms, seen = assigner.again(vectors, cluster, norms, seen)
        fresh = cc.Assigner(history, 64).first(vectors)
        assert (cluster == fresh[0]).all() and (exact == fresh[1]).all()
        assert assigner.evaluated < 0.6 * vectors.shape[0] * len(centroids)
    # Every other round the centroids are back where they were.
    assert history.displacements()[0].max() == 0 < history.displacements()[1].max()
    # So what has not been looked at since the first round is as sharp as then.
    assert (seen == 0).any()


def test_limbs():
    for value in (0, 5, -5, 2**28, -(2**28) - 1, 3**200, -(7**90)):
        assert sum(x << cc.LIMB * k for k, x in enumerate(cc.limbs(value))) == value
