"""Centroid clustering against a direct computation in Python integers."""

import hashlib
import math
import random
import struct

import numpy as np
import pytest

from loomcast.llm.centroids import Rotation, cluster_report, cluster_vectors, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cluster string, distance int"


def rows_of(vectors):
    return [(i, v, 0, "x", "y", 7) for i, v in vectors]


def brute_force(vectors, k, rounds, dims):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    place = lambda p: (hashlib.sha256(f"2:{'' if p[0] is None else p[0]}".encode()).hexdigest(), p[1])
    centroids = [v for _, v in sorted(sound, key=place)[:k]]
    far = lambda v: [sum((x - y) ** 2 for x, y in zip(v, c, strict=True)) for c in centroids]
    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, v in sound:
            d = far(v)
            groups[d.index(min(d))].append(v)
        centroids = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, centroids, strict=True)]
    near = [(i, far(v)) for i, v in sound]
    near = [(i, d.index(min(d)), min(d)) for i, d in near]
    sums = [sum(d for _, c, d in near if c == j) for j in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i is None, i or 0), c, d, sums[c], sum(sums), digest[c]) for i, c, d in near)


def as_float(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def made(seed, n, dims, spread):
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-3, 3) for _ in range(dims)] for _ in range(5)]
    return [(i, [as_float(x + rnd.gauss(0, spread)) for x in rnd.choice(centres)]) for i in range(n)]


def result(df):
    return sorted(((r.vec_id is None, r.vec_id or 0), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


@pytest.mark.parametrize("k,dims,spread", [(7, 6, 0.1), (12, 9, 2.0), (40, 6, 0.3)])
def test_clusters_equal_brute_force(make, k, dims, spread):
    vectors = made(k, 150, dims, spread)
    vectors += [(500 + i, vectors[3][1]) for i in range(30)] + [vectors[5], vectors[5], (None, vectors[7][1]), (None, vectors[8][1])]
    odd = [None, [], [0.5] * (dims - 1), [0.5] * (dims + 1), [None, *[0.5] * (dims - 1)], [float("nan")] * dims, [float("inf"), *[0.0] * (dims - 1)], [-float("inf")] * dims]
    vectors += [(900 + i, v) for i, v in enumerate(odd)] + [(950, [0.0] * dims), (951, [-1 / 512] * dims), (952, [1000.25] * dims)]
    got = cluster_report(make(SCHEMA, rows_of(vectors)).repartition(3), k, 5, dims)
    assert result(got) == brute_force(vectors, k, 5, dims)


@pytest.mark.parametrize("vectors", [[(1, [0.25, 0.5])], [(1, [0.25, 0.5]), (2, [0.25, 0.5])], [(i, [1.0, 1.0]) for i in range(9)]])
def test_fewer_vectors_than_centroids_and_equal_ones(make, vectors):
    assert result(cluster_report(make(SCHEMA, rows_of(vectors)), 4, 3, 2)) == brute_force(vectors, 4, 3, 2)


def test_no_sound_vectors(make):
    assert cluster_report(make(SCHEMA, []), 4, 3, 2).collect() == []
    assert cluster_report(make(SCHEMA, rows_of([(1, None), (2, [1.0])])), 4, 3, 2).collect() == []


def test_components_that_are_too_large_are_an_error(make):
    vectors = make(SCHEMA, rows_of([(1, [1e9, 0.0]), (2, [0.0, 0.0])]))
    with pytest.raises(Exception, match="too large"):
        cluster_report(vectors, 2, 1, 2).collect()


def test_the_rotation_saves_comparisons_and_never_changes_the_result():
    rng = np.random.default_rng(5)
    plane = rng.normal(size=(3, 32)) * 400
    v = (rng.normal(size=(500, 3)) @ plane + rng.normal(size=(500, 32)) * 5).astype(np.int64)
    c = v[:40].copy()
    axes = np.linalg.svd(v - v.mean(axis=0), full_matrices=False)[2][:4].T
    want = ((v[:, None, :] - c) ** 2).sum(axis=2)
    for rotation, most in ((Rotation(axes, v.mean(axis=0)), 0.15), (Rotation(np.eye(32)[:, :1], np.zeros(32)), 1.0)):
        cluster, distance, compared = nearest(v, *rotation(v), (c, *rotation(c)))
        assert (cluster == want.argmin(axis=1)).all() and (distance == want.min(axis=1)).all()
        assert compared <= most * want.size


def test_operator_gives_the_centroids(make):
    vectors = made(2, 60, 4, 0.1)
    found, centroids = cluster_vectors(make(SCHEMA, rows_of(vectors)), 5, 2, 4)
    assert found.columns == ["vec_id", "cluster", "distance"] and centroids.shape == (5, 4)
