"""Clusters and codes of vectors against plain Python in exact integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tributary.llm.centroids import cluster_vectors
from tributary.llm.vector_codes import compress_vectors
from tributary.llm.vectors import MOST, nearest, sums_by

NAN, INF = float("nan"), float("inf")


def whole(v):
    return [math.floor(x * 256) for x in v]


def best(v, centres):
    d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
    return d.index(min(d)), min(d)


def lloyd(rows, centres, rounds):
    for _ in range(rounds):
        own = [best(v, centres)[0] for v in rows]
        for k in range(len(centres)):
            mine = [v for v, n in zip(rows, own) if n == k]
            if mine:
                centres[k] = [sum(c) // len(mine) for c in zip(*mine)]
    return centres


def brute_clusters(rows, k, rounds):
    kept = [(i, whole(v)) for i, v in rows if v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centres = lloyd([v for _, v in kept], [list(v) for _, v in order[:k]], rounds)
    return [(i, *best(v, centres)) for i, v in kept], centres


def vectors(rng, n, size, scale=1.0):
    out = [[rng.choice([rng.gauss(0, scale), 0.0, -scale / 256]) for _ in range(size)] for _ in range(n)]
    return out + out[: n // 3]  # a third of them again


ODD = [None, [], [1.0], [NAN] + [0.0] * 7, [INF] + [0.0] * 7, [None] + [0.0] * 7, [-INF] * 8]


@pytest.mark.parametrize("scale", [1.0, 3e5, 1e8])
def test_nearest_and_sums_are_exact_at_every_magnitude(scale):
    rng = random.Random(int(scale))
    rows = [[rng.randrange(-int(scale * 256), int(scale * 256)) for _ in range(64)] for _ in range(60)]
    centres = [list(r) for r in rows[:7]] + [list(rows[0])]
    numbers, distances = nearest(np.array(rows, np.float64), centres)
    assert list(zip(numbers.tolist(), distances.tolist())) == [(k, min(MOST, d)) for k, d in (best(r, centres) for r in rows)]
    weights = np.array([rng.randrange(1, 1 << 20) for _ in rows])
    wanted = {}
    for k, r, w in zip(numbers.tolist(), rows, weights.tolist()):
        n, s = wanted.get(k, (0, [0] * 64))
        wanted[k] = (n + w, [a + b * w for a, b in zip(s, r)])
    assert sums_by(numbers, np.array(rows, np.float64), weights) == wanted
    assert nearest(np.zeros((0, 64)), centres)[0].tolist() == [] and sums_by(np.zeros(0, np.int64), np.zeros((0, 64))) == {}


def test_distances_beyond_a_long_count_as_the_largest():
    numbers, distances = nearest(np.array([[2.0**70] * 4, [0.0] * 4]), [[0] * 4, [1 << 70, 1 << 70, 1 << 70, 0]])
    assert numbers.tolist() == [1, 0] and distances.tolist() == [MOST, 0]


@pytest.mark.parametrize("scale", [0.3, 2e6])
def test_clusters_equal_plain_ones(spark, scale):
    rng = random.Random(4)
    rows = [(n, v) for n, v in enumerate(vectors(rng, 90, 8, scale))]
    rows += [(200 + n, v) for n, v in enumerate(ODD)] + [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1])]
    table = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<double>, cluster string, distance int").repartition(5)
    made = cluster_vectors(table, clusters=9, rounds=3, dimensions=8)
    wanted, centres = brute_clusters(rows, 9, 3)
    assert made.centroids == centres
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, made.rows.collect()), key=key) == sorted(wanted, key=key)


def test_few_or_no_vectors(spark):
    table = spark.createDataFrame([(1, [0.5] * 4), (2, [0.5] * 4)], "vec_id long, embedding array<float>")
    made = cluster_vectors(table, clusters=40, dimensions=4)
    assert len(made.centroids) == 2 and sorted(map(tuple, made.rows.collect())) == [(1, 0, 0), (2, 0, 0)]
    for none in (table.limit(0), table.where("vec_id > 5"), spark.createDataFrame([(1, None)], table.schema)):
        made = cluster_vectors(none, dimensions=4)
        assert made.centroids == [] and made.rows.count() == 0 and made.rows.columns == ["vec_id", "cluster", "distance"]
        coded = compress_vectors(none)
        assert coded.books == [] and coded.rows.count() == 0 and coded.rows.columns == ["vec_id", "label", "code", "error"]
        assert coded.digest() == hashlib.sha256(b"").hexdigest()


def brute_codes(rows, parts, entries, rounds):
    kept = [(i, label, whole(v)) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    size = len(min(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[2])
    width = -(-size // parts)
    kept = [(i, label, v + [0] * (width * parts - size)) for i, label, v in kept if len(v) == size]
    first = {}
    for i, _, v in sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[2])):
        first.setdefault(i, v)
    first = list(first.values())[:entries]
    books = [lloyd([v[p * width : (p + 1) * width] for *_, v in kept], [v[p * width : (p + 1) * width] for v in first], rounds) for p in range(parts)]
    out = []
    for i, label, v in kept:
        found = [best(v[p * width : (p + 1) * width], books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for k, _ in found), min(MOST, sum(d for _, d in found))))
    return out, books


@pytest.mark.parametrize(("size", "parts", "scale"), [(8, 4, 0.2), (8, 3, 0.2), (5, 2, 1e8), (20, 10, 1.0)])
def test_codes_equal_plain_ones(spark, size, parts, scale):
    rng = random.Random(size + parts)
    rows = [(n, v, rng.choice([None, 1, 2])) for n, v in enumerate(vectors(rng, 80, size, scale))]
    rows += [(300 + n, v, 3) for n, v in enumerate(ODD[:6])] + [(5, rows[9][1], 1), (5, rows[9][1], 1), (6, rows[2][1], None)]
    rows += [(400 + n, rows[3][1], 2) for n in range(200)]  # one vector is most of the table
    table = spark.createDataFrame([(i, v, n, "a", 1) for i, v, n in rows], "vec_id long, embedding array<double>, label int, code string, pos int").repartition(6)
    made = compress_vectors(table, parts=parts, entries=12, rounds=2)
    wanted, books = brute_codes(rows, parts, 12, 2)
    assert made.books == books
    key = lambda r: (r[0], r[1] or 0, *r[2:])
    assert sorted(map(tuple, made.rows.collect()), key=key) == sorted(wanted, key=key)
    assert made.digest() == hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def test_common_and_rare_parts_get_the_same_codes(spark, monkeypatch):
    from tributary.llm import vector_codes

    rng = random.Random(1)
    table = spark.createDataFrame([(n, v, 0) for n, v in enumerate(vectors(rng, 60, 8))], "vec_id long, embedding array<float>, label int")
    found = []
    for hot in (0, 5, 2000):
        monkeypatch.setattr(vector_codes, "HOT", hot)
        found.append(sorted(map(tuple, compress_vectors(table, parts=4, entries=8).rows.collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) == 80
