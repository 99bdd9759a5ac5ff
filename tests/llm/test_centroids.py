"""Centroid clustering against whole-number brute force."""

import hashlib
import math

import numpy as np
import pytest

from sectorgauge.llm import centroids


def _brute(rows, dimensions=64, clusters=16, rounds=3):
    kept = [
        (i, [math.floor(64 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    middle = [v for _, v in sorted(kept, key=key)[:clusters]]
    for turn in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(middle)) for _, v in kept]
        for k in range(len(middle) if turn < rounds else 0):
            own = [v for (_, v), (_, at) in zip(kept, found, strict=True) if at == k]
            if own:
                middle[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    inertia = [sum(d for d, k in found if k == c) for c in range(len(middle))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(
        ((i, k, d, inertia[k], sum(inertia), digest[k]) for (i, _), (d, k) in zip(kept, found, strict=True)), key=str
    )


def _rows(spark, rows, dimensions=64):
    frame = spark.createDataFrame(
        [(i, v, 1, 2, 3, "c") for i, v in rows],
        "vec_id long, embedding array<double>, ids int, cluster int, distance int, codes string",
    )
    found = centroids.with_inertia(*centroids.cluster_vectors(frame, dimensions=dimensions))
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("segment", [centroids.SEGMENT, 7])
def test_clusters_against_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(centroids, "SEGMENT", segment)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(i % 5, 0.4, 64)).tolist()) for i in range(300)]
    rows += [(1000 + i, [0.25] * 64) for i in range(100)]  # a third of all rows are one vector
    rows += [(7, [0.5] * 64), (7, [-0.5] * 64), (None, [1.0] * 64), (None, [1.0] * 64), (8, [1e9] + [0.0] * 63)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 63), (2003, [0.0] * 65), (2004, [math.nan] + [0.0] * 63)]
    rows += [(2005, [None] + [0.0] * 63), (2006, [math.inf] + [0.0] * 63), (2007, [-math.inf] * 64), (2008, [0.0] * 64 + [None])]
    want = _brute([(i, [min(max(x, -(2.0**20)), 2.0**20) if x is not None else x for x in v] if i == 8 and v else v) for i, v in rows])
    assert _rows(spark, rows) == want


def test_few_and_no_vectors(spark):
    few = [(1, [0.1] * 64), (2, [0.9] * 64), (2, [0.9] * 64)]
    assert _rows(spark, few) == _brute(few)
    assert {r[2] for r in _rows(spark, few)} == {0}
    assert _rows(spark, []) == [] and _rows(spark, [(1, None)]) == []


def test_odd_number_of_dimensions_and_codes(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 5).tolist()) for i in range(60)]
    assert _rows(spark, rows, dimensions=5) == _brute(rows, dimensions=5)
    vectors = rng.integers(-9, 9, (500, 5)).astype(np.int32)
    segment = centroids.Segment(500, *centroids.encode_segment(vectors, 2), 5, 2)
    assert (np.hstack([b[c] for b, c in zip(segment.books, segment.codes, strict=True)]) == vectors).all()
