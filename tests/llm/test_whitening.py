import math

import numpy as np
from fixture import rows_of

from leadlens.llm import whitening as w

COLUMNS = ("id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "c", "c") for i, v in rows],
                                 "vec_id long, embedding array<double>, x string, component string, place string")


def brute(rows, dims):
    x = [[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (dims - len(v)) for _, v in rows
         if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n = len(x)
    sums = [sum(r[j] for r in x) for j in range(dims)]
    deviations = [sum((n * r[j] - sums[j]) ** 2 for j in range(dims)) for r in x]
    centred = np.array([[(n * r[j] - sums[j]) / n for j in range(dims)] for r in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, deviations, centred, values[::-1], vectors[:, ::-1]


def check(spark, rows, dims, components):
    got = rows_of(w.whitened(frame(spark, rows)), *COLUMNS)
    n, deviations, centred, values, vectors = brute(rows, dims)
    kept = [i for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    assert len(got) == n * components and {r[2] for r in got} == {n} and {r[6] for r in got} <= {got[0][6]}
    assert got[0][6] < 1e-8
    by = {}
    for r in got:
        by.setdefault(r[1], []).append(r)
    assert sorted(by) == list(range(1, components + 1))
    for c, found in by.items():
        want = centred @ vectors[:, c - 1] / math.sqrt(values[c - 1])
        assert {round(r[5], 9) for r in found} == {round(values[c - 1] / values.sum(), 9)}
        a = sorted(((r[3], r[4]) for r in found))
        best = min(max(abs(p[1] - q[1]) for p, q in zip(a, sorted(zip(deviations, (s * want).tolist()))))
                   for s in (1, -1))
        assert best < 1e-6, (c, best)
        assert sorted(map(repr, kept)) == sorted(repr(r[0]) for r in found)


def test_equals_numpy_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(w, "ROWS", 64)
    r = np.random.default_rng(1)
    mix = r.normal(size=(40, 40))
    rows = [(k, (r.normal(size=40) @ mix).tolist()) for k in range(700)]
    check(spark, rows, 40, 32)


def test_odd_rows(spark):
    r = np.random.default_rng(2)
    rows = [(k, r.normal(size=5).tolist()) for k in range(50)]
    rows += [(None, r.normal(size=5).tolist()), (3, r.normal(size=5).tolist()), (60, None), (61, [1.0, None, 0.0, 0.0, 0.0]),
             (62, [float("nan")] * 5), (63, [float("inf")] * 5), (64, [0.25]), (65, [])]
    check(spark, rows, 5, 5)


def test_directions_without_variance_and_empty_tables(spark):
    r = np.random.default_rng(3)
    rows = [(k, [float(a), 2.0, float(b), float(a)]) for k, (a, b) in enumerate(r.normal(size=(40, 2)))]
    check(spark, rows, 4, 2)
    for few in ([], [(1, None)], [(1, [])], [(1, [0.5, 1.0])], [(k, [0.5, 1.0]) for k in range(9)]):
        found = w.whitened(frame(spark, few))
        assert found.count() == 0 and found.columns == list(COLUMNS)


def test_large_entries(spark):
    r = np.random.default_rng(4)
    rows = [(k, (1e9 * r.normal(size=3)).tolist()) for k in range(30)]
    got = rows_of(w.whitened(frame(spark, rows)), *COLUMNS)
    assert len(got) == 90 and got[0][6] < 1e-6 and all(d is None for *_, d, _, _, _ in got)
    ends = frame(spark, [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 3.0])])
    assert w.whitened(ends).count() > 0
