"""Whitening against eigenvectors of the library and exact whole-number sums."""

import math
from fractions import Fraction

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from flowline.llm import queries, whitening  # noqa: E402
from flowline.llm.spectrum import count_above, leading  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, EMBEDDING string, n int, whitened string"


def check(matrix, count):
    values, vectors = leading(matrix, count)
    want = np.linalg.eigvalsh(matrix)[::-1][:count]
    scale = max(np.abs(matrix).max(), 1e-300)
    assert np.abs(values - want).max(initial=0) < 1e-12 * scale * len(matrix)
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max(initial=0) < 1e-12
    assert np.abs(matrix @ vectors.T - vectors.T * values).max(initial=0) < 1e-11 * scale


def test_slicing_finds_the_leading_pairs():
    draw = np.random.default_rng(1)
    for size in (1, 2, 3, 8, 64):
        factor = draw.normal(size=(size, 2 * size))
        check(factor @ factor.T, 8)
    turn = np.linalg.qr(draw.normal(size=(30, 30)))[0]
    spectra = [[5] * 4 + [3] * 10 + [1] * 16, [1] * 30, [1, 1 + 1e-12, 1 + 1e-9] + [0.5] * 27, [1] + [0] * 29]
    spectra += [[1e8, 1e-8] + [0] * 28, range(30, 0, -1), [-1] * 10 + [2] * 20]
    for spectrum in spectra:
        matrix = turn * np.array(spectrum, float) @ turn.T
        check((matrix + matrix.T) / 2, 8)
    swap = np.zeros((5, 5))
    check(swap, 5)
    swap[0, 1] = swap[1, 0] = 1
    check(swap, 5)
    assert leading(np.zeros((0, 0)), 3)[0].size == 0


def test_inertia_counts():
    draw = np.random.default_rng(2)
    for _ in range(200):
        size = draw.integers(1, 12)
        matrix = draw.integers(-2, 3, size=(size, size)).astype(float)
        matrix = matrix + matrix.T
        shift = draw.normal()
        assert count_above(matrix, shift) == (np.linalg.eigvalsh(matrix) > shift).sum()
        check(matrix, int(size))


def whole(vector):
    return [math.floor(1024 * float(c)) + 100_000 for c in vector]


def against_plain(found, kept, components):
    """``found`` rows against exact sums; eigenvectors and scores against the library, up to their sign."""
    x = [whole(v) for _, v in kept]
    n, size = len(x), len(x[0])
    sums = [sum(column) for column in zip(*x)]
    centred = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(row, sums)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    rows = {}
    for r in found:
        rows.setdefault((r.vec_id, r.deviation), []).append(r)
    for (number, _), row in zip(kept, x):
        deviation = sum((n * v - s) ** 2 for v, s in zip(row, sums))
        assert {r.component for r in rows[number, deviation]} == set(range(1, components + 1))
    for k in range(components):
        scores = centred @ vectors[:, k] / np.sqrt(values[k])
        got = sorted((r.vec_id or -1, r.whitened) for r in found if r.component == k + 1)
        want = sorted(((number or -1), score) for (number, _), score in zip(kept, scores))
        other = sorted(((number or -1), -score) for (number, _), score in zip(kept, scores))
        close = [np.allclose([g[1] for g in got], [w[1] for w in side], rtol=1e-8, atol=1e-9) for side in (want, other)]
        assert any(close)
        explained = {r.explained for r in found if r.component == k + 1}
        assert len(explained) == 1 and explained.pop() == pytest.approx(values[k] / values.sum(), rel=1e-9)
    assert {r.n for r in found} == {n}


def test_query_against_exact_sums(spark):
    found = queries.op13_whitening(spark, SF)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kept = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = found.collect()
    against_plain(rows, kept, 8)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_rows_that_do_not_count_and_repeated_rows(spark):
    draw = np.random.default_rng(3)
    good = [(i, draw.normal(size=4).astype("f4").tolist()) for i in range(20)]
    good += [good[0], good[0], (None, [0.5, -0.25, 1.0, 2.0])]
    bad = [(90, None), (91, [1.0, None, 0.0, 0.0]), (92, [1.0, math.nan, 0.0, 0.0]), (93, [math.inf, 0.0, 0.0, 0.0])]
    bad += [(94, []), (95, [1.0, 2.0]), (96, [-math.inf] * 4)]
    df = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in good + bad], SCHEMA).repartition(5)
    model = whitening.fit(df)
    found = whitening.transform(df, model).collect()
    assert len(found) == 4 * len(good)  # no more components than dimensions
    against_plain(found, good, 4)
    assert whitening.identity_error(df, model) < 1e-9


def test_huge_values_stay_exact(spark):
    draw = np.random.default_rng(4)
    rows = [(i, (draw.normal(size=3) * 1e9).tolist()) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    model = whitening.fit(df)
    assert model.sums == tuple(sum(c) for c in zip(*[whole(v) for _, v in rows]))
    found = whitening.transform(df, model).collect()
    assert all(r.deviation is None for r in found)  # beyond a long
    centred = np.array([whole(v) for _, v in rows], float) - np.array(model.sums) / 30
    assert np.allclose(model.values, np.linalg.eigvalsh(centred.T @ centred / 30)[::-1], rtol=1e-9)
    far = spark.createDataFrame([(1, [1e300]), (2, [-1e300])], "vec_id bigint, embedding array<double>")
    assert len(whitening.transform(far, whitening.fit(far)).collect()) == 2


def test_no_spread_and_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = whitening.fit(empty)
    assert model.n == 0 and whitening.transform(empty, model).collect() == []
    assert whitening.identity_error(empty, model) == 0.0
    same = spark.createDataFrame([(1, [0.5, 2.0], "x", 1, "y")] * 3, SCHEMA)
    model = whitening.fit(same)
    found = whitening.transform(same, model).collect()
    assert [(r.deviation, r.whitened, r.explained) for r in found] == [(0, None, 0.0)] * 6
    line = spark.createDataFrame([(i, [float(i), 2.0 * i], "x", 1, "y") for i in range(5)], SCHEMA)
    model = whitening.fit(line)
    found = whitening.transform(line, model).collect()
    assert [r.whitened is None for r in sorted(found, key=lambda r: r.component)] == [False] * 5 + [True] * 5
    assert whitening.identity_error(line, model) < 1e-9


def test_partitions_change_nothing(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    one, many = whitening.fit(df.coalesce(1)), whitening.fit(df.repartition(13))
    assert one.sums == many.sums and (one.vectors == many.vectors).all() and (one.values == many.values).all()
