import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import queries, whitening
from tests.llm.cases import with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, k=4):
    """(n, eigenvalues, vectors, trace, S) of the distinct quantised vectors, by a dense eigendecomposition."""
    x = np.array(sorted({tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in vectors}))
    centred = x - x.sum(0) / len(x)
    v = centred.T @ centred / len(x)
    values, turn = np.linalg.eigh(v)
    return len(x), values[::-1][:k], turn[:, ::-1][:, :k], np.trace(v), x.sum(0)


def check(found, table, k=4):
    n, values, turn, trace, sums = brute(table.values(), k)
    assert len(found) == len(table) * k
    assert {r.component for r in found} == set(range(1, k + 1))
    ids = sorted(table)
    place = {d: i for i, d in enumerate(ids)}
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in table[d]] for d in ids])
    expected = (x - sums / n) @ turn / np.sqrt(values)
    got = np.zeros_like(expected)
    for r in found:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and abs(r.explained - values[r.component - 1] / trace) < 1e-10 and r.identity_error < 1e-9
        assert int(r.deviation) == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[place[r.vec_id]], sums, strict=True))
    for j in range(k):
        sign = np.sign((expected[:, j] * got[:, j]).sum())
        assert np.abs(expected[:, j] - sign * got[:, j]).max() < 1e-7


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_query_over_whole_table(spark, sf_dir, size):
    place = sf_dir.replace("sf0.001", size)
    table = {r.vec_id: r.embedding for r in spark.read.parquet(f"{place}/embeddings.parquet").collect()}
    check(queries.op12_whitening(spark, place).collect(), table)


def product_of(matrix, calls=None):
    def product(block):
        if calls is not None:
            calls.append(block.shape)
        return matrix @ block

    return product


def matrix(values, seed=1):
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    return (turn * np.array(values)) @ turn.T, turn


@pytest.mark.parametrize("name,values", [
    ("flat with small gaps", np.linspace(1070, 930, 64)), ("steep", 10.0 ** -np.arange(80.0) * 1e6), ("ties within", [5.0] * 3 + [4.0] * 5 + [1.0] * 60),
    ("all equal", [2.0] * 50), ("low rank", [9.0, 8.0, 7.0, 6.0, 5.0] + [0.0] * 95), ("rank two", [9.0, 8.0] + [0.0] * 60), ("one huge", [1e9] + [1.0] * 3 + [0.5] * 70),
    ("fewer dimensions than asked", [3.0, 2.0]), ("just the block", list(range(1, 33))),
])
def test_spectra(name, values):
    values = np.sort(np.array(values, float))[::-1]
    a, turn = matrix(values)
    got, vectors = whitening.leading(product_of(a), len(a), min(4, len(a)), float(np.trace(a)))
    k = len(got)
    wanted = [v for v in values[:4] if v > 1e-10 * values[0]]
    assert k == len(wanted)
    assert np.abs(got - wanted).max() <= 1e-11 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.linalg.norm(a @ vectors - vectors * got) <= 1e-9 * values[0]


def test_a_direction_that_the_block_misses_is_not_certified():
    a, turn = matrix([10.0, 9.0, 8.0, 7.0, 6.5] + [1.0] * 60)
    rest = np.delete(turn, 2, axis=1)[:, :20]  # exact vectors, but not the third
    theta = (rest * (a @ rest)).sum(axis=0)
    error = np.linalg.norm(a @ rest - rest * theta, axis=0)
    rng = np.random.default_rng(0)
    assert not whitening.certified(product_of(a), rest, theta, error, 4, float(np.trace(a)), 0.0, rng)
    whole = turn[:, :20]
    theta = (whole * (a @ whole)).sum(axis=0)
    assert whitening.certified(product_of(a), whole, theta, np.full(20, 1e-14), 4, float(np.trace(a)), 0.0, rng)


def test_number_of_passes():
    """Neighbouring eigenvalues within a thousandth are told apart in some dozens of passes."""
    calls = []
    a, _ = matrix(np.linspace(1070, 930, 300))
    got, _ = whitening.leading(product_of(a, calls), 300, 4, float(np.trace(a)))
    assert len(got) == 4 and len(calls) < 150


def test_awkward_rows(spark):
    draw = np.random.default_rng(2)
    table = {k: [float(np.float32(v)) for v in draw.normal(size=6) * [5, 4, 3, 2, 1, 0.5]] for k in range(60)}
    rows = [(k, v, 1) for k, v in table.items()]
    table |= {100: table[3], 101: [-0.0] * 6}
    rows += [(100, table[3], None), (101, [-0.0] * 6, 1), (None, table[5], 2)]
    bad = [(102, None, 1), (103, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (104, [float("nan")] * 6, 1), (105, [float("inf")] + [0.0] * 5, 1), (106, [], 1), (107, [1.0] * 4, 1)]
    frame = with_clashes(spark.createDataFrame(rows + bad, SCHEMA)).withColumn("x", F.lit("extra"))
    found = whitening.whiten(frame).collect()
    assert sum(r.vec_id is None for r in found) == 4
    check([r for r in found if r.vec_id is not None], table)
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], SCHEMA)).collect() == []
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 4.0], 1)], SCHEMA)).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9), round(r.explained, 9)) for r in two) == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]


def test_deviation_beyond_a_long(spark):
    rows = [(1, [1e8, 0.0], 1), (2, [-1e8, 3.0], 1), (3, [0.0, 1e8], 1)]
    table = {k: v for k, v, _ in rows}
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), table, 2)
