import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitmart.llm.whitening import filtered, leading, whiten
from visitmart.llm.queries import op13_whitening


def plainly(vectors, components=4):
    """Everything from the covariance matrix itself, for vectors of one length."""
    x = {i: np.array([math.floor(256 * float(c)) for c in v], dtype=object) for i, v in vectors.items()}
    fit = np.array(sorted({tuple(v) for v in x.values()}), dtype=object)
    n, sums = len(fit), fit.sum(0)
    centred = fit.astype(float) - (sums / n).astype(float)
    cov = centred.T @ centred / n
    values, q = np.linalg.eigh(cov)
    values, q = values[::-1][:components], q[:, ::-1][:, :components]
    out = {}
    for i, v in x.items():
        w = (v.astype(float) - (sums / n).astype(float)) @ q / np.sqrt(values)
        out[i] = (n, int(((n * v - sums) ** 2).sum()), w, values / np.trace(cov))
    return out


def held(rows, want, tolerance=1e-8):
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert got.keys() == want.keys()
    signs = {}
    for i, (n, deviation, w, explained) in want.items():
        assert sorted(got[i]) == list(range(1, len(w) + 1))
        for c, r in got[i].items():
            assert (r["n"], int(r["deviation"])) == (n, deviation)
            assert abs(r["explained"] / explained[c - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9
            if abs(w[c - 1]) > 1e-3:
                signs.setdefault(c, set()).add(np.sign(w[c - 1] * r["whitened"]))
            assert abs(abs(r["whitened"]) - abs(w[c - 1])) < tolerance
    assert all(len(s) == 1 for s in signs.values())  # one sign for all rows


def test_query_against_the_covariance_matrix(spark, data):
    table = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    want = plainly({r["vec_id"]: r["embedding"] for r in table})
    held(op13_whitening(spark, data).collect(), want)


def test_flat_spectrum_is_certified():
    rng = np.random.default_rng(1)
    values = np.concatenate([[1704.0, 1665.0, 1092.3, 1081.1, 1076.9], np.linspace(1074, 926, 91)])
    q = np.linalg.qr(rng.standard_normal((96, 96)))[0]
    v = (q * values) @ q.T
    passes = []
    got, vectors = leading(lambda y: passes.append(1) or v @ y, 96, 4)
    assert np.allclose(got, values[:4], rtol=1e-12)
    assert np.abs(np.abs((vectors * q[:, :4]).sum(0)) - 1).max() < 1e-12
    assert np.linalg.norm(v @ vectors - vectors * got) < 1e-9
    assert len(passes) < 200


def test_the_filter_damps_below_and_grows_above():
    values = np.array([0.0, 0.3, 0.7, 1.0, 1.5, 2.0])
    got = np.diag(filtered(lambda y: values[:, None] * y, np.eye(6), np.diag(values), 0.0, 1.0, 2.0, 9))
    assert abs(got[-1] - 1) < 1e-12 and np.abs(got[:4]).max() < 1e-5 < abs(got[4])


def test_no_certificate_is_an_error():
    rng = np.random.default_rng(0)
    with pytest.raises(RuntimeError, match="no certificate"):  # no symmetric matrix at all
        leading(lambda y: rng.standard_normal((50, 50)) @ y + 60 * y, 50, 2, block=8, max_cycles=3)


SCHEMA = "vec_id long, embedding array<double>, label int, x string, component string, n string, `odd.name` date, deviation int"


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(c) for c in rng.standard_normal(6) * [9, 5, 3, 2, 1, 1]]) for i in range(40)]
    big = 2**63 - 5
    vectors += [(big, [0.5] * 6), (-big, [-0.0, 0.0, -0.001, 1.0, 2.0, 3.0]), (7, vectors[3][1]), (8, vectors[3][1])]  # ids 7 and 8 twice
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [math.nan] * 6), (903, [math.inf] + [0.0] * 5), (904, [])]
    day = datetime.date(2020, 1, 1)
    df = spark.createDataFrame([(i, v, None, "x", "c", "n", day, 1) for i, v in [*vectors, *bad]], SCHEMA)
    got = whiten(df)
    assert got.count() == 4 * len(vectors)
    once = {i: v for i, v in vectors if i not in (7, 8)}
    held(got.where(~F.col("vec_id").isin(7, 8)).collect(), plainly(once | {-7: vectors[7][1], -8: vectors[8][1]}, 4) and {i: r for i, r in plainly(once | {-7: vectors[7][1], -8: vectors[8][1]}).items() if i not in (-7, -8)})
    assert got.where("vec_id = 7").count() == 8
    nulls = whiten(df.withColumn("vec_id", F.lit(None).cast("long")))
    assert nulls.count() == 4 * len(vectors) and nulls.where("vec_id is null").count() == 4 * len(vectors)


def test_lengths_degenerate_and_empty(spark):
    def of(rows):
        return spark.createDataFrame([(i, v, None, None, None, None, None, None) for i, v in rows], SCHEMA)

    rng = np.random.default_rng(6)
    two = {i: [float(c) for c in rng.standard_normal(2)] for i in range(20)}
    three = {100 + i: [float(c) for c in rng.standard_normal(3)] for i in range(20)}
    held(whiten(of([*two.items(), *three.items()])).collect(), plainly(two, 2) | plainly(three, 3))
    line = {i: [float(i), 2.0 * i, 0.0] for i in range(9)}  # one direction only
    held(whiten(of(line.items())).collect(), plainly(line, 1))
    assert whiten(of([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one distinct vector: no scale
    assert whiten(of([])).count() == 0
    wide = {i: [float(c) for c in rng.standard_normal(3) * 1e9] for i in range(30)}  # deviations beyond 64 bits
    held(whiten(of(wide.items())).collect(), plainly(wide, 3))
    equal = {i: [float(c) for c in np.eye(5)[i % 5] * (1 if i < 5 else -1)] for i in range(10)}  # equal eigenvalues
    rows = whiten(of(equal.items())).collect()
    assert len(rows) == 40 and max(r["identity_error"] for r in rows) < 1e-9
