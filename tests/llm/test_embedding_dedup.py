import numpy as np

from visitmart.llm.embedding_dedup import Codes, embedding_groups, table_plan, units


def brute(rows, threshold=0.95):
    """[(id, links, component)] of the rows, by each pair of sound vectors of equal length."""
    sound = [k for k, (i, v) in enumerate(rows) if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {}
    for k in sound:
        x = np.asarray(rows[k][1], np.float64)
        x = x / np.abs(x).max()
        unit[k] = x / np.linalg.norm(x)
    near = {k: [j for j in sound if len(unit[j]) == len(unit[k]) and unit[k] @ unit[j] >= threshold] for k in sound}
    comp = {k: rows[k][0] for k in sound}
    while True:
        new = {k: min(comp[j] for j in near[k]) for k in sound}
        if new == comp:
            break
        comp = new
    return sorted(((i, len(near[k]) - 1, comp[k]) if k in near else (i, 0, i) for k, (i, _) in enumerate(rows)), key=str)


def found(df, **settings):
    got = embedding_groups(df, **settings).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str)


def test_groups_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((150, 32))
    vectors = [*base]
    for b in base[:40]:
        vectors += [b * 3, b + rng.standard_normal(32) * 0.12, b + rng.standard_normal(32) * 0.3, b + rng.standard_normal(32) * 0.35]
    vectors += [base[0] + rng.standard_normal(32) * 0.05 for _ in range(120)] + [base[1]] * 30
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    rows += [(2000, None), (2001, [0.0] * 32), (2002, [float("nan")] * 32), (2003, [None] + [1.0] * 31), (2004, [float("inf")] + [0.0] * 31), (2005, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, links string")
    for settings in ({}, {"bucket": 16, "block": 40}, {"bucket": 16, "block": 40, "max_broadcast": 0}):
        assert found(df, **settings) == brute(rows)
    assert embedding_groups(df.limit(0)).count() == 0


def test_lengths_scales_and_repeated_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(16) * 10.0 ** rng.integers(-3, 4)).tolist()) for i in range(60)]
    rows += [(100 + i, v) for i, v in enumerate([[1.0, 0.01], [1.0, 0.0], [1.0, 0.02], [2.0, 0.02], [1.0, 0.02], [-0.0, 1.0], [0.0, 1.0], [0.0, 5.0]])]
    rows += [(200, [3.0]), (201, [4.0]), (202, [-4.0]), (203, [0.5])]
    big = rng.standard_normal(16)
    rows += [(300, (big * 1e200).tolist()), (301, (big * 1e-200).tolist()), (302, big.tolist()), (303, (big * 5e-320).tolist()), (304, (-big * 1e300).tolist())]
    # one id for different vectors, and one vector for different ids
    rows += [(300, rows[0][1]), (0, rows[0][1]), (7, rows[8][1]), (7, [9.0] * 16), (None, rows[0][1]), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for settings in ({}, {"bucket": 4, "block": 8}):
        assert found(df, **settings) == brute(rows)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    codes = Codes(64, 8, 16, 3)
    a, b = rng.standard_normal((2, 3000, 64))
    b = a + b * 0.4
    a, b = a / np.linalg.norm(a, axis=1, keepdims=True), b / np.linalg.norm(b, axis=1, keepdims=True)
    code, factor, keys = codes.encode(a)
    estimate = np.array([codes.estimates(codes.signs([c.tobytes()]), f[None], y[None])[0, 0] for c, f, y in zip(code, factor, b, strict=True)])
    error = estimate - (a * b).sum(1)
    assert abs(error.mean()) < 0.01
    assert (abs(error) < codes.slack(factor)).all()
    other, _, others = codes.encode(b)
    apart = np.bitwise_count(code ^ other).sum(1)
    assert (apart[(a * b).sum(1) >= 0.95] <= codes.farthest(0.95)).all() and (apart > codes.farthest(0.95)).mean() < 0.5
    assert keys.shape == (3000, 16) and 0.02 < (keys == others).mean() < 0.9


def test_units_of_any_scale():
    v = np.array([3.0, 4.0])
    for scale in (1, 1e200, 1e-200, 1e300, 1e-300):
        assert np.allclose(units([v * scale])[0], [0.6, 0.8])


def test_plan_grows_slowly():
    small, large = table_plan(10_000, 64, 0.95, 512, 1e-6), table_plan(10**9, 64, 0.95, 512, 1e-6)
    assert small[0] < large[0] <= 24 and large[1] < 20 * small[1]
