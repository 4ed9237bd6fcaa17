import random

import duckdb
import numpy as np
import pandas as pd

from visitmart.llm.similar import BALL, BITS, FINE, LANES, MIX, Candidates, bit_chance, common_shingles, segment_bits, similar_rows, table_plan, wide_fingerprint
from visitmart.llm.simhash import keep_one


def plain_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def plain_groups(texts, least=0.8):
    sets = [plain_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both >= least * (len(a) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def edited(rng, count, edits):
    words = [f"w{rng.randrange(5000)}" for _ in range(300)]
    for _ in range(count):
        own = list(words)
        for at in rng.sample(range(300), edits):
            own[at] = f"x{rng.randrange(10**6)}"
        yield " ".join(own)


def test_groups_of_edited_copies_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [t for edits in (1, 2, 3, 4, 5, 6, 8, 12) for _ in range(4) for t in edited(rng, 5, edits)]
    texts += ["a b", "A  b", "a c", "", None, "one two three four five six", "one two three four five seven"]
    want = plain_groups(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for settings in ({}, {"block": 24, "set_block": 12}, {"block": 24, "set_shingles": 2000, "max_broadcast": 0}):
        got = {r["doc_id"]: r["root"] for r in similar_rows(docs, **settings).collect()}
        assert len(got) == len(texts) and len(set(want)) == len(set(got.values()))
        assert len(set(zip(want, (got[i] for i in range(len(texts))), strict=True))) == len(set(want))


def test_fingerprint_bits_are_plain_simhashes():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 40, 20_000):
        h = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        got = np.unpackbits(np.frombuffer(wide_fingerprint(h), np.uint8))
        salts = np.random.default_rng(42).integers(0, 1 << 63, LANES, np.uint64)
        mixed = (h[:, None] ^ salts) * MIX
        mixed = (mixed ^ (mixed >> np.uint64(32))) * MIX
        mixed ^= mixed >> np.uint64(29)
        ones = np.zeros(BITS, np.int64)
        for row in mixed[:2000] if n > 2000 else mixed:
            ones += np.unpackbits(row.view(np.uint8))
        if n <= 2000:
            assert (got == (ones * 2 > len(h))).all()
    # about the expected share of bits differs
    a = np.unique(rng.integers(0, 1 << 63, 4000, np.uint64))
    b = np.unique(np.concatenate([a[: len(a) * 8 // 9], rng.integers(0, 1 << 63, len(a) - len(a) * 8 // 9, np.uint64)]))
    differ = sum((x ^ y).bit_count() for x, y in zip(wide_fingerprint(a), wide_fingerprint(b), strict=True))
    assert abs(differ - BITS * bit_chance(0.8)) < 45


def test_candidates_are_all_pairs_within_balls_and_distance():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, (30, BITS // 8), np.uint8)
    rows = [*base]
    for b in base:
        for flips in (5, 40, 70, 100, 140):
            bits = np.unpackbits(b)
            bits[rng.choice(BITS, flips, replace=False)] ^= 1
            rows.append(np.packbits(bits))
    m = len(rows)
    group = pd.DataFrame({"print": [r.tobytes() for r in rows], "fine": rng.integers(0, 1 << FINE, m), "n": rng.integers(80, 120, m), "key": np.arange(m)})
    fine, n, prints = group["fine"].to_numpy(), group["n"].to_numpy(), np.stack(rows)
    d = np.bitwise_count(prints[:, None] ^ prints).sum(2, dtype=np.int64)
    for two in (None, rng.random(m) < 0.5):
        found = Candidates(group, two, 0.8)
        got = [tuple(sorted(x)) for i, j, _ in found for x in zip(i.tolist(), j.tolist(), strict=True)]
        want = {
            (i, j) for i in range(m) for j in range(i + 1, m)
            if d[i, j] <= found.radius and int(fine[i] ^ fine[j]).bit_count() <= BALL and min(n[i], n[j]) >= 0.8 * max(n[i], n[j]) and (two is None or two[i] != two[j])
        }
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 5


def test_common_shingles_are_counted_exactly():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200), np.uint64)) for _ in range(90)]
    sets += [np.unique(rng.integers(0, 10**6, 50, np.uint64)) for _ in range(20)]
    sets += [sets[0], sets[95]]
    got = common_shingles(sets, columns=37)
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    assert (got == want)[~np.eye(len(sets), dtype=bool)].all()


def test_plan_finds_the_threshold_pair():
    for nodes in (1, 10_000, 10**6, 10**9):
        coarse, tables = table_plan(nodes, 0.8, 1e-6)
        chosen = segment_bits(coarse, tables, 3)
        assert chosen.shape == (tables, coarse + FINE) and all(len(set(c)) == len(c) for c in chosen.tolist())
        assert nodes / 2**coarse <= 8192 and tables < 400


def test_one_of_each_group_of_the_table_stays(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    rows = duckdb.sql(f"select doc_id, text from '{path}' order by doc_id").fetchall()
    want = {rows[i][0] for i in plain_groups([t for _, t in rows])}
    assert {r["doc_id"] for r in keep_one(spark.read.parquet(path)).collect()} == want


def test_rows_that_share_an_id_or_have_none(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(50)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (5, b), (None, b), (None, c), (None, c), (None, None)]
    got = keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([(3, a), (5, b), (None, c), (None, None)], key=str)
