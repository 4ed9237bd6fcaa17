import random
from collections import Counter

import duckdb
import numpy as np
import regex

from visitmart.llm.decontamination import BLOCKS, ItemIndex, Table, _items, bag, contaminated, drop_contaminated, fingerprint, radius_of, shingle_hashes, shingles_of, similarity, window_fingerprints, word_hashes


def weighted(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def brute(text, items, least=0.8):
    w = word_hashes(text)
    out = {}
    for i, t in items:
        words = word_hashes(t)
        own = shingles_of(words).tolist()
        h = shingles_of(w, min(5, len(words))).tolist() if len(words) else []
        if not own or not h or len(w) < 5 <= len(words):
            continue
        n = min(len(own), len(h))
        best = max(weighted(Counter(h[a : a + n]), Counter(own)) for a in range(len(h) - n + 1))
        if best >= least:
            out[i] = round(best, 9)
    return out


def test_hashes_tell_word_runs_apart(data):
    texts = [r[0] for r in duckdb.sql(f"select text from '{data}/documents.parquet' limit 100").fetchall()] + ["a b", "Ab C-d", "x" * 600, "", "é1 2", "ab a b"]
    seen = {}
    for t in texts:
        words = regex.findall(r"[\p{L}\p{N}\p{M}]+", t.lower())
        runs = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
        h = shingle_hashes(t).tolist()
        assert len(h) == len(runs)
        for run, x in zip(runs, h, strict=True):
            assert seen.setdefault(run, x) == x
    assert len(set(seen.values())) == len(seen)
    assert shingle_hashes("One, TWO three\nfour. Five!").tolist() == shingle_hashes("one two three four five").tolist()


def test_equals_brute_force(spark, data, odd, nothing):
    items = duckdb.sql(f"select item_id, text from '{data}/benchmark.parquet' order by 1").fetchall()
    docs = duckdb.sql(f"select doc_id, text from '{data}/documents.parquet' where length(text) < 1500 order by 1 limit 50").fetchall()
    rng = random.Random(2)
    for k, (_, text) in enumerate(items[:25]):  # passages as they are, with changed words, case and punctuation
        words = text.split()
        for change in range(k % 4):
            words[rng.choice((0, 1, len(words) - 1 - change, rng.randrange(len(words))))] = "changed"
        passage = " ".join(words)
        docs.append((9000 + k, "before it some words, " + (passage.upper().replace(",", " ;") if k % 3 else passage) + " and after it others"))
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, similarity int")
    bench = spark.createDataFrame([(*i, "z") for i in items] + [(77, None, None), (None, "no id", None), (78, "", None)], "item_id long, text string, doc_id string")
    want = {(d, i): s for d, t in docs for i, s in brute(t, items).items()}
    assert len(want) > 10
    for block in (20_000, 7):
        got = contaminated(df, bench, block=block).collect()
        assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in got} == want and len(got) == len(want)
    clean = drop_contaminated(df, bench, block=7)
    assert clean.columns == df.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted({d for d, _ in docs} - {d for d, _ in want})
    assert contaminated(odd, bench).count() == 0 and contaminated(nothing, bench).count() == 0
    assert drop_contaminated(odd, bench).count() == odd.count() and contaminated(df, bench.limit(0)).count() == 0


def test_repeated_shingles_count_with_their_number():
    index = ItemIndex(0.8).build([(1, "a b c d e " * 8)])
    assert index.matches("a b c d e " * 8) and not index.matches("a b c d e f")
    assert [m[0] for m in index.matches("x y " + "a b c d e " * 8 + "z")] == [1]


def test_items_come_in_blocks_bounded_by_number_and_characters(spark):
    items = [(i, "word " * i) for i in range(1, 30)]
    table = spark.createDataFrame([*items, (None, "x"), (99, None)], "item_id long, text string")
    for block, chars in ((4, 10**6), (100, 200), (100, 1)):
        got = list(_items(table, block, chars))
        assert [r for part in got for r in part] == items
        assert all(len(p) <= block and (len(p) == 1 or sum(len(t) for _, t in p) <= chars) for p in got)


def test_items_of_every_size_are_found_anywhere(spark):
    rng = random.Random(7)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [(100 * n + k, " ".join(rng.choice(vocabulary) for _ in range(n))) for n in range(1, 30) for k in range(3)]
    items += [(9000, "one " * 12), (9001, "x y x y x y x y z"), (9002, "a b c d e f g h i j " * 3)]
    docs = []
    for k, (_, text) in enumerate(items):
        words = text.split()
        for change in range(k % 3):
            words[rng.randrange(len(words))] = "changed" if change else rng.choice(vocabulary)
        around = [rng.choice(vocabulary) for _ in range(40)]
        docs.append((k, " ".join(around[:20] + words + around[20:])))
        docs.append((1000 + k, " ".join(words)))
        docs.append((2000 + k, " ".join(words[: len(words) - k % 4])))
    want = {(d, i): s for d, t in docs for i, s in brute(t, items).items()}
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = contaminated(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in got} == want and len(want) > 200


def test_blocks_return_all_within_the_radius_and_few_others():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 256, (2000, BLOCKS), np.uint8)
    radius = radius_of(np.ones(100, np.int64), 0.8)
    table = Table.of(list(range(2000)), list(prints), [radius] * 2000, list(np.arange(2000, dtype=np.uint64)[:, None]))
    every, seen = np.arange(2000), 0
    for flips in (0, 20, radius - 1, radius, radius + 1):
        for row in range(0, 60):
            bits = np.unpackbits(prints[row])
            bits[rng.choice(8 * BLOCKS, flips, replace=False)] ^= 1
            got = table.within(np.packbits(bits)[None], every)[1].tolist()
            seen += got.count(row)
            assert (row in got) == (flips <= radius)
    assert seen == 240
    # what the blocks return of random fingerprints, before complete distances
    values = rng.integers(0, 256, (50, BLOCKS), np.uint8)
    assert sum(len(x) for x, _ in table.returned(values, every)) < 0.05 * 50 * 2000
    assert len(table.within(values, every)[1]) == 0


def test_few_items_of_any_size_need_a_complete_distance():
    rng = np.random.default_rng(6)
    for size in (1, 2, 5, 8, 10, 20, 100):
        items = [rng.integers(0, 1 << 63, size, np.uint64) for _ in range(1000)]
        shared = rng.integers(0, 1 << 63, size, np.uint64)
        for k in range(0, 1000, 2):  # half of the items begin alike, as questions of one benchmark do
            items[k][: size // 2] = shared[: size // 2]
        bags = [bag(h) for h in items]
        table = Table.of(list(range(1000)), [fingerprint(h) for h in items], [radius_of(b[1], 0.8) for b in bags], [b[0] for b in bags])
        least, asked, found = 2 * size * 0.8 / 1.8 - 1e-9, 0, 0
        for k in range(100):
            text = np.concatenate([rng.integers(0, 1 << 63, 30, np.uint64), items[k], rng.integers(0, 1 << 63, 30, np.uint64)])
            sharing = table.sharing(text, least)
            assert sharing.tolist() == [i for i, h in enumerate(items) if np.isin(text, h).sum() >= least]
            pairs = [i for _, own in table.returned(fingerprint(items[k])[None], sharing) for i in own.tolist()]
            asked, found = asked + len(pairs), found + pairs.count(k)
        assert found == 100 and asked <= 110, size


def test_windows_fingerprints_are_those_of_their_shingles():
    h = np.random.default_rng(5).integers(0, 1 << 63, 9000, np.uint64)
    for size, starts in ((1, [0, 5, 8999]), (40, [0, 1, 2, 41, 42, 300, 341, 382, 8960]), (3, list(range(8000)))):
        got = window_fingerprints(h, np.asarray(starts), size)
        for k in list(range(min(9, len(starts)))) + [len(starts) - 1]:
            assert (got[k] == fingerprint(h[starts[k] : starts[k] + size])).all()


def test_radius_covers_similar_bags():
    rng = np.random.default_rng(4)
    missed = 0
    for n in (5, 9, 12, 20, 60, 300):
        for _ in range(200):
            a = rng.integers(0, 1 << 63, n, np.uint64)
            b = a.copy()
            other = int(n - np.ceil(1.6 / 1.8 * n - 1e-9))
            b[rng.choice(n, other, replace=False)] = rng.integers(0, 1 << 63, other, np.uint64)
            assert similarity(bag(a), bag(b)) >= 0.8
            missed += np.bitwise_count(fingerprint(a) ^ fingerprint(b)).sum() > radius_of(bag(a)[1], 0.8)
    assert missed == 0
