import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from visitmart.llm import minhash
from visitmart.llm.minhash import BINS, FACTORS, PRIME, VALUE, edited_likeness, fingerprinted, likeness
from visitmart.llm.queries import op11_minhash, oracle_sql


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain(text):
    """The fingerprint, bin by bin: the lenders of an empty bin are tried one after the other."""
    bins = {}
    for s in shingles(text):
        h = sum(f * (int(hashlib.md5(w.encode()).hexdigest()[:8], 16) & 0x7FFFFFFF) for f, w in zip(FACTORS, s)) % PRIME
        bins[h >> 48] = min(bins.get(h >> 48, VALUE), h & VALUE)
    if not bins:
        return ""
    out = ""
    for j in range(BINS):
        step, shift, place = (j * 167 + 13) % 256 + 1, (j * 101 + 7) % 257, 0
        lender = j
        while lender not in bins:
            lender = next(i for i in range(257) if (step * i + shift) % 257 == place)
            place += 1
        out += "%x" % (bins[lender] & 15)
    return out


def alike(a, b):
    if not a or not b:
        return float(a == b)
    return max(0.0, (sum(x == y for x, y in zip(a, b)) - 16) / 240)


def held(rows, documents):
    """``rows`` against the documents (id, text), neighbours found by sorting."""
    def number(t):
        return int(hashlib.md5(t.encode()).hexdigest()[:15], 16)

    order = sorted(((i, t or "") for i, t in documents), key=lambda r: (r[0] is None, -(r[0] or 0), number(r[1])))
    want = Counter()
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + following[:cut]
        f, e, x = plain(t), plain(edited), plain(following)
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, e, alike(f, e), alike(f, x))] += 1
    assert Counter(map(tuple, rows)) == want


def test_query_against_plain_code_and_sql(spark, data):
    rows = op11_minhash(spark, data).collect()
    table = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    held(rows, [(r[0], r[1]) for r in table])
    db = duckdb.connect()
    db.execute(f"create view documents as from '{data}/documents.parquet'")
    assert Counter(map(tuple, rows)) == Counter(db.execute(oracle_sql()["op11_minhash"]).fetchall())


@pytest.mark.parametrize("rows_per_range,max_ranges", [(2000, 1 << 15), (1, 1 << 15), (2, 3)])
def test_odd_rows_in_ranges_of_any_size(spark, odd, rows_per_range, max_ranges):
    rows = edited_likeness(odd, max_ranges, rows_per_range).collect()
    held(rows, [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()])


def test_hot_ids_and_copies(spark):
    rng = random.Random(3)
    docs = [(7, "same text here for all of these rows"), (None, None)] * 40 + [(7, " ".join(rng.choices("abcdefgh", k=9))) for _ in range(40)]
    docs += [(rng.choice([2**63 - 1, -(2**63), 0, 2**53 + 1, 2**53, None]), " ".join(rng.choices("xyz", k=4))) for _ in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    held(edited_likeness(df, rows_per_range=3).collect(), docs)
    text_ids = df.select(F.concat(F.lit("é,"), F.col("doc_id").cast("string")).alias("doc_id"), "text")
    got = edited_likeness(text_ids, rows_per_range=3)
    assert got.count() == len(docs) and got.schema["doc_id"].dataType.simpleString() == "string"


def test_one_row_and_none(spark, nothing):
    one = spark.createDataFrame([(1, "alone in the world of many words")], "doc_id long, text string")
    row = edited_likeness(one).first()
    assert row["near_next"] == 1.0 and 0 < row["near_edited"] <= 1
    empty = edited_likeness(nothing)
    assert empty.count() == 0 and empty.columns == edited_likeness(one).columns
    assert [f.dataType for f in empty.schema] == [f.dataType for f in edited_likeness(one).schema]


def test_likeness_estimates_jaccard_without_bias(spark):
    rng = random.Random(11)
    pairs = []
    for share in (0.0, 0.3, 0.6, 0.9):
        for length in (30, 300, 1500):  # most bins empty, some, hardly any
            for _ in range(25):
                a = [f"w{rng.randrange(10**6)}" for _ in range(length)]
                b = a[: int(length * share)] + [f"w{rng.randrange(10**6)}" for _ in range(length - int(length * share))]
                pairs.append((share, length, " ".join(a), " ".join(b)))
    df = spark.createDataFrame(pairs, "share double, length int, text string, other string")
    df = fingerprinted(df).withColumnRenamed("packed", "p").drop("fingerprint")
    got = fingerprinted(df, "other").select("share", "length", "text", "other", likeness(F.col("p"), F.col("packed")).alias("near")).collect()
    errors = {}
    for r in got:
        a, b = shingles(r["text"]), shingles(r["other"])
        errors.setdefault((r["share"], r["length"]), []).append(r["near"] - len(a & b) / len(a | b))
    for (share, length), e in errors.items():
        assert abs(sum(e) / len(e)) < (0.06 if length == 30 else 0.03), (share, length, e)
        assert max(map(abs, e)) < (0.35 if length == 30 else 0.16), (share, length, e)


def test_no_python_on_the_path(spark, odd):
    plan = edited_likeness(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and plan.count("Window ") == 1


def test_text_column_of_any_name(spark):
    df = spark.createDataFrame([("a b c", 1)], "`odd.text` string, text int")
    assert fingerprinted(df, "odd.text").first()["fingerprint"] == plain("a b c")
    assert minhash.WORDS == len(FACTORS)
