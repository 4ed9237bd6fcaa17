"""One-permutation MinHash fingerprints, in DataFrame operations only.

1. A text's shingles of five words are hashed once. The leading bits of a hash choose its bin; each bin keeps its least hash.
2. An empty bin borrows from a full one by optimal densification: each bin has an order of its own over all bins, the
   same for every text, and the first full bin of that order lends its hash.
3. Of each bin the lowest four bits are stored, packed into 64-bit words. Two fingerprints agree by chance in 1 of 16
   bins; their likeness corrects for that, which makes it an unbiased estimate of the shingle sets' Jaccard similarity
   (before it is cut off at 0).

Hashes are arithmetic over MD5s of words, so that any SQL engine can repeat them.

A document's neighbour in the order of ids is found in one shuffle of the texts. A pass over ids and text hashes
gives the bounds of ranges, which are rows themselves; each row finds its range by binary search in the bounds, the
first row of a range goes to the range before it as well, and a window within ranges sees all neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitmart.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Bins, stored bits of each, words of a shingle. Hashes have 56 bits: 8 for the bin, 48 to compare.
BINS, BITS, WORDS = 256, 4, 5
#: Fixed values of the hash: a prime below 2^56, and a factor for each word of a shingle.
PRIME = (1 << 56) - 5
FACTORS = (402653189, 481230217, 310248241, 521346511, 445213259)
VALUE = (1 << 48) - 1
#: The order of the bins that empty bin j borrows from: bin i has place (step(j) * i + shift(j)) mod 257.
AROUND = BINS + 1


def _step(j):
    return (j * 167 + 13) % BINS + 1


def _shift(j):
    return (j * 101 + 7) % AROUND


def hex_number(text: Column, digits: int) -> Column:
    """The first hexadecimal digits (15 at most) of the text's MD5, as a number."""
    return F.coalesce(F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long"), F.lit(0).cast("long"))


def _with_digits(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the stored bits of the text's bins, packed into longs; null for a text without words.

    Steps are columns of their own, as what a lambda refers to must have been computed before."""
    df = df.withColumn("__w", F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: hex_number(w, 8).bitwiseAND(F.lit(0x7FFFFFFF))))

    def shingle(first, count: int) -> Column:
        total = sum((F.lit(FACTORS[i]).cast("long") * F.get("__w", first + i) for i in range(1, count)), F.lit(FACTORS[0]).cast("long") * F.get("__w", first))
        return F.coalesce(total % F.lit(PRIME), F.lit(0).cast("long"))

    size, zero = F.size("__w"), F.lit(0)
    short = F.when(size == 0, F.array().cast("array<bigint>"))
    for count in range(1, WORDS):
        short = short.when(size == count, F.array(shingle(zero, count)))
    shingles = short.otherwise(F.transform(F.sequence(zero, F.greatest(size - WORDS, zero)), lambda i: shingle(i, WORDS)))
    # with a mark at the end of each bin, each bin has a first element
    marks = F.transform(F.sequence(zero, F.lit(BINS - 1)), lambda j: F.shiftleft(j.cast("long"), 48) + F.lit(VALUE))
    df = df.withColumn("__s", F.sort_array(F.concat(shingles, marks)))
    first = F.filter("__s", lambda x, i: (i == 0) | (F.shiftright(x, 48) != F.shiftright(F.get("__s", i - 1), 48)))
    df = df.withColumn("__b", first)

    def is_full(x: Column) -> Column:
        return x.bitwiseAND(F.lit(VALUE)) != F.lit(VALUE)

    def low(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    df = df.withColumn("__full", F.filter("__b", is_full)).withColumn("__l", F.transform("__b", lambda x: F.when(is_full(x), low(x))))
    # which bin has the first places of each bin's order; beyond them, the least place of all full bins
    lenders = [F.split(F.lit(",".join(str((place - _shift(j)) * pow(_step(j), -1, AROUND) % AROUND) for j in range(BINS))), ",").cast("array<int>") for place in range(6)]

    def digit(own: Column, j: Column) -> Column:
        rest = F.transform("__full", lambda x: (_step(j) * F.shiftright(x, 48) + _shift(j)) % AROUND * (1 << BITS) + low(x))
        return F.coalesce(own, *[F.get("__l", F.get(lender, j)) for lender in lenders], low(F.array_min(rest)))

    df = df.withColumn("__d", F.when(F.size("__full") > 0, F.transform("__l", digit)))
    each = 64 // BITS
    packed = F.transform(
        F.sequence(zero, F.lit(BINS // each - 1)),
        lambda k: F.aggregate(F.slice("__d", k * each + 1, each), F.lit(0).cast("long"), lambda sum_, d: F.shiftleft(sum_, BITS).bitwiseOR(d)),
    )
    return df.withColumn(out, F.when(F.col("__d").isNotNull(), packed)).drop("__w", "__s", "__b", "__full", "__l", "__d")


def hexadecimal(packed: Column) -> Column:
    """A fingerprint as text, one digit a bin; empty for a text without words."""
    return F.coalesce(F.array_join(F.transform(packed, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """The Jaccard similarity that two packed fingerprints stand for: agreeing bins, less those that agree by chance.
    Two texts without words are alike (1), one is unlike all others (0)."""
    ones = F.lit(0x1111111111111111)

    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        any_bit = d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseOR(F.shiftrightunsigned(d, 2)).bitwiseOR(F.shiftrightunsigned(d, 3))
        return F.bit_count(any_bit.bitwiseAND(ones)).cast("int")

    chance = BINS >> BITS
    agree = F.lit(BINS) - F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda sum_, x: sum_ + x)
    corrected = F.greatest((agree - chance) / F.lit(float(BINS - chance)), F.lit(0.0))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(corrected)


def fingerprinted(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with ``packed``, the fingerprint of each row's whole text as an array of longs (see
    :func:`likeness`), and ``fingerprint``, the same as text. Null texts count as empty."""
    out = _with_digits(documents.withColumn("__text", F.coalesce(F.col(f"`{text}`"), F.lit(""))), "__text", "packed").drop("__text")
    return out.withColumn("fingerprint", hexadecimal(F.col("packed")))


def _bounds(spark: SparkSession, groups: DataFrame, max_ranges: int, rows_per_range: int) -> list:
    """Rows of ``groups`` (key, h) that begin ranges of about equal numbers of rows, in order; the first row of all is
    the first bound. They set the balance of tasks only, so that a sample is enough, chosen by hashes."""
    n = groups.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(max_ranges, max(4 * parts, n // rows_per_range), n)
    order = [F.col("key").desc_nulls_last(), F.col("h")]
    if not ranges:
        return []
    first = groups.orderBy(*order).limit(1).collect()
    chosen = groups.where(F.pmod(F.xxhash64("h", "key"), F.lit(n)) < 4 * ranges) if n > 4 * ranges else groups
    rows = chosen.select("key", "h").orderBy(*order).collect()  # 4 * max_ranges, as hashes fall
    return [first[0][:2], *[r for r in rows[4 if n > 4 * ranges else 1 :: 4 if n > 4 * ranges else 1] if r[:2] != first[0][:2]]]


def _with_next(docs: DataFrame, bounds: list, integral: bool) -> DataFrame:
    """``docs`` (key, h, text, packed, ...; no two rows equal in key and h) with ``next_text`` and ``next_packed``."""
    nulls_from = sum(b[0] is not None for b in bounds)
    keys = F.split(F.lit(",".join("0" if b[0] is None else str(b[0]) for b in bounds)), ",")
    keys = keys.cast("array<bigint>") if integral else keys
    hashes = F.split(F.lit(",".join(str(b[1]) for b in bounds)), ",").cast("array<bigint>")

    def begins_at(p: Column) -> Column:  # bound p (from 1) is no later than the row
        k, h = F.get(keys, p - 1), F.get(hashes, p - 1)
        behind_nulls = F.col("key").isNull() & (h <= F.col("h"))
        return F.when(p > nulls_from, behind_nulls).otherwise(F.col("key").isNull() | (k > F.col("key")) | ((k == F.col("key")) & (h <= F.col("h"))))

    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    place = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda p, step: F.when((p + step <= len(bounds)) & F.coalesce(begins_at(p + step), F.lit(False)), p + step).otherwise(p),
    )
    docs = docs.withColumn("range", place - 1)
    is_null = F.col("range") >= nulls_from
    first = (F.get(hashes, "range") == F.col("h")) & (F.col("key").isNull() == is_null) & (is_null | (F.get(keys, "range") == F.col("key")))

    def at(range_: Column, guest: bool) -> Column:
        return F.struct(range_.alias("range"), F.lit(guest).alias("guest"))

    own, before = at(F.col("range"), False), at(F.pmod(F.col("range") - 1, F.lit(len(bounds))), True)
    docs = docs.select("*", F.explode(F.when(F.coalesce(first, F.lit(False)), F.array(own, before)).otherwise(F.array(own))).alias("at"))
    docs = docs.select(*[c for c in docs.columns if c not in ("range", "at")], F.col("at.range").alias("range"), F.col("at.guest").alias("guest"))
    order = Window.partitionBy("range").orderBy("guest", F.col("key").desc_nulls_last(), "h")
    docs = docs.select("*", F.lead("text").over(order).alias("next_text"), F.lead("packed").over(order).alias("next_packed"))
    return docs.where("NOT guest").drop("range", "guest")


def edited_likeness(documents: DataFrame, max_ranges: int = 1 << 15, rows_per_range: int = 2000) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    The edited text ends in the beginning of the next document: its last third of code points, rounded down, gives
    way to as many of the next, or all where it has fewer. Documents go by descending id (whole numbers by value,
    other ids by the bytes of their text), null ids last, equal ids by a hash of the text; the first follows the last.
    Null texts are empty. Rows equal in id and text follow each other and have a result each; they are
    merged before the shuffle. A single row is its own neighbour. A text of fewer than five words is one shingle, one
    without words has the fingerprint ''. Other columns are not read; an empty table gives an empty result.
    """
    spark, kind = documents.sparkSession, documents.schema["doc_id"].dataType.typeName()
    integral = kind in ("byte", "short", "integer", "long")
    key = F.col("doc_id").cast("long") if integral else F.hex(F.col("doc_id").cast("string"))
    text = F.coalesce("text", F.lit(""))
    keyed = documents.select("doc_id", text.alias("text"), key.alias("key"), hex_number(text, 15).alias("h"))
    groups = materialize(keyed.groupBy("key", "h").agg(F.count(F.lit(1)).alias("copies")), "groups")
    bounds = _bounds(spark, groups, max_ranges, rows_per_range)
    result = "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    repeated = groups.where("copies > 1")
    one, several = keyed.withColumn("copies", F.lit(1).cast("long")), None
    if repeated.limit(1).count():
        r = repeated.select(F.col("key").alias("k2"), F.col("h").alias("h2"), F.col("copies").alias("copies"))
        same = keyed["key"].eqNullSafe(r["k2"]) & (keyed["h"] == r["h2"])
        several = materialize(keyed.join(r, same).drop("k2", "h2").dropDuplicates(["key", "h"]), "several")
        one = keyed.join(r, same, "left_anti").withColumn("copies", F.lit(1).cast("long")).unionByName(several)
    docs = _with_next(_with_digits(one, "text", "packed"), bounds, integral) if bounds else None
    if docs is None:
        return documents.limit(0).select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in zip(result[1:], ("long", *["string"] * 3, "double", "double"), strict=True)])
    docs = docs.drop("copies")
    if several is not None:  # all copies but one are followed by themselves
        selves = _with_digits(several, "text", "packed").withColumn("next_text", F.col("text")).withColumn("next_packed", F.col("packed"))
        selves = selves.withColumn("copy", F.explode(F.sequence(F.lit(2).cast("long"), "copies")))
        docs = docs.unionByName(selves.drop("copies", "copy"))
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    docs = docs.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    docs = _with_digits(docs.drop("text", "next_text"), "edited", "edited_packed")
    packed, changed = F.col("packed"), F.col("edited_packed")
    return docs.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), hexadecimal(packed).alias("fingerprint"),
        hexadecimal(changed).alias("edited_fingerprint"), likeness(packed, changed).alias("near_edited"), likeness(packed, F.col("next_packed")).alias("near_next"),
    )


#: The same in SQL, by grouping shingles by bin: 256 bins of 4 bits, shingles of five words.
EDITED_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n FROM documents),
r AS (SELECT *, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, CAST('0x' || substr(md5(t), 1, 15) AS BIGINT)) AS k, count(*) OVER () AS total FROM d),
p AS (SELECT a.k, a.doc_id, a.n, a.t, b.k AS next_k, left(a.t, a.n - a.n // 3) || left(b.t, a.n // 3) AS edited FROM r a JOIN r b ON b.k = a.k % a.total + 1),
texts AS (SELECT k, 0 AS kind, t FROM p UNION ALL SELECT k, 1, edited FROM p),
words AS (SELECT k, kind, list_transform(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), lambda x: CAST('0x' || substr(md5(x), 1, 8) AS BIGINT) & 2147483647) AS w FROM texts),
shingles AS (SELECT k, kind, unnest(list_transform(range(1, greatest(len(w) - 3, CAST(len(w) > 0 AS INTEGER) + 1)), lambda i:
    ({" + ".join(f"{f} * coalesce(w[i + {t}], 0)" for t, f in enumerate(FACTORS))}) % {PRIME})) AS h FROM words),
least_of AS (SELECT k, kind, h >> 48 AS bin, min(h) AS h FROM shingles GROUP BY ALL),
grid AS (SELECT k, kind, CAST(j AS BIGINT) AS j FROM (SELECT DISTINCT k, kind FROM least_of), range({BINS}) g(j)),
own AS (SELECT g.*, l.h FROM grid g LEFT JOIN least_of l ON l.k = g.k AND l.kind = g.kind AND l.bin = g.j),
lent AS (SELECT o.k, o.kind, o.j, arg_min(l.h, (((o.j * 167 + 13) % {BINS} + 1) * l.bin + (o.j * 101 + 7) % {AROUND}) % {AROUND}) AS h
         FROM own o JOIN least_of l ON l.k = o.k AND l.kind = o.kind WHERE o.h IS NULL GROUP BY ALL),
fp AS (SELECT o.k, o.kind, string_agg(substr('0123456789abcdef', CAST(coalesce(o.h, l.h) & 15 AS INTEGER) + 1, 1), '' ORDER BY o.j) AS f
       FROM own o LEFT JOIN lent l ON l.k = o.k AND l.kind = o.kind AND l.j = o.j GROUP BY o.k, o.kind),
three AS (SELECT p.*, coalesce(a.f, '') AS f, coalesce(b.f, '') AS e, coalesce(c.f, '') AS x FROM p
          LEFT JOIN fp a ON a.k = p.k AND a.kind = 0 LEFT JOIN fp b ON b.k = p.k AND b.kind = 1 LEFT JOIN fp c ON c.k = p.next_k AND c.kind = 0)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, f AS fingerprint, e AS edited_fingerprint,
       {{near_e}} AS near_edited, {{near_x}} AS near_next FROM three
"""


def _near(other: str) -> str:
    same = f"list_sum(list_transform(range(1, {BINS + 1}), lambda i: CAST(substr(f, i, 1) = substr({other}, i, 1) AS INTEGER)))"
    return f"CASE WHEN f = '' AND {other} = '' THEN 1.0::DOUBLE WHEN f = '' OR {other} = '' THEN 0.0::DOUBLE ELSE greatest(CAST({same} - {BINS >> BITS} AS DOUBLE) / {BINS - (BINS >> BITS)}.0::DOUBLE, 0.0::DOUBLE) END"


EDITED_SQL = EDITED_SQL.format(near_e=_near("e"), near_x=_near("x"))
