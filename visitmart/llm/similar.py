"""Near copies of texts: candidates by multi-index hashing over SimHashes, similarity of word shingles exactly.

A text's fingerprint has ``BITS`` bits, eight SimHashes of its set of five-word shingles. Two sets of Jaccard
similarity s differ in each bit with a chance of acos(2s / (1 + s)) / pi, 15 % at 0.8, so that no segment of
useful width is surely equal; the number of segments is chosen such that a pair at the threshold is missed by all
of them with a chance of ``miss`` at most. A segment's first bits say which table entries meet in a task; around
the value of its last ``FINE`` bits a small Hamming ball is enumerated and looked up there, and complete distances
verify what the look-up returns.

Texts that candidates connect form clusters. A cluster's sets of shingles meet in a task, or in pairs of blocks where
they are many, and are compared there exactly; what leaves a task is one row for each text, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.common import in_blocks, join_spread, map_texts, materialize, unite
from visitmart.llm.components import connected_components

MIX = np.uint64(0x9E3779B97F4A7C15)
LANES = 8
BITS = 64 * LANES
#: Bits of a segment that are looked up by balls, and the balls' radius.
FINE, BALL = 8, 2


def words_of(text: str | None) -> list[bytes]:
    """A-Z are lower-cased, words are what stands between ASCII blanks."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(parts: list[bytes], words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words; of all words where there are fewer."""
    if not parts:
        return np.zeros(0, np.uint64)
    w = np.fromiter((xxhash.xxh64_intdigest(p) for p in parts), np.uint64, len(parts))
    size = min(words, len(w))
    n = len(w) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = (h ^ w[k : k + n]) * MIX
        h ^= h >> np.uint64(29)
    return np.unique(h)


def wide_fingerprint(shingles: np.ndarray, seed: int = 42) -> bytes:
    """``LANES`` SimHashes of a set of shingles, each with hashes of its own."""
    salts = np.random.default_rng(seed).integers(0, 1 << 63, LANES, np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(shingles), 16384):  # bounded memory for very long texts
        h = (shingles[at : at + 16384, None] ^ salts) * MIX
        h = (h ^ (h >> np.uint64(32))) * MIX
        h ^= h >> np.uint64(29)
        ones += np.unpackbits(h.view(np.uint8), axis=1).sum(0, dtype=np.uint16)
    return np.packbits(ones * 2 > len(shingles)).tobytes()


def bit_chance(similarity: float) -> float:
    """How likely a bit differs between sets of equal size and that Jaccard similarity."""
    return math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi


def table_plan(nodes: int, similarity: float, miss: float, group: int = 8192) -> tuple[int, int]:
    """(first bits of a segment, number of segments): as many first bits as leave ``group`` entries a value."""
    coarse = max(0, min(BITS - FINE, math.ceil(math.log2(max(1, nodes) / group))))
    q = 1 - bit_chance(similarity)
    found = q**coarse * sum(math.comb(FINE, r) * (1 - q) ** r * q ** (FINE - r) for r in range(BALL + 1))
    return coarse, max(1, math.ceil(math.log(miss) / math.log1p(-found))) if found < 1 else 1


def segment_bits(coarse: int, tables: int, seed: int) -> np.ndarray:
    """Which bits each segment has: the fingerprint cut into segments, then permutations of it."""
    width, rng, out = coarse + FINE, np.random.default_rng(seed), []
    order = np.arange(BITS)
    while len(out) < tables:
        out += [order[k * width : (k + 1) * width] for k in range(BITS // width)]
        order = rng.permutation(BITS)
    return np.stack(out[:tables])


@lru_cache(1)
def balls() -> list[np.ndarray]:
    """For each value of the last bits the values in its ball that aren't smaller."""
    v = np.arange(1 << FINE)
    return [u[u >= x] for x in v.tolist() for u in [np.flatnonzero(np.bitwise_count(v ^ x) <= BALL)]]


class Candidates:
    """Pairs of entries of one table value, or of two blocks of it, found by balls and complete distances."""

    def __init__(self, group: pd.DataFrame, two: np.ndarray | None, similarity: float):
        self.prints = np.frombuffer(b"".join(group["print"]), np.uint64).reshape(-1, LANES)
        self.fine = group["fine"].to_numpy()
        self.n = group["n"].to_numpy()
        #: where two blocks are compared: whether an entry is of the second
        self.two, self.similarity = two, similarity
        p = bit_chance(similarity)
        # four standard deviations above the expected distance; bits of sets of a few shingles differ more often
        self.radius = BITS * p + 4 * math.sqrt(BITS * p * (1 - p))
        self.first_radius = 128 * 1.25 * p + 5 * math.sqrt(128 * 1.25 * p)

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, distance), each pair once."""
        by = np.argsort(self.fine, kind="stable")
        start = np.searchsorted(self.fine[by], np.arange((1 << FINE) + 1))
        for value in np.unique(self.fine).tolist():
            near = balls()[value]
            own = by[start[value] : start[value + 1]]
            others = np.concatenate([by[start[u] : start[u + 1]] for u in near.tolist()])
            if len(others) < 2:
                continue
            step = max(1, 2_000_000 // len(others))
            for at in range(0, len(own), step):
                rows = own[at : at + step]
                d = sum(np.bitwise_count(self.prints[rows, None, k] ^ self.prints[others, k]) for k in range(2))
                i, j = np.nonzero(d <= self.first_radius)
                same = j < len(own)  # the own value comes first in its ball
                keep = ~same | (j > i + at)
                i, j = rows[i[keep]], others[j[keep]]
                if self.two is not None:
                    keep = self.two[i] != self.two[j]
                    i, j = i[keep], j[keep]
                fits = np.minimum(self.n[i], self.n[j]) >= self.similarity * np.maximum(self.n[i], self.n[j]) - 1e-9
                i, j = i[fits], j[fits]
                d = np.bitwise_count(self.prints[i] ^ self.prints[j]).sum(1, dtype=np.int64)
                few = np.minimum(self.n[i], self.n[j]) < 16
                keep = d <= np.where(few, 1.15 * self.radius, self.radius)
                yield i[keep], j[keep], d[keep]


def _forest(key: np.ndarray, root: np.ndarray) -> pd.DataFrame:
    hung = np.flatnonzero(root != np.arange(len(root)))
    return pd.DataFrame({"a": key[hung], "b": key[root[hung]]})


def _connected(group: pd.DataFrame, two: np.ndarray | None, similarity: float) -> pd.DataFrame:
    """What candidates connect in a group: each entry with the first of its cluster there."""
    root = np.arange(len(group))
    for i, j, _ in Candidates(group, two, similarity):
        root = unite(root, i, j)
    return _forest(group["key"].to_numpy(), root)


def common_shingles(sets: list[np.ndarray], rare: int = 32, columns: int = 2048) -> np.ndarray:
    """How many shingles each two of the sets have in common. Shingles of few sets count pair by pair, those of
    many as columns of a matrix."""
    m = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(x) for x in sets])
    by = np.argsort(flat, kind="stable")
    flat, owner = flat[by], owner[by]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    size = np.diff(first, append=len(flat))
    number = np.repeat(np.arange(len(size)), size)
    few = size[number] <= rare
    inter = np.zeros((m, m), np.float32)
    place = np.arange(len(flat)) - first[number]
    for k in range(1, rare):
        at = np.flatnonzero(few & (place + k < size[number]))
        np.add.at(inter, (owner[at], owner[at + k]), 1)
    inter += inter.T
    many = np.flatnonzero(size > rare)
    for at in range(0, len(many), columns):
        part = many[at : at + columns]
        x = np.zeros((m, len(part)), np.float32)
        for c, s in enumerate(part):
            x[owner[first[s] : first[s] + size[s]], c] = 1
        inter += x @ x.T
    return inter


def _similar(group: pd.DataFrame, two: np.ndarray | None, similarity: float) -> pd.DataFrame:
    """What similar sets connect in a group: each text with the first that it is connected with there."""
    sets = [x.view(np.uint64) for x in group["shingles"]]
    n = np.array([len(x) for x in sets])
    inter = common_shingles(sets)
    near = inter >= similarity * (n[:, None] + n - inter) - 1e-6
    if two is not None:
        near &= two[:, None] != two
    i, j = np.nonzero(np.triu(near, 1))
    return _forest(group["key"].to_numpy(), unite(np.arange(len(n)), i, j))


def row_hash():
    """A row's number, from its id and its text."""
    return F.xxhash64("doc_id", "text")


def _tables(nodes: DataFrame, plan: tuple[int, int], seed: int, block: int) -> DataFrame:
    """Each node's entries: table ``t``, ``value`` of the segment's first bits, ``fine``, and the blocks to compare.
    Entries of a value beyond ``block`` are dealt to blocks, and each pair of blocks is a group of its own."""
    coarse, tables = plan
    chosen = segment_bits(coarse, tables, seed)
    powers = 1 << np.arange(coarse + FINE, dtype=np.int64)[::-1]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                bits = np.unpackbits(np.frombuffer(b"".join(batch["print"]), np.uint8).reshape(-1, BITS // 8), axis=1)
                values = np.stack([bits[:, c] @ powers for c in chosen], axis=1)
                yield batch.assign(segments=list(values))

    fields = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in nodes.schema.fields)
    cuts = nodes.mapInPandas(cut, f"{fields}, segments array<long>")
    value = F.shiftright("segment", FINE).alias("value")
    entries = cuts.select(*nodes.columns, F.posexplode("segments").alias("t", "segment")).select(
        *nodes.columns, "t", value, F.col("segment").bitwiseAND(F.lit((1 << FINE) - 1)).cast("int").alias("fine")
    )
    counted = cuts.select(F.posexplode("segments").alias("t", "segment")).select("t", value)
    return in_blocks(entries, ["t", "value"], "key", block, counted)


def similar_rows(
    documents: DataFrame, words: int = 5, similarity: float = 0.8, miss: float = 1e-6, seed: int = 42, block: int = 16384,
    set_block: int = 1024, set_shingles: int = 500_000, max_broadcast: int = 500_000,
) -> DataFrame:
    """(doc_id, row, root): each row with the number of its group of near copies.

    Texts of the same words are one node; two nodes are linked where the Jaccard similarity of their sets of
    ``words``-word shingles is ``similarity`` or more, and groups are what links connect. Texts without a word
    are one node. A task compares two blocks of ``set_block`` texts and ``set_shingles`` shingles each at most, but
    for a single longer text. Null ids and repeated rows stay; an empty table gives an empty result.
    """

    def describe(texts: list[str | None]) -> tuple[None, list]:
        keys, sizes, prints = [], [], []
        for t in texts:
            parts = words_of(t)
            s = shingle_set(parts, words)
            keys.append(xxhash.xxh64_intdigest(b" ".join(parts), seed))
            sizes.append(len(s))
            prints.append(wide_fingerprint(s, seed))
        return None, [np.array(keys, np.uint64).view(np.int64), np.array(sizes, np.int64), pa.array(prints, pa.binary())]

    def second(group: pd.DataFrame) -> np.ndarray | None:
        one, two = int(group["one"].iat[0]), int(group["two"].iat[0])
        return None if one == two else group["own"].to_numpy() == two

    numbered = documents.select("doc_id", row_hash().alias("row"), "text")
    rows = materialize(map_texts(numbered, "key long, n long, print binary", describe), "rows")
    nodes = rows.groupBy("key").agg(F.min("n").alias("n"), F.min("row").alias("row"), F.min("print").alias("print"))
    nodes = materialize(nodes.where("n > 0"), "nodes")
    entries = _tables(nodes.select("key", "n", "print"), table_plan(nodes.count(), similarity, miss), seed, block)
    near = entries.groupBy("t", "value", "one", "two").applyInPandas(lambda g: _connected(g, second(g), similarity), "a long, b long")
    clusters = materialize(connected_components(near).select(F.col("node").alias("key"), F.col("component").alias("cluster")), "clusters")

    members = materialize(clusters.join(nodes.select("key", "n", "row"), "key"), "clustered")
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("shingles"))
    # small clusters share tasks; sets of two clusters may be compared without harm
    shares = max(1, members.count() // 256)
    blocks = F.greatest(F.ceil(F.col("texts") / set_block), F.ceil(F.col("shingles") / set_shingles)).cast("long")
    small = (F.col("texts") <= 256) & (F.col("shingles") <= set_shingles // 4)
    task = F.when(small, F.pmod(F.xxhash64("cluster"), F.lit(shares))).otherwise(F.col("cluster"))
    dealt = join_spread(members, sizes.select("cluster", small.alias("small"), task.alias("task"), blocks.alias("blocks")), ["cluster"], "key")
    dealt = materialize(dealt.select("row", "key", "small", "task", "blocks", F.pmod(F.xxhash64("key"), "blocks").alias("own")), "dealt")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()  # rows of one number have one text: any of them will do
        for batch in batches:
            batch = batch[~batch["key"].duplicated() & ~batch["key"].isin(seen)]
            seen.update(batch["key"].tolist())
            found = [shingle_set(words_of(t if isinstance(t, str) else None), words).view(np.int64) for t in batch["text"]]
            yield batch.drop(columns="text").assign(shingles=found)

    small_enough = F.broadcast if dealt.count() <= max_broadcast else (lambda df: df)
    texts = numbered.select("row", "text").join(small_enough(dealt), "row").select("key", "small", "task", "blocks", "own", "text")
    texts = texts.mapInPandas(sets, "key long, small boolean, task long, blocks long, own long, shingles array<long>")
    texts = texts.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    texts = texts.select("small", "task", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "key", "shingles")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group[~group["key"].duplicated()]
        return _similar(group, second(group), similarity)

    links = texts.groupBy("small", "task", "one", "two").applyInPandas(compare, "a long, b long")
    groups = connected_components(links).select(F.col("node").alias("key"), F.col("component").alias("root"))
    named = materialize(groups, "named")
    return join_spread(rows.select("doc_id", "row", "key"), named, ["key"], "row", "left").select("doc_id", "row", F.coalesce("root", "key").alias("root"))
