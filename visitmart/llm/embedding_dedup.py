"""Near-duplicate embeddings by randomised-rotation binary codes.

A vector is turned by random rotations and kept as the signs of its coordinates (its code), together with the
inner product of the unit vector and the unit vector that the first rotation's signs stand for (its correction factor). Codes and
factors are computed and written once; what follows works on them until a pair is undecided:

1. Slices of the sign bits of several rotations are hash tables. What travels to a table is a code, not a vector.
   There the codes' distance estimates the angle, and pairs whose bound on it excludes the threshold are decided.
2. Only for entries with an undecided pair are vectors fetched. The inner product of a vector with the other's
   code, divided by the stored factor, is an unbiased estimate of the cosine, whose error is at most
   ``sqrt((1 - f^2) / f^2) * eps / sqrt(d - 1)`` but for a chance that falls off exponentially in eps squared.
   Pairs whose upper bound reaches the threshold are computed exactly, in double precision; no others are.

The number of tables is chosen such that a pair at the threshold misses all of them with a chance of ``miss`` at
most; the slices' width grows with the logarithm of the rows, so that tables hold about ``bucket`` rows a value.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.common import in_blocks, join_spread, materialize
from visitmart.llm.components import connected_components

#: Width of the confidence bounds: of estimates, in the units of the error bound above; of codes' distances, in
#: standard deviations.
EPS = 6.0
#: Bits of a code, at least.
CODE_BITS = 128


@lru_cache(256)
def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix; the same for the same arguments."""
    q, r = np.linalg.qr(np.random.default_rng((seed, dim)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def units(vectors: list[np.ndarray]) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that squares neither overflow nor vanish."""
    v = np.stack(vectors).astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


class Codes:
    """Signs, correction factors and table keys of unit vectors of one length. A code holds the signs of as many
    rotations as give ``CODE_BITS`` bits; the factor is that of the first."""

    def __init__(self, dim: int, bits: int, tables: int, seed: int):
        # slices never span two rotations
        self.per_rotation, self.bits, self.tables, self.dim, self.seed = max(1, dim // bits), min(bits, dim), tables, dim, seed
        self.coded = -(-CODE_BITS // dim)
        self.tables_coded = min(tables, self.coded * self.per_rotation)

    def slices(self, signs: np.ndarray, number: int) -> np.ndarray:
        """The slice of each of the first tables, from the signs of one rotation after the other."""
        powers = 1 << np.arange(self.bits)
        first = [t // self.per_rotation * self.dim + t % self.per_rotation * self.bits for t in range(number)]
        return np.stack([signs[:, a : a + self.bits] @ powers for a in first], axis=1)

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code as packed bits, correction factor, slice of each table), one row for each vector."""
        rotations = max(self.coded, -(-self.tables // self.per_rotation))
        signs = np.concatenate([unit @ rotation(self.dim, self.seed + i) >= 0 for i in range(rotations)], axis=1)
        factor = np.abs(unit @ rotation(self.dim, self.seed)).sum(1) / math.sqrt(self.dim)
        return np.packbits(signs[:, : self.coded * self.dim], axis=1), factor, self.slices(signs, self.tables).astype(np.int64)

    def signs(self, codes: list[bytes]) -> np.ndarray:
        return np.unpackbits(np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1), axis=1, count=self.coded * self.dim)

    def estimates(self, signs: np.ndarray, factor: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Unbiased estimates of the cosines: a row for each code, a column for each vector."""
        turned = unit @ rotation(self.dim, self.seed)
        return ((signs[:, : self.dim] * 2.0 - 1.0) @ turned.T) / math.sqrt(self.dim) / factor[:, None]

    def slack(self, factor: np.ndarray) -> np.ndarray:
        return np.sqrt((1 - factor**2).clip(0)) / factor * EPS / math.sqrt(max(1, self.dim - 1))

    def farthest(self, threshold: float) -> float:
        """The largest distance of two codes that leaves it open whether their vectors' cosine reaches the threshold."""
        p = math.acos(max(-1.0, min(1.0, threshold))) / math.pi
        bits = self.coded * self.dim
        return bits * p + EPS * math.sqrt(bits * p * (1 - p))


def table_plan(rows: int, dim: int, threshold: float, bucket: int, miss: float) -> tuple[int, int]:
    """(bits of a slice, number of tables)."""
    bits = max(1, min(dim, 24, math.ceil(math.log2(max(2, rows) / bucket))))
    share = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-share))) if share < 1 else 1


def _screen(group: pd.DataFrame, second: np.ndarray | None, table: int, codes: Codes, threshold: float) -> np.ndarray:
    """Which entries of a table value have a pair that their codes leave undecided, and that no earlier table over
    the same code has seen. With ``second`` only pairs between that block and the other count."""
    signs = codes.signs(group["code"].tolist())
    packed = np.packbits(signs, axis=1)
    words = np.zeros((len(packed), -(-packed.shape[1] // 8) * 8), np.uint8)
    words[:, : packed.shape[1]] = packed
    words = words.view(np.uint64)
    seen = codes.slices(signs, min(table, codes.tables_coded)) if table else None
    limit, m = codes.farthest(threshold), len(group)
    open_ = np.zeros(m, bool)
    left = np.arange(m) if second is None else np.flatnonzero(~second)
    right = np.arange(m) if second is None else np.flatnonzero(second)
    step = max(1, 1_000_000 // max(1, len(right)))
    for at in range(0, len(left), step):
        rows = left[at : at + step]
        d = sum(np.bitwise_count(words[rows, None, k] ^ words[right, k]).astype(np.uint16) for k in range(words.shape[1]))
        i, j = np.nonzero(d <= limit)
        i, j = rows[i], right[j]
        if second is None:
            i, j = i[i < j], j[i < j]
        if seen is not None:
            fresh = (seen[i] != seen[j]).all(1)
            i, j = i[fresh], j[fresh]
        open_[i] = open_[j] = True
    return open_


def _links(group: pd.DataFrame, second: np.ndarray | None, table: int, codes: Codes, threshold: float) -> pd.DataFrame:
    """Links within a block, or between two: for each entry how many rows it is linked to (copies counted), and
    the smallest node that it reaches within the blocks. Pairs stay in here."""
    a = group if second is None else group[~second]
    b = group if second is None else group[second]
    va, vb = units(a["v"].tolist()), units(b["v"].tolist())
    ka, kb = np.stack(a["keys"].to_numpy())[:, :table], np.stack(b["keys"].to_numpy())[:, :table]
    signs, factor = codes.signs(a["code"].tolist()), a["factor"].to_numpy()
    slack = codes.slack(factor)
    ca, cb = a["copies"].to_numpy(), b["copies"].to_numpy()
    na, nb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    pairs = []
    for at in range(0, len(a), 512):
        rows = slice(at, at + 512)
        upper = codes.estimates(signs[rows], factor[rows], vb) + slack[rows, None]
        i, j = np.nonzero(upper >= threshold - 1e-9)
        i += at
        if second is None:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 200_000):
            x, y = i[k : k + 200_000], j[k : k + 200_000]
            if table:  # a pair counts in the first table in which its vectors share a slice
                fresh = (ka[x] != kb[y]).all(1)
                x, y = x[fresh], y[fresh]
            exact = np.einsum("ij,ij->i", va[x], vb[y]) >= threshold
            x, y = x[exact], y[exact]
            np.add.at(na, x, cb[y])
            np.add.at(nb, y, ca[x])
            pairs.append(np.stack([x, y]))
    nodes = np.concatenate([a["node"].to_numpy(), b["node"].to_numpy()[: 0 if second is None else None]])
    links = na + nb if second is None else np.concatenate([na, nb])
    x, y = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    y = y + (0 if second is None else len(a))
    by_rank = np.argsort(nodes)
    root = np.argsort(by_rank)  # ranks, so that the smallest node wins
    while len(x):
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = np.minimum(root, root[by_rank[root]])
        if (root == before).all():
            break
    keep = links > 0
    return pd.DataFrame({"node": nodes[keep], "links": links[keep], "least": nodes[by_rank[root]][keep]})


def embedding_groups(
    embeddings: DataFrame, threshold: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding",
    miss: float = 1e-6, bucket: int = 2048, block: int = 4096, seed: int = 29, max_broadcast: int = 50_000,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row.

    Vectors link where their cosine, in double precision, is ``threshold`` or more; ``n_links`` counts the
    other rows linked directly, ``component_id`` is the smallest id reachable by links, itself included, and
    ``kept`` tells whether that is the row's own. Vectors of every length are compared with those of their own.
    Vectors that are null, zero, or hold null or non-finite components link with nothing and form components of
    their own. Equal vectors are merged before the search, so copies cost nothing in it; values of a table with
    more than ``block`` vectors are split and their blocks compared two by two, so that no task holds more than two
    blocks. Rows with equal ids but different vectors have links of their own; a row with a null id links with
    nothing. Other columns are not read; an empty table gives an empty result.
    """
    vector = F.col("v")
    # floats travel as floats, which loses nothing; all arithmetic is in double precision
    element = "array<float>" if embeddings.schema[vector_column].dataType.simpleString() == "array<float>" else "array<double>"
    rows = embeddings.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast(element).alias("v"))
    sound = (
        F.col("id").isNotNull()
        & (F.size(vector) > 0)
        & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        & F.exists(vector, lambda x: x != 0.0)
    )
    sound = F.coalesce(sound, F.lit(False))
    # 128 bits stand for a vector, so that the vectors themselves are shuffled once
    named = [F.xxhash64(vector).alias("h1"), F.xxhash64(F.lit(seed), vector).alias("h2")]
    merged = rows.where(sound).groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    merged = materialize(merged.select(F.monotonically_increasing_id().alias("node"), "v", F.size("v").alias("dim"), "id", "copies", *named), "vectors")
    lengths = {r["dim"]: r["n"] for r in merged.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    plans = {dim: (dim, *table_plan(n, dim, threshold, bucket, miss), seed) for dim, n in lengths.items()}

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                code, factor, keys = Codes(*plans[dim]).encode(units(part["v"].tolist()))
                yield part[["node", "dim", "copies"]].assign(code=[c.tobytes() for c in code], factor=factor, keys=list(keys))

    coded = merged.select("node", "dim", "copies", "v").mapInPandas(encode, "node long, dim int, copies long, code binary, factor double, keys array<long>")
    coded = materialize(coded, "codes")
    value = ["dim", "t", "key"]
    entries = coded.select("dim", F.posexplode("keys").alias("t", "key"), "node", "code")
    entries = in_blocks(entries, value, "node", block, max_broadcast=max_broadcast)

    def context(group: pd.DataFrame) -> tuple[np.ndarray | None, int, Codes]:
        one, two, t, dim = (int(group[c].iat[0]) for c in ("one", "two", "t", "dim"))
        return None if one == two else group["own"].to_numpy() == two, t, Codes(*plans[dim])

    def screen(group: pd.DataFrame) -> pd.DataFrame:
        return group.loc[_screen(group, *context(group), threshold), [*value, "one", "two", "own", "node"]]

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        return _links(group, *context(group), threshold)

    by = [*value, "one", "two"]
    undecided = materialize(entries.groupBy(*by).applyInPandas(screen, "dim int, t int, key long, one long, two long, own long, node long"), "undecided")
    fetched = undecided.join(coded.drop("dim"), "node").join(merged.select("node", "v"), "node")
    found = materialize(fetched.groupBy(*by).applyInPandas(compare, "node long, links long, least long"), "links")
    direct = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = connected_components(found.select(F.col("node").alias("a"), F.col("least").alias("b")))
    members = merged.select("node", "id", "copies", "h1", "h2").join(direct, "node", "left").join(linked, "node", "left")
    members = members.select("node", "h1", "h2", "id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("root"))
    members = materialize(members, "members")
    smallest = members.groupBy("root").agg(F.min("id").alias("component_id"))
    groups = materialize(join_spread(members, smallest, ["root"], "node").select("h1", "h2", "n_links", "component_id"), "groups")
    own = rows.where(sound).select("id", *named)
    out = join_spread(own, groups, ["h1", "h2"], "id").select("id", "n_links", "component_id")
    out = out.unionByName(rows.where(~sound).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
