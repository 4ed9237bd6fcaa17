"""Benchmark decontamination by SimHash of item-sized windows.

A benchmark item of n words is compared with the windows of n words of a document. Windows are looked up by
multi-index Hamming blocks, which return every item whose fingerprint lies within the radius, and the exact
weighted similarity of the shingles decides. A window that can't reach the wanted similarity, because too few
of its shingles occur in any item, is not fingerprinted, and of the blocks' items only those are looked at that
share so many shingles with a run of overlapping windows, by the postings of the shingles: these bounds lose nothing.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.common import filter_rows, map_texts, materialize

SHINGLE = 5
#: A fingerprint has 64 bits for each lane; a block is a byte of it, looked up with balls of so many bits.
LANES, BALL = 4, 2
BLOCKS = 8 * LANES
WORD = regex.compile(r"[\p{L}\p{N}\p{M}]+")
MIX = np.uint64(0x9E3779B97F4A7C15)
SALTS = np.random.default_rng(23).integers(0, 1 << 63, LANES, np.uint64)
MASKS = np.array([sum(1 << c for c in chosen) for r in range(BALL + 1) for chosen in combinations(range(8), r)], np.uint8)
#: A random odd number for each place in a word; longer words use them again.
PLACES = np.random.default_rng(17).integers(0, 1 << 63, 257, np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(1)
def word_characters() -> np.ndarray:
    """Which code points are letters, digits or marks."""
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000))
    table = np.zeros(0x110000, bool)
    for found in WORD.finditer(every):
        table[found.start() : found.end()] = True
    return table


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word. Words are runs of letters and digits, lower-cased, so that case and
    punctuation make no difference. A word's hash sums its characters, each times a random number for its place."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = word_characters()[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(edges):
        return np.zeros(0, np.uint64)
    lengths = edges[1::2] - edges[::2]
    first = np.cumsum(lengths) - lengths
    place = np.arange(first[-1] + lengths[-1]) - np.repeat(first, lengths)
    w = np.add.reduceat((codes[inside[1:-1]] + np.uint64(1)) * PLACES[place % len(PLACES)], first)
    return (w ^ (w >> np.uint64(32))) * MIX


def shingles_of(w: np.ndarray, words: int = SHINGLE) -> np.ndarray:
    """A hash of each run of so many words; of all words where there are fewer."""
    size = min(words, len(w))
    if not size:
        return np.zeros(0, np.uint64)
    n = len(w) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = (h ^ w[k : k + n]) * MIX
        h ^= h >> np.uint64(31)
    return h


def shingle_hashes(text: str | None) -> np.ndarray:
    return shingles_of(word_hashes(text))


def lane_bits(h: np.ndarray) -> np.ndarray:
    """The bits that each shingle votes with: ``LANES`` words of 64 bits, each with hashes of its own."""
    x = (h[:, None] ^ SALTS) * MIX
    x = (x ^ (x >> np.uint64(32))) * MIX
    return np.unpackbits((x ^ (x >> np.uint64(29))).view(np.uint8), axis=1)


def fingerprint(h: np.ndarray) -> np.ndarray:
    """The SimHash of a bag of shingles, as ``BLOCKS`` bytes."""
    ones = sum(lane_bits(h[at : at + 16384]).sum(0, dtype=np.int64) for at in range(0, len(h), 16384))
    return np.packbits(ones * 2 > len(h))


def window_fingerprints(h: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The fingerprints of windows of ``size`` shingles, from running sums over each run of overlapping windows."""
    out = np.empty((len(starts), BLOCKS), np.uint8)
    done = 0
    for run in overlapping(starts, size):
        for at in range(0, len(run), 4096):  # bounded memory
            own = run[at : at + 4096]
            ones = np.zeros((own[-1] + size - own[0] + 1, 64 * LANES), np.int32)
            np.cumsum(lane_bits(h[own[0] : own[-1] + size]), axis=0, out=ones[1:])
            place = own - own[0]
            out[done : done + len(own)] = np.packbits((ones[place + size] - ones[place]) * 2 > size, axis=1)
            done += len(own)
    return out


def overlapping(starts: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Runs of windows of ``size`` shingles of which each overlaps or touches the next."""
    return iter(np.split(starts, np.flatnonzero(np.diff(starts) > size) + 1))


def bag(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and how often each occurs."""
    return np.unique(h, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: shingles count as often as they occur."""
    place = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = int(np.minimum(a[1], np.where(b[0][place] == a[0], b[1][place], 0)).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


def radius_of(counts: np.ndarray, least: float, deviations: float = 5.0) -> int:
    """How many bits the fingerprint of a window that is just similar enough to an item may differ in: so many standard
    deviations above the expected number. A window of the item's size may hold some other shingles in place of the
    item's; it is reckoned that these are the item's most frequent ones, which turn the most bits."""
    size = int(counts.sum())
    other = size - math.ceil(2 * least / (1 + least) * size - 1e-9)
    heavy = np.sort(counts)[::-1]
    gone = heavy[: max(1, int(np.searchsorted(np.cumsum(heavy), other, side="right")) + (0 if heavy.max() == 1 else 1))] if other else heavy[:0]
    whole = float((heavy.astype(np.float64) ** 2).sum())
    # documents shorter than the item may lack a shingle without having another, hence one at least
    share = max(float((gone.astype(np.float64) ** 2).sum()), 1.0) / whole
    p = math.acos(max(0.0, 1 - share)) / math.pi
    if size < 16:
        p *= 1.25  # sums of few shingles are often even, and turn more easily
    bits = 64 * LANES
    return min(bits, math.ceil(bits * p + deviations * math.sqrt(bits * p * (1 - p))))


@dataclass
class Table:
    """Items of one size, under the values of the blocks of their fingerprints and under their shingles."""

    rows: np.ndarray  # their numbers
    prints: np.ndarray  # n, BLOCKS
    radius: np.ndarray
    #: postings: items of ``shingles[i]`` are ``posted[offsets[i] : offsets[i + 1]]``
    shingles: np.ndarray
    offsets: np.ndarray
    posted: np.ndarray
    #: BLOCKS, 256, n: which items a block value returns, balls of ``BALL`` bits around theirs; made on first use
    near: np.ndarray | None = None

    @classmethod
    def of(cls, rows: list[int], prints: list[np.ndarray], radius: list[int], shingles: list[np.ndarray]) -> Table:
        """``shingles``: the distinct ones of each item."""
        every = np.concatenate(shingles)
        order = np.argsort(every, kind="stable")
        distinct, first = np.unique(every[order], return_index=True)
        posted = np.repeat(np.arange(len(rows)), [len(own) for own in shingles])[order]
        return cls(np.asarray(rows), np.stack(prints), np.asarray(radius), distinct, np.append(first, len(every)), posted)

    def sharing(self, h: np.ndarray, least: float) -> np.ndarray:
        """The items whose shingles stand at ``least`` or more of the places of ``h``. No window inside ``h`` has more
        shingles in common with an item, as often as they occur."""
        own, counts = np.unique(h, return_counts=True)
        at = np.minimum(np.searchsorted(self.shingles, own), len(self.shingles) - 1)
        hit = self.shingles[at] == own
        at, counts = at[hit], counts[hit]
        lengths = self.offsets[at + 1] - self.offsets[at]
        before = np.cumsum(lengths) - lengths
        items = self.posted[np.arange(lengths.sum()) + np.repeat(self.offsets[at] - before, lengths)]
        return np.flatnonzero(np.bincount(items, np.repeat(counts, lengths), len(self.rows)) >= least)

    def balls(self) -> np.ndarray:
        if self.near is None:
            near = np.zeros((BLOCKS, 256, len(self.rows)), np.uint8)
            items, block = np.arange(len(self.rows)), np.arange(BLOCKS)[:, None]
            for mask in MASKS:
                near[block, self.prints.T ^ mask, items] = 1
            self.near = near
        return self.near

    def returned(self, prints: np.ndarray, items: np.ndarray, cells: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(fingerprint, item), of these items, of all that may be within the item's radius.

        The balls around each block's values are looked up. Were fewer than ``BLOCKS - radius // (BALL + 1)`` blocks
        within their ball, the others would add up to more than the radius: so items that are found in so many
        blocks are all that need a complete distance.
        """
        near, needed = self.balls(), BLOCKS - self.radius[items] // (BALL + 1)
        step = max(1, cells // len(items))
        for at in range(0, len(prints), step):
            part = prints[at : at + step]
            hits = np.zeros((len(part), len(items)), np.uint8)
            for b in range(BLOCKS):
                hits += near[b][:, items][part[:, b]]
            x, item = np.nonzero(hits >= needed)
            yield x + at, items[item]

    def within(self, prints: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, item), of these items, of those that are within the item's radius."""
        found = []
        for x, item in self.returned(prints, items):
            fine = np.bitwise_count(prints[x] ^ self.prints[item]).sum(1, dtype=np.int64) <= self.radius[item]
            found.append(np.stack([x[fine], item[fine]]))
        return tuple(np.concatenate(found, axis=1))


@dataclass
class ItemIndex:
    """A block of benchmark items, ready for look-ups."""

    similarity: float
    ids: list[int] = field(default_factory=list)
    bags: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    #: shingles in an item -> its table
    tables: dict[int, Table] = field(default_factory=dict)
    #: words in an item of less than a shingle -> its hash -> items
    short: dict[int, dict[int, list[int]]] = field(default_factory=dict)

    def build(self, items: list[tuple[int, str]]) -> ItemIndex:
        by_size: dict[int, list[tuple[int, np.ndarray, int, np.ndarray]]] = defaultdict(list)
        for item, text in items:
            w = word_hashes(text)
            h = shingles_of(w)
            if not len(h):
                continue
            row = len(self.ids)
            self.ids.append(item)
            self.bags.append(bag(h))
            if len(w) < SHINGLE:  # windows of its own length either equal it or have nothing in common with it
                self.short.setdefault(len(w), defaultdict(list))[int(h[0])].append(row)
            else:
                by_size[len(h)].append((row, fingerprint(h), radius_of(self.bags[row][1], self.similarity), self.bags[row][0]))
        self.tables = {size: Table.of(*map(list, zip(*found, strict=True))) for size, found in by_size.items()}
        every = [self.bags[row][0] for table in self.tables.values() for row in table.rows.tolist()]
        self.shingles = np.unique(np.concatenate(every)) if every else np.zeros(0, np.uint64)
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[(self.shingles >> np.uint64(48)).astype(np.int64)] = True
        return self

    def known(self, h: np.ndarray) -> np.ndarray:
        """Which hashes occur in some item."""
        hit = self.sieve[(h >> np.uint64(48)).astype(np.int64)]
        at = np.flatnonzero(hit)
        if len(at):
            place = np.minimum(np.searchsorted(self.shingles, h[at]), len(self.shingles) - 1)
            hit[at] = self.shingles[place] == h[at]
        return hit

    def matches(self, text: str | None) -> list[tuple[int, float, int]]:
        """(item, best similarity, first word of the best window), each item once."""
        w = word_hashes(text)
        best: dict[int, tuple[float, int]] = {}
        for words, items in self.short.items():
            windows = shingles_of(w, words)
            for at in np.flatnonzero(np.isin(windows, np.fromiter(items, np.uint64, len(items)))).tolist():
                for row in items[int(windows[at])]:
                    best.setdefault(row, (1.0, at))
        h = shingles_of(w)
        if len(h) and len(self.shingles):
            self._long_matches(h, best)
        return [(self.ids[row], s, at) for row, (s, at) in sorted(best.items())]

    def _long_matches(self, h: np.ndarray, best: dict[int, tuple[float, int]]) -> None:
        hit = self.known(h)
        if not hit.any():
            return
        reach = np.concatenate([[0], np.cumsum(hit)])
        for size, table in self.tables.items():
            n = min(size, len(h))
            inside = reach[n:] - reach[:-n]
            # similarity s of bags of w and i shingles needs (w + i) * s / (1 + s) common ones
            least = (n + size) * self.similarity / (1 + self.similarity) - 1e-9
            starts = np.flatnonzero(inside >= least)
            if not len(starts):
                continue
            for run in overlapping(starts, n):
                items = table.sharing(h[run[0] : run[-1] + n], least)
                if not len(items):
                    continue
                last, own = -1, None
                for x, item in zip(*(found.tolist() for found in table.within(window_fingerprints(h, run, n), items)), strict=True):
                    at, row = int(run[x]), int(table.rows[item])
                    if at != last:
                        last, own = at, bag(h[at : at + n])
                    s = similarity(own, self.bags[row])
                    if s >= self.similarity and s > best.get(row, (0.0, 0))[0]:
                        best[row] = (s, at)


def _items(benchmark: DataFrame, block: int, block_chars: int = 20_000_000) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks, ordered by id: ``block`` items and about ``block_chars`` characters at most."""
    rows = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select("item_id", "text")
    part: list[tuple[int, str]] = []
    held = 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        if part and (len(part) == block or held + len(r["text"]) > block_chars):
            yield part
            part, held = [], 0
        part.append((r["item_id"], r["text"]))
        held += len(r["text"])
    if part:
        yield part


def contaminated(
    documents: DataFrame, benchmark: DataFrame, min_similarity: float = 0.8, block: int = 20_000,
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word): each document row with each item that some window of it matches.

    The items are the stated query set; they go to the workers in blocks of ``block`` items, one pass over
    the documents for each, so what is broadcast stays bounded; :func:`radius_of` has the fingerprints' radius. Items and documents that
    are null or have no word match nothing; a document shorter than an item is one window. Repeated rows
    give repeated results; items with equal texts all match; null doc_ids stay. Columns other than doc_id
    and text (item_id, a whole number, and text) are not read. Empty tables give an empty result.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, similarity double, first_word long"
    spark = documents.sparkSession
    found = part = None
    for items in _items(benchmark, block):
        if part is not None:  # written before the next block is built
            part = materialize(part, "matches")
            found = part if found is None else found.unionByName(part)
        shared = spark.sparkContext.broadcast(ItemIndex(min_similarity).build(items))

        def find(texts: list[str | None], shared=shared) -> tuple[np.ndarray, list]:
            out = [(i, *m) for i, t in enumerate(texts) for m in shared.value.matches(t)]
            rows, ids, similarities, firsts = zip(*out, strict=True) if out else ((),) * 4
            return np.asarray(rows, np.int64), [pa.array(ids, pa.int64()), pa.array(similarities, pa.float64()), pa.array(firsts, pa.int64())]

        part = map_texts(documents.select("doc_id", "text"), "item_id long, similarity double, first_word long", find)
    if part is None:
        return spark.createDataFrame([], schema)
    return part if found is None else found.unionByName(part)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, min_similarity: float = 0.8, block: int = 20_000) -> DataFrame:
    """The rows of ``documents``, with all their columns, in which no benchmark item was found. The decision
    is made where the row lies: no join, no shuffle, and null or repeated ids are safe."""
    kept = documents
    for number, items in enumerate(_items(benchmark, block)):
        if number:  # one block's index in a pass
            kept = materialize(kept, "clean")
        shared = documents.sparkSession.sparkContext.broadcast(ItemIndex(min_similarity).build(items))

        def clean(texts: list[str | None], shared=shared) -> np.ndarray:
            return np.array([not shared.value.matches(t) for t in texts], bool)

        kept = filter_rows(kept, clean)
    return kept
