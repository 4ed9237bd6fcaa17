"""Token-id output: documents packed into rows of fixed length by best-fit decreasing.

A task tokenizes its documents, cuts those longer than a row into pieces (all tokens are kept), and packs the
pieces of a bounded buffer: longest first, each into the row with the least room that still holds it. A segment
tree over the amounts of room finds that row in logarithmic time. Nothing is shuffled.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame


class RoomTree:
    """Which amounts of room, 0 to ``most``, some row has; rows of equal room are a stack."""

    def __init__(self, most: int):
        self.leaves = 1 << max(1, most).bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.leaves
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) with the least room of at least ``need``; the row leaves the tree."""
        node = need + self.leaves
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):  # up, until a right sibling has some
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.any[node] = 0
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = 0
                node >>= 1
        return room, row


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """The items of each row. Lengths are 1 to ``capacity``."""
    tree, rows = RoomTree(capacity), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[item])
        if found is None:
            found = capacity, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(item)
        if room > lengths[item]:
            tree.put(room - lengths[item], row)
    return rows


@lru_cache(2)
def _encoding(path: str):
    import tiktoken

    lines = (line.split() for line in open(path, "rb"))
    ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokens(text: str, path: str) -> np.ndarray:
    return np.asarray(_encoding(path).encode_ordinary(text), np.int64)


PACKED = (
    "n_tokens int, input_ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "segments array<struct<doc_id: {id}, first_token: long, length: int>>"
)


def pack(
    documents: DataFrame, capacity: int = 2048, tokenizer: str = "byte_bpe_50k.tiktoken", end_id: int | None = 50256,
    pad_id: int = 50256, buffer_tokens: int = 4_000_000,
) -> DataFrame:
    """The packed rows: shard and row name them; ``input_ids`` holds ``capacity`` ids (little-endian, 16 bits
    where the ids allow, else 32), padded after ``n_tokens``; ``cu_seqlens`` the cumulative segment lengths from 0 on,
    as variable-length attention takes them; ``position_resets`` where positions start at 0 again;
    ``segments`` whose tokens they are and from which token of the document on.

    Each document ends with ``end_id``, if given. Null texts and texts without tokens give no segment. A document
    that no row holds is cut into pieces of ``capacity`` tokens and a rest; ordered by ``first_token`` they give
    it back. Repeated rows are documents of their own; null ids stay; other columns are not read; an empty
    table gives an empty result. A task holds ``buffer_tokens`` tokens and one document at a time.
    """
    path = public_tokenizers.path(tokenizer)
    kind = documents.schema["doc_id"].dataType.simpleString()
    dtype = "<u2" if max(len(_encoding(path)._mergeable_ranks), end_id or 0, pad_id) < 65536 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, row, held, id_type = TaskContext.get().partitionId(), 0, 0, pa.null()
        pieces: list[tuple[object, int, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal pieces, held, row
            out: list[tuple] = []
            for items in best_fit_decreasing([len(p[2]) for p in pieces], capacity):
                ids = np.full(capacity, pad_id, dtype)
                cuts = np.concatenate([[0], np.cumsum([len(pieces[i][2]) for i in items])]).astype(np.int32)
                ids[: cuts[-1]] = np.concatenate([pieces[i][2] for i in items])
                named = [{"doc_id": pieces[i][0], "first_token": pieces[i][1], "length": len(pieces[i][2])} for i in items]
                out.append((shard, row, int(cuts[-1]), ids.tobytes(), cuts.tolist(), cuts[:-1].tolist(), named))
                row += 1
            pieces, held = [], 0
            segment = pa.struct([("doc_id", id_type), ("first_token", pa.int64()), ("length", pa.int32())])
            types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(segment)]
            names = ["shard", "row", "n_tokens", "input_ids", "cu_seqlens", "position_resets", "segments"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names)

        for batch in batches:
            id_type = batch.column("doc_id").type
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                ids = tokens(text, path).astype(dtype)
                if end_id is not None:
                    ids = np.append(ids, np.array([end_id], dtype))
                for at in range(0, len(ids), capacity):
                    pieces.append((doc, at, ids[at : at + capacity]))
                held += len(ids)
                if held >= buffer_tokens:
                    yield flush()
        if pieces:
            yield flush()

    return documents.select("doc_id", "text").mapInArrow(run, "shard int, row int, " + PACKED.format(id=kind))


def position_ids(cu_seqlens: list[int]) -> np.ndarray:
    """Positions that restart with each segment."""
    lengths = np.diff(cu_seqlens)
    return np.arange(cu_seqlens[-1]) - np.repeat(np.asarray(cu_seqlens[:-1]), lengths)


def write_packed(packed: DataFrame, path: str) -> None:
    """The id matrices with their cuts and resets, one Parquet file or more for each shard."""
    packed.write.parquet(path)
