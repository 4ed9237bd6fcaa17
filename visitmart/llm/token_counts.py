"""Token counts by compiled finite-state transducers.

Two deterministic transducers do the work of the byte-level BPE tokenizer:

* :class:`Splitter` cuts a text into the words within which merges happen. Its table has twelve states; a
  text is cut into equal chunks, each chunk is turned into a map from entry state to exit state, the maps
  are composed by a parallel prefix scan, and a second pass from the known entry states gives the cuts.
* :class:`CountTransducer` reads the bytes of a word. A state is the set of ways in which the bytes read so
  far may still be the start of a longer token, each with the token before it; a transition carries by how
  much the number of tokens changes. A word's count is the sum along its path. The states are compiled on
  first use (a few hundred thousand for natural text) and all words of a batch advance in step; of long words
  the chunks do, whose maps from entry state to exit state and count are composed by a prefix scan as well.

That this is exact rests on a property of merge-ranked BPE: every prefix of an encoding, cut between two
tokens, is the encoding of the prefix, and a sequence of tokens is an encoding if each neighbouring pair is.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from visitmart.llm.common import map_texts

#: What the pattern of byte-level BPE counts as white space.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

APOSTROPHE, SPACE, BLANK, NUMBER, OTHER, LETTER, STMD, R, V, L, E, END = range(12)
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHER, SPACE1, BLANK1, SPACE2, BLANK2, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(12)
N_STATES = 12
#: A transition's output: a word starts at this character, at the one before.
HERE, BEFORE = 1, 2
SENTINEL = 0x110000


@lru_cache(1)
def char_classes() -> np.ndarray:
    """The class of each code point; the entry after the last is the sentinel's."""
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(SENTINEL))
    table = np.full(SENTINEL, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for found in regex.finditer(pattern, every):
            table[found.start() : found.end()] = kind
    # the tokenizer's own character tables may be older than regex's: it is asked about the newest characters
    words = ByteLevel(add_prefix_space=False).pre_tokenize_str
    for c in np.flatnonzero(table != OTHER).tolist():
        if unicodedata.category(every[c]) == "Cn" and len(words(("9" if table[c] == NUMBER else "a") + every[c])) > 1:
            table[c] = OTHER
    table[list(WHITE_SPACE)] = BLANK
    table[0x20] = SPACE
    table[ord("'")] = APOSTROPHE
    for chars, kind in (("stmd", STMD), ("r", R), ("v", V), ("l", L), ("e", E)):
        for c in chars:
            table[ord(c)] = kind
    return np.append(table, np.uint8(END))


def _splitting_table() -> np.ndarray:
    """[state * 12 + class] -> next state * 4 + output."""
    letters = (LETTER, STMD, R, V, L, E)
    fresh = {APOSTROPHE: QUOTE, SPACE: SPACE1, BLANK: BLANK1, NUMBER: IN_NUMBERS, OTHER: IN_OTHER, END: CLOSED} | {
        c: IN_LETTERS for c in letters
    }
    joined = fresh | {APOSTROPHE: IN_OTHER}  # after a space, an apostrophe starts no contraction
    table = np.zeros((N_STATES, 12), np.uint8)
    for state in range(N_STATES):
        for c in range(12):
            to, out = fresh[c], HERE
            if state == IN_LETTERS and c in letters:
                out = 0
            elif state == IN_NUMBERS and c == NUMBER:
                out = 0
            elif state == IN_OTHER and c in (OTHER, APOSTROPHE):
                to, out = IN_OTHER, 0
            elif state in (SPACE1, BLANK1, SPACE2, BLANK2):
                if c in (SPACE, BLANK):
                    to, out = (SPACE2 if c == SPACE else BLANK2), 0
                elif c == END:
                    pass
                elif state == SPACE1:
                    to, out = joined[c], 0
                elif state == SPACE2:
                    to, out = joined[c], BEFORE
                elif state == BLANK2:
                    out = HERE | BEFORE
            elif state == QUOTE:
                if c in (OTHER, APOSTROPHE):
                    to, out = IN_OTHER, 0
                elif c == STMD:
                    to, out = CLOSED, 0
                elif c in (R, V, L):
                    to, out = {R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[c], 0
            elif state in (QUOTE_R, QUOTE_V, QUOTE_L):
                if c == (L if state == QUOTE_L else E):
                    to, out = CLOSED, 0
                else:  # no contraction after all: the letter began a word
                    out = BEFORE | (0 if c in letters else HERE)
            table[state, c] = to * 4 + out
    return table.ravel()


class Splitter:
    """Where the words of texts begin, by chunk state maps and a prefix scan."""

    def __init__(self, chunk: int = 128):
        self.chunk, self.table, self.classes = chunk, _splitting_table(), char_classes()
        self.step = (self.table >> 2).astype(np.uint8)

    def starts(self, codes: np.ndarray) -> np.ndarray:
        """Indices of the characters at which a word begins; sentinels count as words of their own."""
        n, width = len(codes), self.chunk
        rows = -(-n // width)
        classes = np.full(rows * width, END, np.uint8)
        classes[:n] = self.classes[codes]
        by_step = np.ascontiguousarray(classes.reshape(rows, width).T)
        # the map of each chunk: exit state for each entry state
        maps = np.broadcast_to(np.arange(N_STATES, dtype=np.uint8), (rows, N_STATES)).copy()
        for k in range(width):
            maps = self.step[maps * np.uint8(N_STATES) + by_step[k][:, None]]
        # inclusive prefix scan under composition, doubling the reach each time
        reach = 1
        while reach < rows:
            later = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
            maps = np.concatenate([maps[:reach], later])
            reach *= 2
        state = np.full(rows, CLOSED, np.uint8)
        state[1:] = maps[:-1, CLOSED]
        out = np.empty((width, rows), np.uint8)
        for k in range(width):
            moved = self.table[state * np.uint8(N_STATES) + by_step[k]]
            out[k] = moved & 3
            state = moved >> 2
        out = out.T.ravel()[:n]
        begins = (out & HERE).astype(bool)
        begins[:-1] |= (out[1:] & BEFORE).astype(bool)
        return np.flatnonzero(begins)


@lru_cache(4)
def byte_bpe(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """(rank of each token's bytes, added special tokens) of a byte-level BPE file.

    Byte-level files write bytes as printable characters: those that are printable in Latin-1 stand for
    themselves, the others get the code points from 256 on, in order.
    """
    spec = json.load(open(path, encoding="utf-8"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    to_byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {
        bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special
    }
    return ranks, special


class Pairs:
    """Whether two tokens may stand next to each other: whether merging their bytes by rank gives them back."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.traces: dict[bytes, list[tuple[int, bytes, bytes]] | None] = {}

    def trace(self, token: bytes) -> list[tuple[int, bytes, bytes]] | None:
        """How a token comes about: before each merge its rank, the first and the last part; None if merging its
        bytes by rank ends elsewhere."""
        if token not in self.traces:
            parts, out = [token[k : k + 1] for k in range(len(token))], []
            while True:
                found = [(r, k) for k in range(len(parts) - 1) if (r := self.ranks.get(parts[k] + parts[k + 1])) is not None]
                if not found:
                    break
                rank, k = min(found)
                out.append((rank, parts[0], parts[-1]))
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            self.traces[token] = out if len(parts) == 1 else None
        return self.traces[token]

    def fit(self, left: bytes, right: bytes) -> bool:
        """Both come about side by side, lowest rank first, and no merge over the border comes before its time."""
        a, b = self.trace(left), self.trace(right)
        if a is None or b is None:
            return False
        i = j = 0
        while True:
            one, two = (a[i][0] if i < len(a) else None), (b[j][0] if j < len(b) else None)
            over = self.ranks.get((a[i][2] if i < len(a) else left) + (b[j][1] if j < len(b) else right))
            # of equal ranks the leftmost is merged first
            if over is not None and (one is None or over < one) and (two is None or over <= two):
                return False
            if one is None and two is None:
                return True
            if two is None or (one is not None and one <= two):
                i += 1
            else:
                j += 1


class CountTransducer:
    """Number of tokens of a word, by a transducer whose transitions carry changes of that number.

    Words of more than ``chunk`` bytes are cut into chunks. Each chunk is turned into a map from entry state to exit
    state and count, over the entry states that may matter: that of a word's beginning, and the one that the chunk
    before leads to from there, as what a state knows seldom reaches back further. The maps are composed by a
    parallel prefix scan. Where the true entry state is neither, the chunk is walked from it.
    """

    def __init__(self, ranks: dict[bytes, int], max_bytes: int = 256 << 20, chunk: int = 64):
        self.ranks, self.max_bytes, self.chunk = ranks, max_bytes, chunk
        self.pairs = Pairs(ranks)
        self.open = {t[:k] for t in ranks for k in range(1, len(t))}
        self.reset()

    def reset(self) -> None:
        self.known: dict[tuple[bytes, bytes], bool] = {}
        self.keys: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.column = np.full(256, -1, np.int32)
        self.n_columns = 0
        #: next state * 64 + change of the count + 32; -1 where not compiled yet
        self.next = np.full((1024, 64), -1, np.int32)
        self._state(((b"", None, 0),))

    def size(self) -> int:
        """About how many bytes the compiled states take: their rows, and 500 for what each one stands for."""
        return self.next.nbytes + 500 * len(self.keys) + 200 * len(self.known)

    def _state(self, key: tuple) -> int:
        found = self.ids.get(key)
        if found is None:
            found = self.ids[key] = len(self.keys)
            self.keys.append(key)
            if found >= len(self.next):
                more = np.full((max(1024, len(self.next) // 4), self.next.shape[1]), -1, np.int32)
                self.next = np.concatenate([self.next, more])
        return found

    def _fits(self, before: bytes | None, token: bytes) -> bool:
        if before is None:
            return self.pairs.trace(token) is not None
        known = self.known.get((before, token))
        if known is None:
            known = self.known[before, token] = self.pairs.fit(before, token)
        return known

    def compile(self, state: int, byte: int) -> int:
        """Fills in one transition and returns its code."""
        if self.column[byte] < 0:
            self.column[byte] = self.n_columns
            self.n_columns += 1
            if self.n_columns > self.next.shape[1]:
                self.next = np.concatenate([self.next, np.full((len(self.next), 64), -1, np.int32)], axis=1)
        alive, last, count = [], None, 0
        for started, before, behind in self.keys[state]:
            piece = started + bytes((byte,))
            if last is None and piece in self.ranks and self._fits(before, piece):
                last, count = piece, behind + 1
            if piece in self.open:
                alive.append((piece, before, behind))
        if not -32 <= count < 32:
            raise OverflowError("a transition changes the number of tokens by more than its code holds")
        key = (*((p, b, c - count) for p, b, c in alive), (b"", last, 0))
        code = self._state(key) * 64 + count + 32
        self.next[state, self.column[byte]] = code
        return code

    def walk(self, data: np.ndarray, begin: np.ndarray, lengths: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(exit state, tokens) of each run of bytes from its entry state; all advance one byte at a time, together."""
        order = np.argsort(-lengths, kind="stable")
        begin, sorted_lengths = begin[order], lengths[order]
        at, total = state[order].astype(np.int64), np.zeros(len(order), np.int64)
        longest = int(sorted_lengths[0]) if len(order) else 0
        live = np.searchsorted(-sorted_lengths, -np.arange(longest), side="left")
        for k in range(longest):
            n = live[k]
            byte = data[begin[:n] + k]
            column = self.column[byte]
            code = np.where(column >= 0, self.next[at[:n], column], -1)
            if (missing := np.flatnonzero(code < 0)).size:
                for key in np.unique(at[missing] * 256 + byte[missing]):
                    self.compile(int(key) >> 8, int(key) & 255)
                code[missing] = self.next[at[missing], self.column[byte[missing]]]
            at[:n] = code >> 6
            total[:n] += (code & 63) - 32
        out, counts = np.empty_like(at), np.empty_like(total)
        out[order], counts[order] = at, total
        return out, counts

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each word data[start:end]."""
        if self.size() > self.max_bytes:
            self.reset()  # what is needed is compiled again
        lengths = ends - starts
        out = np.zeros(len(starts), np.int64)
        short = np.flatnonzero(lengths <= self.chunk)
        out[short] = self.walk(data, starts[short], lengths[short], np.zeros(len(short), np.int64))[1]
        long = np.flatnonzero(lengths > self.chunk)
        # bounded numbers of chunks at a time
        for part in np.split(long, np.flatnonzero(np.diff(np.cumsum(lengths[long]) // (1 << 22))) + 1):
            if len(part):
                out[part] = self._scan(data, starts[part], lengths[part])
        return out

    def _scan(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n = -(-lengths // self.chunk)
        last = np.cumsum(n) - 1
        place = np.arange(n.sum()) - np.repeat(last - n + 1, n)  # of a chunk in its word
        begin = np.repeat(starts, n) + place * self.chunk
        size = np.minimum(self.chunk, np.repeat(starts + lengths, n) - begin)
        entry = np.zeros((len(begin), 2), np.int64)
        leaves, tokens = entry.copy(), entry.copy()
        leaves[:, 0], tokens[:, 0] = self.walk(data, begin, size, entry[:, 0])
        inner = np.flatnonzero(place > 0)
        entry[inner, 1] = leaves[inner - 1, 0]
        leaves[:, 1], tokens[:, 1] = leaves[:, 0], tokens[:, 0]
        leaves[inner, 1], tokens[inner, 1] = self.walk(data, begin[inner], size[inner], entry[inner, 1])
        # each chunk as a map: from its entry states to those of the next one, -1 where it is neither
        to = np.zeros((len(begin), 2), np.int64)
        before_last = np.flatnonzero(np.repeat(n, n) - 1 > place)
        first, second = (leaves[before_last] == entry[before_last + 1, c][:, None] for c in (0, 1))
        to[before_last] = np.where(second, 1, np.where(first, 0, -1))
        sums, reach = tokens.copy(), 1
        while reach <= place.max():  # inclusive prefix scan under composition, within words
            at = np.flatnonzero(place >= reach)
            earlier, so_far = to[at - reach], sums[at - reach]
            on, index = earlier >= 0, earlier.clip(0)
            to_next = np.where(on, np.take_along_axis(to[at], index, 1), -1)
            sums_next = so_far + np.take_along_axis(sums[at], index, 1)
            to[at], sums[at] = to_next, sums_next
            reach *= 2
        out = sums[last, 0]
        for w in np.flatnonzero(to[last, 0] < 0).tolist():  # from where the maps don't reach on, chunk by chunk
            state = total = 0
            for c in range(last[w] - n[w] + 1, last[w] + 1):
                hit = np.flatnonzero(entry[c] == state)
                if hit.size:
                    state, more = leaves[c, hit[0]], tokens[c, hit[0]]
                else:
                    (state,), (more,) = self.walk(data, begin[c : c + 1], size[c : c + 1], np.array([state]))
                total += int(more)
            out[w] = total
        return out


def _safe_cuts(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` characters that split as the whole does: a cut lies before white space that
    follows something else. A text without such a place stays whole."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) and not (text[cut] in " \n\t" and not text[cut - 1].isspace()):
            cut += 1
        yield text[at:cut]
        at = cut
    if at < len(text):
        yield text[at:]


class WordCutter:
    """Words of many texts at once: UTF-8 bytes, word starts and ends in them, and each word's part number."""

    def __init__(self, special: dict[str, int]):
        self.splitter, self.special = Splitter(), special

    def parts(self, text: str) -> list[str | int]:
        """The text between special tokens, and the special tokens' ids, in order."""
        out: list[str | int] = [text]
        for token, i in self.special.items():
            for k in range(len(out) - 1, -1, -1):
                if isinstance(out[k], str) and token in out[k]:
                    between = out[k].split(token)
                    out[k : k + 1] = [x for part in between for x in (part, i)][:-1]
        return [x for x in out if x != ""]

    def words(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, starts, ends, part of each word), for parts without special tokens."""
        codes = np.frombuffer(" ".join([*parts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        data = np.frombuffer(" ".join([*parts, ""]).encode("utf-8", "surrogatepass"), np.uint8)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        codes[ends] = SENTINEL
        begin = self.splitter.starts(codes)
        width = np.ones(len(codes), np.int64)
        width += (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        width[ends] = 1
        offset = np.concatenate([[0], np.cumsum(width)])
        part = np.searchsorted(ends, begin, side="left")
        stop = np.append(begin[1:], len(codes))
        real = codes[begin] != SENTINEL
        return data, offset[begin[real]], offset[stop[real]], part[real]


@lru_cache(2)
def _compiled(path: str) -> tuple[WordCutter, CountTransducer]:
    """One compiled pair for each worker process; it stays for the tasks to come."""
    ranks, special = byte_bpe(path)
    return WordCutter(special), CountTransducer(ranks)


def count_tokens(texts: list[str | None], path: str, batch_chars: int = 1_000_000) -> np.ndarray:
    """Tokens of each text (null: 0)."""
    cutter, transducer = _compiled(path)
    total = np.zeros(len(texts), np.int64)
    parts: list[str] = []
    rows: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal parts, rows, size
        if parts:
            data, starts, ends, part = cutter.words(parts)
            counts = transducer.counts(data, starts, ends)
            np.add.at(total, np.asarray(rows), np.bincount(part, counts, len(parts)).astype(np.int64))
        parts, rows, size = [], [], 0

    for i, text in enumerate(texts):
        for x in cutter.parts(text or ""):
            if isinstance(x, int):
                total[i] += 1
                continue
            for piece in _safe_cuts(x, batch_chars):
                parts.append(piece)
                rows.append(i)
                size += len(piece)
                if size >= batch_chars:
                    flush()
    flush()
    return total


def token_counts(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    tokenizer: str = "byte_bpe_50k.json", limit: int = 512,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row's whole text.

    A null text counts as empty: no bytes, no tokens. Special tokens inside a text count as one token each,
    none is added. Rows map to rows one by one (repeated rows and null ids stay), other columns are not
    read, and an empty table gives an empty result. No shuffle; a worker holds one batch and the compiled
    transducer, whose size is bounded.
    """
    path = public_tokenizers.path(tokenizer)

    def count(texts: list[str | None]) -> tuple[None, list]:
        n = np.asarray(count_tokens(texts, path), np.int64)
        n_bytes = [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
        return None, [np.asarray(n_bytes, np.int64), n, n > limit]

    rows = documents.select(documents[id_column].alias("__id"), documents[text_column].alias("__text"))
    return map_texts(rows, "n_bytes long, n_tokens long, over_limit boolean", count, "__text").withColumnRenamed("__id", id_column)
