import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from visitmart.llm.packing import best_fit_decreasing, pack, position_ids, tokens
from visitmart.llm.token_counts import CountTransducer, byte_bpe, count_tokens, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("'strvelmdaA é9٣!?.\n\t 中\x00😀<|>endoftx"), max_size=60), min_size=1, max_size=4))
def test_counts_are_the_librarys(texts):
    assert count_tokens(texts, PATH).tolist() == library(texts)


def test_special_strings_runs_and_cuts():
    texts = ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "  \n\n a", "x" * 3000, " " * 999, "it's they'll 'll'r 'v", "words and more " * 3000, None]
    assert count_tokens(texts, PATH, batch_chars=1000).tolist() == library(texts)


def test_long_words_through_composed_chunks():
    rng = random.Random(9)
    texts = ["x" * n for n in (63, 64, 65, 127, 128, 129, 1000, 4097)] + ["ab" * 700, "abc" * 501, "=-" * 400 + "=", "!" * 777, "0" * 300, "é" * 400, "中文" * 300, "\u0301" * 200]
    texts += ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(60, 900))) for _ in range(60)]
    texts += ["".join(rng.choice(["aaa", "the", "ing", "qqqq", "tion", "x"]) for _ in range(rng.randrange(20, 400))) for _ in range(60)]
    want = library(texts)
    assert count_tokens(texts, PATH).tolist() == want
    ranks, _ = byte_bpe(PATH)
    for chunk in (1, 3, 16):
        small = CountTransducer(ranks, chunk=chunk)
        data = np.frombuffer("".join(texts[:40]).encode(), np.uint8)
        ends = np.cumsum([len(t.encode()) for t in texts[:40]])
        starts = np.concatenate([[0], ends[:-1]])
        assert small.counts(data, starts, ends).tolist() == CountTransducer(ranks, chunk=10**6).counts(data, starts, ends).tolist()


def test_states_are_bounded_in_bytes():
    ranks, _ = byte_bpe(PATH)
    t = CountTransducer(ranks, max_bytes=3 << 20)
    words = [w for w in ("".join(random.Random(i).choices("etaoinshrdlu", k=9)) for i in range(6000))]
    for at in range(0, len(words), 500):
        data = np.frombuffer("".join(words[at : at + 500]).encode(), np.uint8)
        ends = np.arange(1, 501) * 9
        got = t.counts(data, ends - 9, ends)
        assert got.tolist() == library(words[at : at + 500])
    assert t.size() < 20 << 20


def test_every_character_class():
    rng = random.Random(1)
    chars = [chr(c) for c in rng.sample([c for c in range(0x20000) if not 0xD800 <= c < 0xE000], 6000)]
    texts = [f"a{c}1{c} {c}{c}a" for c in chars]
    assert count_tokens(texts, PATH).tolist() == library(texts)


def test_query_on_odd_rows(odd, nothing):
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(odd).collect())
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = sorted((str(i), len((t or "").encode()), n, n > 512) for (i, t), n in zip(texts, library([t for _, t in texts]), strict=True))
    assert got == want
    assert token_counts(nothing).count() == 0


def plain_best_fit(lengths, capacity):
    rooms, rows = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [r for r in range(len(rooms)) if rooms[r] >= lengths[i]]
        if not fits:
            rooms.append(capacity)
            rows.append([])
            fits = [len(rooms) - 1]
        best = min(fits, key=lambda r: rooms[r])
        rooms[best] -= lengths[i]
        rows[best].append(i)
    return sorted(capacity - r for r in rooms)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 70).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=60))))
def test_tree_finds_the_best_fit(case):
    capacity, lengths = case
    rows = best_fit_decreasing(lengths, capacity)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    assert sorted(sum(lengths[i] for i in r) for r in rows) == plain_best_fit(lengths, capacity)


def test_packing_loses_nothing(spark, data, odd, nothing):
    docs = odd.where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text").unionByName(spark.read.parquet(f"{data}/documents.parquet").selectExpr("doc_id + 1000 as doc_id", "text"))
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    back = defaultdict(dict)
    for r in pack(docs, capacity=256, buffer_tokens=20_000).collect():
        ids = np.frombuffer(r["input_ids"], "<u2")
        assert len(ids) == 256 and r["cu_seqlens"][-1] == r["n_tokens"] and r["position_resets"] == r["cu_seqlens"][:-1]
        assert (ids[r["n_tokens"] :] == 50256).all()
        assert (position_ids(r["cu_seqlens"])[r["position_resets"]] == 0).all()
        for s, a, b in zip(r["segments"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False):
            assert s["length"] == b - a
            back[s["doc_id"]][s["first_token"]] = ids[a:b]
    want = {r["doc_id"]: [*tokens(r["text"], path), 50256] for r in docs.collect() if r["text"]}
    assert {k: [int(x) for at in sorted(v) for x in v[at]] for k, v in back.items()} == want
    assert pack(nothing).count() == 0 and pack(odd).count() > 0
