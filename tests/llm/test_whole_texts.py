import zlib

import numpy as np
import pytest
import regex

from visitmart.llm import language_id, toxicity
from visitmart.llm.common import labelled_sample, text_sample
from visitmart.llm.ngrams import MIX, letters
from visitmart.llm.quality import FILTERS, STRIDE, WIDTH, QualityModel


def test_score_depends_on_neither_parts_nor_neighbours():
    rng = np.random.default_rng(1)
    m = QualityModel(rng.standard_normal((WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), (0.02 * rng.standard_normal(FILTERS)).astype(np.float32), 0.0)
    m.filters[4:, 0] += 3  # chunks that end in zeros weigh most
    for size in (0, 1, 3, 4, 7, 8, 9, 16, 17, 20, 31, 32, 33, 100):
        text = "".join(chr(c) for c in rng.integers(97, 123, size))
        whole = m.scores([text])[0]
        assert np.isclose(m.scores([text], 16)[0], whole) and np.isclose(m.scores([text], 4)[0], whole)
        for other in ("zzzz", "é", "abc" * 5):
            assert np.isclose(m.scores([text, other])[0], whole)


def plain_grams(text, sizes, bits):
    """Bucket of each n-gram, one text at a time, one character at a time."""
    chars = [c if letters()[ord(c)] else " " for c in f" {text.lower()} "]
    out = []
    for n in sizes:
        for at in range(len(chars) - n + 1):
            gram = chars[at : at + n]
            if " " in gram[1:-1] or gram[0] == gram[-1] == " ":
                continue
            h = (n * int(MIX)) % 2**64
            for c in gram:
                h = (h ^ ord(c)) * int(MIX) % 2**64
                h ^= h >> 29
            out.append(h >> (64 - bits))
    return out


ODD = [
    "", " ", "a", "ab", "Ab c", "one two  three", "x" * 300, "ΣΑΣ ΟΔΟΣ İstanbul", "é!è?ç", "中文字 text ЖЖ", "ा", "12 3", "no_break" * 40,
    "many words in a row, with commas; and more " * 30, "áb 😀 c".encode("utf-16", "surrogatepass").decode("utf-16"),
]


def test_toxicity_score_is_the_plain_one():
    rng = np.random.default_rng(2)
    weights = (rng.standard_normal(1 << toxicity.BITS) * (rng.random(1 << toxicity.BITS) < 0.7) * 0.05).astype(np.float32)
    m = toxicity.ToxicityModel(weights, -0.3)
    want = [1 / (1 + np.exp(0.3 - sum(float(weights[b]) for b in set(plain_grams(t, toxicity.SIZES, toxicity.BITS))))) for t in ODD]
    for chars in (500_000, 37, 7):
        assert np.allclose(m.scores(ODD, chars), want)


def test_language_probabilities_are_the_plain_ones():
    rng = np.random.default_rng(3)
    table = rng.standard_normal((1 << language_id.BITS, 3)).astype(np.float32)
    bias = rng.standard_normal(3)
    m = language_id.LanguageModel(["x", "y", "z"], table, bias, 0.7, 0.0)
    want = []
    for t in ODD:
        rows = plain_grams(t, language_id.SIZES, language_id.BITS)
        z = ((table[rows].astype(np.float64).mean(0) if rows else 0) + bias) / 0.7
        want.append(np.exp(z - z.max()) / np.exp(z - z.max()).sum())
    for chars in (1_000_000, 37, 7):
        got, known = m.probabilities(ODD, chars)
        assert np.allclose(got, want)
        assert known.tolist() == [any(regex.match(r"\p{L}", c) for c in t) for t in ODD]


def test_quality_score_is_the_plain_one():
    rng = np.random.default_rng(4)
    m = QualityModel(rng.standard_normal((WIDTH, 256, FILTERS)).astype(np.float32), rng.standard_normal(FILTERS).astype(np.float32), rng.standard_normal(FILTERS).astype(np.float32), 0.2)
    want = []
    for t in ODD:
        raw = t.encode("utf-8", "replace")
        peaks = np.full(FILTERS, -np.inf)
        for at in range(0, max(1, len(raw)) + STRIDE, STRIDE):  # a text is read with zeros after it
            chunk = raw[at : at + WIDTH].ljust(WIDTH, b"\0")
            peaks = np.maximum(peaks, m.offset + sum(m.filters[k, chunk[k]].astype(np.float64) for k in range(WIDTH)))
        want.append(1 / (1 + np.exp(-(np.maximum(peaks, 0) @ m.out + m.bias))))
    for size in (500_000, 64):
        assert np.allclose(m.scores(ODD, size), want, atol=1e-5)


def test_very_long_texts_score_as_unsplit_ones():
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in rng.integers(1, 9, 3000)]
    texts = [" ".join(rng.choice(words, 600_000)), "".join(rng.choice(words, 300_000))]
    assert len(texts[0]) > 3_000_000 and " " not in texts[1]
    weights = (rng.standard_normal(1 << toxicity.BITS) * (rng.random(1 << toxicity.BITS) < 0.001) * 0.01).astype(np.float32)
    t = toxicity.ToxicityModel(weights, 0.0)
    assert np.allclose(t.scores(texts), t.scores(texts, 10**8), rtol=1e-12)
    m = language_id.LanguageModel(["x", "y"], rng.standard_normal((1 << language_id.BITS, 2)).astype(np.float32), np.zeros(2), 1.0, 0.0)
    assert np.allclose(m.probabilities(texts)[0], m.probabilities(texts, 10**8)[0], rtol=1e-9)
    q = QualityModel(rng.standard_normal((WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), (0.02 * rng.standard_normal(FILTERS)).astype(np.float32), 0.0)
    assert np.allclose(q.scores(texts), q.scores(texts, 10**8))


def test_sample_holds_whole_texts_of_every_class(spark):
    rows = [(f"d{i}", "word " * (1 + i % 50) + "end", "abc"[i % 3]) for i in range(600)] + [("long", "x" * 50_000, "a"), (None, "none", "a"), ("n", None, "b")]
    rows += [rows[1]] * 20
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    labels = spark.createDataFrame([(i, "abc".index(c)) for i, _, c in rows] + [("d4", 0), ("d4", 2), ("zz", 1)], "doc_id string, toxic int")
    known = {(i, t) for i, t, _ in rows if i and t and zlib.crc32(i.encode()) % 5}
    for sample, names in ((text_sample(docs, "lang", 40, 30_000), "abc"), (labelled_sample(docs, labels, "toxic", 40, 30_000), "012")):
        assert {c for c, _ in sample} == set(names) and all(t in {t for _, t in known} for _, t in sample)
        for c in names:
            own = [t for k, t in sample if k == c]
            assert 20 < len(own) <= 40 and sum(map(len, own)) <= 10_000
    assert text_sample(docs, "lang", 40, 30_000) == text_sample(docs.repartition(5), "lang", 40, 30_000)
    with pytest.raises(ValueError):
        text_sample(docs, "lang", 40, 30_000, max_classes=2)
    got = language_id.language_id(docs, per_language=20).collect()
    assert len(got) == len(rows)
