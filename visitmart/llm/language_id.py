"""Language identification by averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from visitmart.llm.common import held_out, map_texts, pieces, text_sample
from visitmart.llm.ngrams import code_parts, distinct_by_text, hashed, true_letters, word_codes

UNKNOWN = "und"
SIZES, BITS = (2, 3, 4), 17


@dataclass
class LanguageModel:
    languages: list[str]
    #: what each subword adds to each language's logit: embedding times output weights, folded after training.
    #: With more languages than embedding dimensions it is the embedding, whose size doesn't grow with them
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    #: predictions below this probability are too unsure: accepted ones err in at most the wanted share
    reject_below: float
    #: output weights, where scores are embeddings
    weights: np.ndarray | None = None

    def probabilities(self, texts: list[str], chars: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
        """(probability of each language, whether the text has a letter)."""
        out = np.zeros((len(texts), len(self.languages)))
        known = np.zeros(len(texts), bool)
        for a, b in pieces(texts, chars):
            total, number = np.zeros((b - a, self.scores.shape[1])), np.zeros(b - a)
            for codes, ends, starts in _parts(texts[a:b], chars):
                seen = true_letters()[codes]
                first = np.concatenate([[0], ends[:-1]])
                known[a:b] |= np.add.reduceat(seen, first) > 0 if len(ends) > 1 else seen.any()
                for n in SIZES:
                    buckets, texts_of = hashed(codes, ends, (n,), BITS, starts)
                    if not len(buckets):
                        continue
                    first = np.flatnonzero(np.diff(texts_of, prepend=-1))
                    rows = texts_of[first]
                    total[rows] += np.add.reduceat(self.scores[buckets], first, axis=0, dtype=np.float64)
                    number[rows] += np.diff(first, append=len(buckets))
            mean = total / np.maximum(number, 1)[:, None]
            logits = ((mean if self.weights is None else mean @ self.weights) + self.bias) / self.temperature
            e = np.exp(logits - logits.max(1, keepdims=True))
            out[a:b] = e / e.sum(1, keepdims=True)
        return out, known


def _parts(texts: list[str], chars: int) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
    """(codes, end of each text in them, how many n-grams may begin in them): texts as they are, a single long one in
    parts whose n-grams together are those of the whole."""
    if len(texts) > 1 or len(texts[0]) <= 2 * chars:
        yield *word_codes(texts), None
        return
    for codes in code_parts(texts[0], chars, max(SIZES)):
        yield codes, np.array([len(codes)]), chars


def train(sample: list[tuple[str, str]], dim: int = 16, epochs: int = 5, rate: float = 0.5, max_error: float = 0.01, seed: int = 11) -> LanguageModel | None:
    """Stochastic gradient descent over documents; a tenth of the sample calibrates temperature and rejection."""
    languages = sorted({c for c, _ in sample})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    features = []
    for label, text in sample:
        bucket, _, count = distinct_by_text(*hashed(*word_codes([text]), SIZES, BITS), BITS)
        if len(bucket):
            features.append((languages.index(label), bucket, (count / count.sum()).astype(np.float32)))
    order = rng.permutation(len(features))
    cut = len(features) // 10
    apart, learn = [features[i] for i in order[:cut]], [features[i] for i in order[cut:]]
    embed = (rng.standard_normal((1 << BITS, dim)) / dim).astype(np.float32)
    weights, bias = np.zeros((dim, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps, done = max(1, epochs * len(learn)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(learn)):
            label, bucket, share = learn[i]
            lr = rate * (1 - done / steps)
            done += 1
            rows = embed[bucket]
            mean = share @ rows
            logits = mean @ weights + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = weights @ p
            weights -= lr * np.outer(mean, p)
            bias -= lr * p * 0.1
            # the gradient of a mean is small for each member; a common factor keeps steps useful
            embed[bucket] = rows - (lr * 8) * share[:, None] * back
    scores = embed @ weights if len(languages) <= dim else None
    temperature, reject = 1.0, 0.0
    if apart:
        logits = np.array([share @ embed[bucket] @ weights + bias for _, bucket, share in apart])
        truth = np.array([label for label, _, _ in apart])

        def loss(t: float) -> float:
            z = logits / t
            z = z - z.max(1, keepdims=True)
            return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), truth]).mean())

        temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
        z = logits / temperature
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best, right = p.max(1), p.argmax(1) == truth
        by = np.argsort(-best)
        wrong = np.cumsum(~right[by]) / np.arange(1, len(by) + 1)
        fine = np.flatnonzero(wrong <= max_error)
        reject = float(best[by][fine[-1]]) if len(fine) else 1.0
    if len(languages) > dim:
        return LanguageModel(languages, embed, bias.astype(np.float64), temperature, reject, weights.astype(np.float64))
    return LanguageModel(languages, scores.astype(np.float32), bias.astype(np.float64), temperature, reject)


def language_id(
    documents: DataFrame, model: LanguageModel | None = None, per_language: int = 1000, sample_bytes: int = 6_000_000,
    reject: bool = False,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, confident) of each row's whole text.

    Unless a model is given, one is learnt from a sample bounded by ``per_language`` rows and
    ``sample_bytes``; rows with crc32(doc_id as text) mod 5 = 0, null texts and null labels never enter it.
    ``lang_pred`` is "und", with score 0, where the text is null or has no letter, or nothing could be learnt;
    ``confident`` tells whether the score reaches the calibrated rejection bound, and with ``reject`` the
    predictions below it are "und" too. Repeated rows and null ids stay, one result each; columns other
    than doc_id, text and lang are not read; an empty table gives an empty result. No shuffle.
    """
    if model is None:
        model = train(text_sample(documents, "lang", per_language, sample_bytes))
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)  # a fixed number of rows for each language

    def predict(texts: list[str | None]) -> tuple[None, list]:
        m, n = shared.value, len(texts)
        lang, score, sure = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n, bool)
        if m is not None and n:
            p, known = m.probabilities([t or "" for t in texts])
            best = p.argmax(1)
            lang[known] = np.array(m.languages, object)[best[known]]
            score[known] = p[np.arange(n), best][known]
            sure = known & (score >= m.reject_below)
            if reject:
                lang[~sure] = UNKNOWN
        return None, [pa.array(lang.tolist(), pa.string()), score, sure]

    return map_texts(documents.select("doc_id", held_out().alias("held_out"), "text"), "lang_pred string, score double, confident boolean", predict)
