"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from visitmart.llm.common import held_out, labelled_sample, map_texts, pieces
from visitmart.llm.ngrams import code_parts, distinct_by_text, hashed, word_codes

SIZES, BITS = (3, 4, 5, 6), 20


@dataclass
class ToxicityModel:
    #: by bucket: log-count ratio times learnt weight; 0 for n-grams that too few sample texts hold
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str], chars: int = 500_000) -> np.ndarray:
        """Probability of the label, from the n-grams present anywhere in the whole text."""
        z = np.full(len(texts), self.bias)
        for a, b in pieces(texts, chars):
            buckets, owners = self._weighty(texts[a:b], chars)
            bucket, owner, _ = distinct_by_text(buckets, owners, BITS)
            z[a:b] += np.bincount(owner, self.weights[bucket], b - a)[: b - a]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def _weighty(self, texts: list[str], chars: int) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams with a weight; a long text is read in parts, whose n-grams are those of the whole."""
        if len(texts) > 1 or len(texts[0]) <= 2 * chars:
            buckets, owners = hashed(*word_codes(texts), SIZES, BITS)
            keep = self.weights[buckets] != 0
            return buckets[keep], owners[keep]
        found = [np.zeros(0, np.int32)]
        for codes in code_parts(texts[0], chars, max(SIZES)):
            buckets, _ = hashed(codes, np.array([len(codes)]), SIZES, BITS, chars)
            found.append(np.unique(buckets[self.weights[buckets] != 0]))
        buckets = np.unique(np.concatenate(found))
        return buckets, np.zeros(len(buckets), np.int64)


def train(sample: list[tuple[str, str]], min_texts: int = 5, epochs: int = 12, rate: float = 0.05, penalty: float = 2e-3, positive_share: float | None = None, seed: int = 5) -> ToxicityModel | None:
    """Logistic regression by minibatch gradients on presence times log-count ratio."""
    y = np.array([1.0 if c in ("1", "true") else 0.0 for c, _ in sample])
    if not len(y) or y.min() == y.max():
        return None
    rows = [distinct_by_text(*hashed(*word_codes([t]), SIZES, BITS), BITS)[0] for _, t in sample]
    hold, hold_pos = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS, np.int32)
    for label, r in zip(y, rows, strict=True):
        hold[r] += 1
        if label:
            hold_pos[r] += 1
    used = np.flatnonzero(hold >= min_texts)
    p, q = 1.0 + hold_pos[used], 1.0 + hold[used] - hold_pos[used]
    ratio = np.log((p / (1 + y.sum())) / (q / (1 + len(y) - y.sum())))
    # ratios that chance explains carry nothing but noise, and long texts hold very many of them
    ratio[np.abs(ratio) < 2.0 * np.sqrt(1 / p + 1 / q)] = 0
    used, ratio = used[ratio != 0], ratio[ratio != 0]
    if not len(used):
        return ToxicityModel(np.zeros(1 << BITS, np.float32), float(np.log(y.sum() / (len(y) - y.sum()))))
    column = np.full(1 << BITS, -1, np.int64)
    column[used] = np.arange(len(used))
    rows = [c[c >= 0] for c in (column[r] for r in rows)]
    rng = np.random.default_rng(seed)
    w, bias, seen = np.zeros(len(used)), 0.0, np.full(len(used), 1e-8)
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 64):
            take = order[at : at + 64]
            flat = np.concatenate([rows[i] for i in take])
            owner = np.repeat(np.arange(len(take)), [len(rows[i]) for i in take])
            z = np.bincount(owner, w[flat] * ratio[flat], len(take)) + bias
            miss = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[take]
            grad = np.bincount(flat, miss[owner] * ratio[flat], len(w)) / len(take) + penalty * w
            seen += grad * grad
            w -= rate * grad / np.sqrt(seen)
            bias -= rate * 2 * miss.mean()
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = ratio * w
    if positive_share:  # the sample is balanced by class, the corpus is not
        bias += np.log(positive_share / (1 - positive_share)) - np.log(y.sum() / (len(y) - y.sum()))
    return ToxicityModel(weights, float(bias))


def toxicity(
    documents: DataFrame, labels: DataFrame, model: ToxicityModel | None = None, label: str = "toxic",
    per_class: int = 2500, sample_bytes: int = 16_000_000, threshold: float = 0.5,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row's whole text.

    Unless a model is given, one is learnt from labelled rows, bounded by ``per_class`` and ``sample_bytes``;
    rows with crc32(doc_id as text) mod 5 = 0, null texts and null labels never enter it. A null text scores
    as an empty one, by the bias alone; where labels have no two classes every score is 0. Repeated rows and
    null ids stay, one result each; columns other than doc_id and text are not read; an empty table gives an
    empty result. No shuffle of texts.
    """
    if model is None:
        model = train(labelled_sample(documents, labels, label, per_class, sample_bytes))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def predict(texts: list[str | None]) -> tuple[None, list]:
        score = shared.value.scores([t or "" for t in texts]) if shared.value is not None else np.zeros(len(texts))
        return None, [np.asarray(score, np.float64), (score >= threshold).astype(np.int32)]

    return map_texts(documents.select("doc_id", held_out().alias("held_out"), "text"), "score double, predicted int", predict)
