"""Quality score by a byte-level convolutional network in numpy.

Learned filters of ``WIDTH`` bytes move over the whole document in steps of ``STRIDE``, so that chunks
overlap; a filter's largest response anywhere in the document is its feature, and a linear layer turns the
features into one probability. As bytes are symbols, a filter is a table of a weight for each byte at each
place: a response is a sum of table look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from visitmart.llm.common import filter_rows, held_out, labelled_sample, map_texts, pieces

WIDTH, STRIDE, FILTERS = 8, 4, 16


@dataclass
class QualityModel:
    filters: np.ndarray  # WIDTH, 256, FILTERS
    offset: np.ndarray  # FILTERS
    out: np.ndarray  # FILTERS
    bias: float

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter responses by chunk; data has WIDTH - STRIDE + STRIDE * chunks bytes."""
        n = (len(data) - WIDTH) // STRIDE + 1
        total = np.broadcast_to(self.offset, (n, FILTERS)).astype(np.float32)
        for k in range(WIDTH):
            total += self.filters[k][data[k : k + STRIDE * (n - 1) + 1 : STRIDE]]
        return total

    def pooled(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(largest response of each filter in each text, padded bytes, first chunk of each text, responses)."""
        data, first = layout(texts)
        r = self.responses(data)
        r[first[1:] - 1] = -np.inf  # reaches into the next text
        return np.maximum.reduceat(r, first, axis=0), data, first, r

    def scores(self, texts: list[str], size: int = 500_000) -> np.ndarray:
        z = np.zeros(len(texts))
        for a, b in pieces(texts, size):
            if b == a + 1:  # one text, maybe a very long one: the largest response over its parts
                raw = texts[a].encode("utf-8", "replace")
                step = size // STRIDE * STRIDE
                peak = np.full(FILTERS, -np.inf, np.float32)
                for at in range(0, max(1, len(raw)), step):
                    if at + step < len(raw):  # chunks that begin in this part, with what follows it in the text
                        part = raw[at : at + step + WIDTH - STRIDE].ljust(step + WIDTH - STRIDE, b"\0")
                        peak = np.maximum(peak, self.responses(np.frombuffer(part, np.uint8)).max(0))
                    else:
                        peak = np.maximum(peak, self.pooled([raw[at:]])[0][0])
                peaks = peak[None]
            else:
                peaks = self.pooled([t.encode("utf-8", "replace") for t in texts[a:b]])[0]
            z[a:b] = np.maximum(peaks, 0) @ self.out + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each padded by zeros so that a chunk begins at each step within it and no
    chunk that counts for one text touches the next; and the first chunk of each text."""
    parts, first, at = [], [], 0
    for t in texts:
        first.append(at // STRIDE)
        n = -(-max(len(t), 1) // STRIDE) * STRIDE + WIDTH
        parts.append(t + b"\0" * (n - len(t)))
        at += n
    return np.frombuffer(b"".join(parts) + b"\0" * WIDTH, np.uint8), np.asarray(first)


def train(sample: list[tuple[str, str]], epochs: int = 10, batch: int = 32, rate: float = 0.02, positive_share: float | None = None, seed: int = 3) -> QualityModel | None:
    """Adam on the logistic loss; the gradient of a largest response flows to the chunk that gave it."""
    y = np.array([1.0 if c in ("1", "true") else 0.0 for c, _ in sample])
    if not len(y) or y.min() == y.max():
        return None
    texts = [t.encode("utf-8", "replace") for _, t in sample]
    rng = np.random.default_rng(seed)
    m = QualityModel((rng.standard_normal((WIDTH, 256, FILTERS)) * 0.15).astype(np.float32), np.zeros(FILTERS, np.float32), (rng.standard_normal(FILTERS) * 0.3).astype(np.float32), 0.0)
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in (("filters", m.filters), ("offset", m.offset), ("out", m.out))}
    t = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            take = order[at : at + batch]
            peak, data, first, r = m.pooled([texts[i] for i in take])
            act = np.maximum(peak, 0)
            p = 1 / (1 + np.exp(-np.clip(act @ m.out + m.bias, -40, 40)))
            miss = ((p - y[take]) / len(take)).astype(np.float32)
            back = miss[:, None] * m.out * (peak > 0)
            grad_filters = np.zeros_like(m.filters)
            last = [*first[1:], len(r)]
            for i, (a, b) in enumerate(zip(first, last, strict=True)):
                best = a + r[a:b].argmax(0)
                for k in range(WIDTH):
                    np.add.at(grad_filters[k], (data[best * STRIDE + k], np.arange(FILTERS)), back[i])
            grads = {"filters": grad_filters + 1e-5 * m.filters, "offset": back.sum(0), "out": miss @ act + 1e-4 * m.out}
            t += 1
            lr = rate * (1 - 0.9 * epoch / epochs) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
            for name, grad in grads.items():
                one, two = state[name]
                one += 0.1 * (grad - one)
                two += 0.001 * (grad * grad - two)
                setattr(m, name, (getattr(m, name) - lr * one / (np.sqrt(two) + 1e-8)).astype(np.float32))
            m.bias -= rate * float(miss.sum())
    if positive_share:
        m.bias += float(np.log(positive_share / (1 - positive_share)) - np.log(y.mean() / (1 - y.mean())))
    return m


def quality(
    documents: DataFrame, labels: DataFrame, model: QualityModel | None = None, label: str = "quality",
    per_class: int = 1500, sample_bytes: int = 10_000_000, threshold: float = 0.3,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row's whole text; a high score means label 1.

    Unless a model is given, one is learnt from labelled rows, bounded by ``per_class`` and ``sample_bytes``;
    rows with crc32(doc_id as text) mod 5 = 0, null texts and null labels never enter it. A null text scores
    as an empty one; where labels have no two classes every score is 1, so that nothing is rejected.
    Repeated rows and null ids stay, one result each; columns other than doc_id and text are not read; an
    empty table gives an empty result. No shuffle of texts.
    """
    if model is None:
        model = train(labelled_sample(documents, labels, label, per_class, sample_bytes))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def predict(texts: list[str | None]) -> tuple[None, list]:
        score = shared.value.scores([t or "" for t in texts]) if shared.value is not None else np.ones(len(texts))
        return None, [np.asarray(score, np.float64), (score >= threshold).astype(np.int32)]

    return map_texts(documents.select("doc_id", held_out().alias("held_out"), "text"), "score double, predicted int", predict)


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, **sample: int) -> DataFrame:
    """The rows of ``documents`` that the classifier doesn't reject, with all their columns.

    The decision is made where the row lies (no join by id, so null and repeated ids are safe).
    """
    model = train(labelled_sample(documents, labels, "quality", sample.get("per_class", 1500), sample.get("sample_bytes", 10_000_000)))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def keep(texts: list[str | None]) -> np.ndarray:
        if shared.value is None:
            return np.ones(len(texts), bool)
        return shared.value.scores([t or "" for t in texts]) >= threshold

    return filter_rows(documents, keep)
