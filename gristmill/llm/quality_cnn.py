"""Document quality by a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into overlapping chunks (1024 bytes, every 512) that cover all of it.
Learned filters of eight bytes slide over each chunk in steps of four; their responses are max-pooled in
the chunk, a small dense layer turns them into chunk features, and the largest and the mean of those
over the document give one probability.

The network is fitted on the driver, on a bounded, documented sample of labelled documents
(`PER_CLASS` of each class, by a hash of the id). Scoring reads every whole text. Null text counts as
empty, an empty text gets the score of an all-padding chunk, repeated rows get equal scores, an empty
table gives an empty result, and without labels of both classes every score is the share of label 1
(0.5 without any). A null doc_id is scored and counts as not held out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import is_held_out, labelled_sample, map_texts, remainder

PER_CLASS = 1500
EPOCHS = 8
DIM, FILTERS, HIDDEN = 6, 24, 16
STRIDE, HALF = 4, 128  #: bytes a step, steps in half a chunk
ROW = STRIDE * (HALF + 1)  #: half a chunk and the step after it, which the last window reads
PIECE = 512  #: rows that are convolved at once


def rows_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half-chunks of all texts as byte rows, the number of valid steps of each, and the rows of each text."""
    parts, steps, counts = [], [], []
    for t in texts:
        raw = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
        n = max(1, -(-len(raw) // (STRIDE * HALF)))
        padded = np.zeros(n * STRIDE * HALF + STRIDE, np.uint8)
        padded[: len(raw)] = raw
        parts.append(np.lib.stride_tricks.as_strided(padded, (n, ROW), (STRIDE * HALF, 1)).copy())
        valid = np.full(n, HALF)
        valid[-1] = -(-len(raw) // STRIDE) - (n - 1) * HALF
        steps.append(valid)
        counts.append(n)
    return np.concatenate(parts), np.concatenate(steps), np.array(counts)


class ByteCNN:
    def __init__(self, seed: int = 7):
        g = np.random.default_rng(seed)
        self.p = {
            "emb": g.normal(0, 0.5, (256, DIM)),
            "w1": g.normal(0, 0.25, (STRIDE * DIM, 2 * FILTERS)),
            "b1": np.zeros(FILTERS),
            "w2": g.normal(0, 0.3, (FILTERS, HIDDEN)),
            "b2": np.full(HIDDEN, 0.1),
            "w3": g.normal(0, 0.3, 2 * HIDDEN),
            "b3": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.shift = 0.0  #: log-odds by which the sample's class shares differ from the table's
        self.constant: float | None = None

    def _pool(self, rows: np.ndarray, steps: np.ndarray, where: bool):
        """Largest response of each filter in each half-chunk, at least 0, and the step that gave it."""
        p = self.p
        out = np.empty((len(rows), FILTERS), np.float32)
        best = np.empty((len(rows), FILTERS), np.int32) if where else None
        for a in range(0, len(rows), PIECE):
            x = p["emb"][rows[a : a + PIECE]].reshape(-1, STRIDE * DIM)
            y = (x @ p["w1"]).reshape(-1, HALF + 1, 2 * FILTERS)
            conv = y[:, :HALF, :FILTERS] + y[:, 1:, FILTERS:]
            short = np.flatnonzero(steps[a : a + PIECE] < HALF)
            for i in short.tolist():
                conv[i, steps[a + i] :] = -1e9
            if where:
                best[a : a + PIECE] = conv.argmax(1)
            out[a : a + PIECE] = conv.max(1)
        return np.maximum(out + p["b1"], 0), best

    @staticmethod
    def _chunks(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row of each chunk and first chunk of each document; a chunk is a row and the next, or a lone row."""
        n = np.maximum(counts - 1, 1)
        firsts = np.concatenate([[0], np.cumsum(n)[:-1]])
        row0 = np.concatenate([[0], np.cumsum(counts)[:-1]])
        return np.arange(n.sum()) - np.repeat(firsts, n) + np.repeat(row0, n), firsts

    def logits(self, texts: list[str], keep: bool = False):
        p = self.p
        rows, steps, counts = rows_of(texts)
        a, best = self._pool(rows, steps, keep)
        at, firsts = self._chunks(counts)
        lone = np.repeat(counts == 1, np.maximum(counts - 1, 1))
        nxt = np.where(lone, at, np.minimum(at + 1, len(a) - 1))
        take = a[nxt] > a[at]
        c = np.where(take, a[nxt], a[at])
        z = c @ p["w2"] + p["b2"]
        h = np.maximum(z, 0)
        top = np.maximum.reduceat(h, firsts)
        n = np.maximum(counts - 1, 1)[:, None]
        mean = np.add.reduceat(h, firsts) / n
        out = np.hstack([top, mean]) @ p["w3"] + p["b3"][0]
        return (out, (rows, a, best, at, nxt, take, c, z, h, top, mean, firsts, n)) if keep else out

    def gradient(self, texts: list[str], y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        out, (rows, a, best, at, nxt, take, c, z, h, top, mean, firsts, n) = self.logits(texts, keep=True)
        d = ((1 / (1 + np.exp(-out)) - y) * weight / len(texts)).astype(np.float32)
        g = {"w3": np.hstack([top, mean]).T @ d, "b3": np.array([d.sum()], np.float32)}
        doc = np.repeat(np.arange(len(texts)), n[:, 0])
        dh = d[doc, None] * p["w3"][HIDDEN:] / n[doc]
        first_top = np.zeros_like(h, bool)
        ends = [*firsts[1:].tolist(), len(h)]
        for i, (s, e) in enumerate(zip(firsts.tolist(), ends, strict=True)):
            j = h[s:e].argmax(0)
            first_top[s + j, np.arange(HIDDEN)] = True
        dh += first_top * d[doc, None] * p["w3"][:HIDDEN]
        dz = dh * (z > 0)
        g["w2"], g["b2"] = c.T @ dz, dz.sum(0)
        dc = dz @ p["w2"].T
        da = np.zeros_like(a)
        np.add.at(da, at, dc * ~take)
        np.add.at(da, nxt, dc * take)
        da *= a > 0
        g["b1"] = da.sum(0)
        r, f = np.nonzero(da)
        v, s = da[r, f], best[r, f]
        span = rows[r[:, None], (s * STRIDE)[:, None] + np.arange(2 * STRIDE)]
        x = p["emb"][span].reshape(len(r), 2, STRIDE * DIM)
        g["w1"] = np.zeros_like(p["w1"])
        lo, hi = np.zeros((FILTERS, STRIDE * DIM), np.float32), np.zeros((FILTERS, STRIDE * DIM), np.float32)
        np.add.at(lo, f, v[:, None] * x[:, 0])
        np.add.at(hi, f, v[:, None] * x[:, 1])
        g["w1"][:, :FILTERS], g["w1"][:, FILTERS:] = lo.T, hi.T
        dx = np.stack([p["w1"].T[f], p["w1"].T[FILTERS + f]], 1) * v[:, None, None]
        g["emb"] = np.zeros_like(p["emb"])
        np.add.at(g["emb"], span.ravel(), dx.reshape(-1, DIM))
        return g

    def fit(self, sample: list[tuple[str, int]], share: float | None, epochs: int = EPOCHS, rate: float = 0.01, batch_bytes: int = 400_000) -> ByteCNN:
        """share: the share of label 1 in the whole table, to which the balanced sample's odds are shifted."""
        y = np.array([v for _, v in sample], np.float32)
        if len(set(y.tolist())) < 2:
            self.constant = float(share) if share is not None else 0.5
            return self
        g = np.random.default_rng(11)
        weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        self.shift = float(np.log(share / (1 - share)))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for epoch in range(epochs):
            order, batch, size = g.permutation(len(sample)).tolist(), [], 0
            for i in [*order, None]:
                if batch and (i is None or size + len(sample[i][0]) > batch_bytes or len(batch) == 64):
                    grad = self.gradient([sample[j][0] for j in batch], y[batch], weight[batch])
                    t += 1
                    step = rate * 0.5 ** (3 * epoch / epochs)
                    for k, v in grad.items():
                        m[k] = 0.9 * m[k] + 0.1 * v
                        s[k] = 0.99 * s[k] + 0.01 * v * v
                        self.p[k] -= (step * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
                    batch, size = [], 0
                if i is not None:
                    batch.append(i)
                    size += len(sample[i][0])
        return self

    def score(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        z = np.clip(self.logits(texts).astype(np.float64) + self.shift, -40, 40)
        return 1 / (1 + np.exp(-z))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> ByteCNN:
    learn = remainder("doc_id", 3) != 1
    own = labels.filter(learn & F.col(label).isin(0, 1))
    share = own.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return ByteCNN().fit(labelled_sample(docs, labels, label, learn, per_class), share)


def score(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = fit(docs, labels, per_class=per_class)

    def make():
        def run(cols, texts):
            s = model.score(texts)
            return {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "score": s, "predicted": (s >= 0.5).astype(np.int32)}

        return run

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), is_held_out("doc_id", 3, 1).alias("held_out"), "text")
    return map_texts(rows, "doc_id bigint, held_out boolean, score double, predicted int", make, max_chars=1_000_000)
