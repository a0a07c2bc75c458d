"""Toxicity by a linear-chain conditional random field over words.

The labelled tokens come from labelled documents by distant supervision: a word, or a stem of four to
six letters, that occurs in many toxic training documents and in hardly any clean one marks its tokens
in toxic documents. The field has two states; its emission weights are over hashed features of a word
(the word, its stems, its ending), its transitions are learned with them by conditional likelihood,
with gradients from forward-backward. Scoring runs forward-backward over all words of the whole
document; the marginals give the offending offsets and are aggregated (expected toxic words and the
largest marginal) by a fitted logistic to the document score.

Learning uses a bounded, documented sample (`PER_CLASS` documents of each class, by a hash of the id).
Documents are worked through side by side, and the rest of the few longest one by one.
Null text counts as empty; a text without words gets the score of zero expected toxic words. Repeated
rows get equal scores, an empty table gives an empty result, without labels of both classes the score
is the share of label 1 (0 without any). A null doc_id is scored and counts as not held out.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import WordTable, is_held_out, labelled_sample, lockstep, map_texts, remainder, side_by_side

PER_CLASS = {0: 3600, 1: 1200}  #: documents of the sample, by label
BUCKETS = 1 << 18
CHAIN_WORDS = 1500  #: longer training documents take part in the labelling of tokens, not in the chain's gradient
CHAIN_DOCS = 1000  #: documents of each class whose tokens the chain learns from
ROUNDS = 25
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def features(word: str) -> list[str]:
    """The word without surrounding punctuation, its stems and its ending."""
    w = word if word.isalpha() else _EDGES.sub("", word)
    return [f"w{w}", *(f"p{n}{w[:n]}" for n in (4, 5, 6) if len(w) >= n), f"s{w[-3:]}"] if w else []


def hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the features of all words (-1 for a word without), whether each is the word or a stem, and each word's number."""
    own = [features(w) for w in words]
    flat = np.array([h for x in own for h in ([zlib.crc32(f.encode("utf-8", "surrogatepass")) for f in x] or [-1])], np.int64)
    stem = np.array([v for x in own for v in ([f[0] != "s" for f in x] or [False])], bool)
    return flat, stem, np.array([len(x) or 1 for x in own], np.int64)


def _slots(flat: np.ndarray) -> np.ndarray:
    return np.where(flat >= 0, flat % BUCKETS, BUCKETS)


def marginal_logits(u: np.ndarray, lengths: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward of the two-state chain in log-odds: forward and backward messages and marginal logits of each word."""
    order, active = lockstep(lengths)
    starts = (np.cumsum(lengths) - lengths)[order]
    f, b = np.zeros(len(u)), np.zeros(len(u))
    run = np.zeros(len(lengths))
    alone = side_by_side(active)
    few = [(int(starts[i]), int(lengths[order[i]])) for i in range(active[alone])] if alone < len(active) else []
    for t, n in enumerate(active[:alone].tolist()):
        rows = starts[:n] + t
        if t:
            x = run[:n]
            run[:n] = np.logaddexp(a[0, 1], a[1, 1] + x) - np.logaddexp(a[0, 0], a[1, 0] + x) + u[rows]
        else:
            run[:n] = u[rows]
        f[rows] = run[:n]
    for i, (start, length) in enumerate(few):  # the words of the few longest documents, one document after another
        f[start + alone : start + length] = _recursion(u[start + alone : start + length].tolist(), float(run[i]), *a.ravel().tolist(), after=True)
    run[:] = 0
    for i, (start, length) in enumerate(few):
        own = _recursion(u[start + alone : start + length][::-1].tolist(), 0.0, a[0, 0], a[1, 0], a[0, 1], a[1, 1], after=False)
        b[start + alone - 1 : start + length - 1] = own[::-1]
        run[i] = own[-1]
    for t in range(min(len(active), alone) - 2, -1, -1):
        n = active[t + 1]
        rows = starts[:n] + t
        x = u[rows + 1] + run[:n]
        run[:n] = np.logaddexp(a[1, 0], a[1, 1] + x) - np.logaddexp(a[0, 0], a[0, 1] + x)
        b[rows] = run[:n]
    return f, b, f + b


def _recursion(u: list[float], x: float, a: float, b: float, c: float, d: float, after: bool) -> list[float]:
    """Messages in log-odds along one document; each word's own log-odds count after the step (forward) or before it (backward)."""
    out = []
    for w in u:
        if not after:
            x += w
        low, high = c + x, d + x
        x = max(b, high) + math.log1p(math.exp(-abs(b - high))) - max(a, low) - math.log1p(math.exp(-abs(a - low)))
        if after:
            x += w
        out.append(x)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def token_labels(docs: list[np.ndarray], toxic: np.ndarray, flat: np.ndarray, stem: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hashes of the words and stems that mark toxic tokens: frequent in toxic documents, rare in clean ones."""
    starts = np.cumsum(n) - n
    each: list[list[np.ndarray]] = [[], []]
    for ids, y in zip(docs, toxic.tolist(), strict=True):
        w = np.unique(ids)
        at = np.repeat(starts[w] - (np.cumsum(n[w]) - n[w]), n[w]) + np.arange(int(n[w].sum()))
        each[y].append(np.unique(flat[at][stem[at]]).astype(np.uint32))
    neg, pos = len(each[0]), len(each[1])
    (c_keys, c), (t_keys, t) = (np.unique(np.concatenate(x), return_counts=True) for x in each)
    at = np.minimum(np.searchsorted(c_keys, t_keys), max(len(c_keys) - 1, 0))
    c = np.where(c_keys[at] == t_keys, c[at], 0) if len(c_keys) else np.zeros(len(t_keys), np.int64)
    # A feature counts if, were it spread evenly, so lopsided a split would not be expected once among all features
    # (Chernoff's bound on the binomial tail, with Bonferroni's correction).
    p, level = pos / (pos + neg), np.log(max(2, len(c_keys) + len(t_keys)) / 0.01)
    q = t / (c + t)
    tail = q * np.log(q / p) + np.where(q < 1, (1 - q) * np.log(np.maximum(1 - q, 1e-12) / (1 - p)), 0)
    return t_keys[(t >= 4) & (q > max(p, 0.8)) & ((c + t) * tail > level)].astype(np.int64)


def without_copies(docs: list[np.ndarray]) -> list[int]:
    """Positions of the documents that are no near copy of an earlier one, by the smallest hashes of their five-word shingles.

    Copies are not independent evidence: a word that one toxic text brings along in a hundred copies is no toxic word.
    """
    seen: set[int] = set()
    kept = []
    for i, ids in enumerate(docs):
        x = np.concatenate([ids, np.full(max(0, 5 - len(ids)), -1)]).astype(np.uint64)
        h = np.zeros(len(x) - 4, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(5):
                h = (h ^ x[j : len(x) - 4 + j]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
        low = np.unique(h)[:24].tolist()
        if 4 * sum(v in seen for v in low) < len(low):
            kept.append(i)
        seen.update(low)
    return kept


class ToxicField:
    """The fitted field and the logistic over its marginals."""

    def __init__(self):
        self.theta = np.zeros(BUCKETS + 1)
        self.bias = -6.0
        self.a = np.zeros((2, 2))
        self.doc = np.array([0.0, 1.0, 1.0])
        self.constant: float | None = None

    def emissions(self, words: list[str]) -> np.ndarray:
        flat, _, n = hashed(words)
        return np.add.reduceat(self.theta[_slots(flat)], np.cumsum(n) - n) + self.bias if len(words) else np.zeros(0)

    def fit(self, sample: list[tuple[str, int]], share: float | None) -> ToxicField:
        toxic = np.array([y for _, y in sample])
        if len(set(toxic.tolist())) < 2:
            self.constant = float(share) if share is not None else 0.0
            return self
        ids: dict[str, int] = {}
        docs = [np.fromiter((ids.setdefault(w, len(ids)) for w in t.lower().split()), np.int32) for t, _ in sample]
        kept = without_copies(docs)
        if len(set(toxic[kept].tolist())) == 2:
            docs, toxic = [docs[i] for i in kept], toxic[kept]
        words = list(ids)
        del ids
        flat, stem, n = hashed(words)
        marks = token_labels(docs, toxic, flat, stem, n)
        offsets = np.cumsum(n) - n
        marked = np.maximum.reduceat(np.isin(flat, marks) & stem, offsets) if len(words) else np.zeros(0, bool)
        flat = _slots(flat)
        owner = np.repeat(np.arange(len(words)), n)
        # The chain learns from about as many clean documents as toxic ones.
        chain = [[d for d, y in zip(docs, toxic.tolist(), strict=True) if y == k and 0 < len(d) <= CHAIN_WORDS][:CHAIN_DOCS] for k in (1, 0)]
        chain[1] = chain[1][: 2 * len(chain[0]) + 1]
        lengths = np.array([len(d) for x in chain for d in x], np.int64)
        at = np.concatenate([np.zeros(0, np.int32), *chain[0], *chain[1]]).astype(np.int64)
        y = marked[at] & (np.arange(len(at)) < sum(map(len, chain[0])))
        last = np.zeros(len(at), bool)
        last[np.cumsum(lengths) - 1] = True
        pair = np.flatnonzero(~last)
        observed = np.array([[np.sum(~y[pair] & ~y[pair + 1]), np.sum(~y[pair] & y[pair + 1])], [np.sum(y[pair] & ~y[pair + 1]), np.sum(y[pair] & y[pair + 1])]], float)
        ss, sa, sb = np.full(BUCKETS + 1, 1e-2), np.full((2, 2), 1e-2), 1e-2
        for _ in range(ROUNDS):
            uw = np.add.reduceat(self.theta[flat], offsets) + self.bias
            u = uw[at]
            f, b, logit = marginal_logits(u, lengths, self.a)
            g = y - _sigmoid(logit)
            gw = np.bincount(at, weights=g, minlength=len(words))
            gt = np.bincount(flat, weights=gw[owner], minlength=BUCKETS + 1) - 0.02 * self.theta
            x, z = f[pair], u[pair + 1] + b[pair + 1]
            logs = np.stack([np.full(len(x), self.a[0, 0]), self.a[0, 1] + z, self.a[1, 0] + x, self.a[1, 1] + x + z])
            w = np.exp(logs - logs.max(0))
            expected = (w / w.sum(0)).sum(1).reshape(2, 2)
            ga, gb = observed - expected - 0.02 * self.a, g.sum()
            ss += gt * gt
            sa += ga * ga
            sb += gb * gb
            self.theta += 0.7 * gt / np.sqrt(ss)
            self.theta[BUCKETS] = 0
            self.a += 0.3 * ga / np.sqrt(sa)
            self.bias += 0.3 * gb / np.sqrt(sb)
        self._fit_documents(docs, toxic, words, share)
        return self

    def _fit_documents(self, docs: list[np.ndarray], toxic: np.ndarray, words: list[str], share: float) -> None:
        u = self.emissions(words)
        x = np.full((len(docs), 2), -8.0)
        for a in range(0, len(docs), 500):
            lengths = np.array([len(d) for d in docs[a : a + 500]], np.int64)
            at = np.concatenate([np.zeros(0, np.int32), *docs[a : a + 500]])
            x[a : a + 500] = self.aggregate(marginal_logits(u[at], lengths, self.a)[2], lengths)
        x = np.column_stack([np.ones(len(docs)), x])
        weight = np.where(toxic == 1, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean()))
        w = np.zeros(3)
        for _ in range(60):  # damped Newton steps
            p = _sigmoid(x @ w)
            grad = x.T @ (weight * (toxic - p)) - 0.05 * w
            hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
            w += np.clip(np.linalg.solve(hess, grad), -1, 1)
        w[0] += np.log(share / (1 - share)) * 0.5  # half way to the table's odds: both kinds of error count
        self.doc = w

    @staticmethod
    def aggregate(logit: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each document the log of its expected toxic words and its largest marginal logit, bounded."""
        out = np.full((len(lengths), 2), -8.0)
        full = np.flatnonzero(lengths)
        if len(full):
            starts = (np.cumsum(lengths) - lengths)[full]
            out[full, 0] = np.log(np.add.reduceat(_sigmoid(logit), starts) + 3e-4)
            out[full, 1] = np.clip(np.maximum.reduceat(logit, starts), -8, 8)
        out[:, 0] = np.clip(out[:, 0], -8, 4)
        return out

    def scores(self, logit: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(lengths), self.constant)
        return _sigmoid(self.doc[0] + self.aggregate(logit, lengths) @ self.doc[1:])


class Tagger:
    """Scores whole texts with a field; keeps emissions of words between calls."""

    def __init__(self, field: ToxicField):
        self.field, self.table = field, WordTable(field.emissions)

    def tag(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of the texts, words of each, and the marginal logit of each word."""
        tokens, lengths = [], []
        for t in texts:
            own = t.lower().split()
            tokens += own
            lengths.append(len(own))
        lengths = np.array(lengths, np.int64)
        if self.field.constant is not None or not tokens:
            return self.field.scores(np.full(len(tokens), -8.0), lengths), lengths, np.full(len(tokens), -8.0)
        at = self.table.look_up(tokens)
        logit = marginal_logits(self.table.rows[at], lengths, self.field.a)[2]
        return self.field.scores(logit, lengths), lengths, logit

    def spans(self, texts: list[str], lengths: np.ndarray, logit: np.ndarray) -> list[list[dict]]:
        """Toxic stretches of each text: neighbouring words of marginal 0.5 or more, offsets in code points."""
        out, at = [], 0
        for t, n in zip(texts, lengths.tolist(), strict=True):
            own = logit[at : at + n] >= 0
            at += n
            spans: list[dict] = []
            if own.any():
                before = False
                for m, hit in zip(re.finditer(r"\S+", t), own.tolist(), strict=True):
                    if hit and before:
                        spans[-1]["end"] = m.end()
                    elif hit:
                        spans.append({"start": m.start(), "end": m.end()})
                    before = hit
            out.append(spans)
        return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: dict[int, int] | int | None = None) -> ToxicField:
    learn = remainder("doc_id", 5) != 0
    share = labels.filter(learn & F.col(label).isin(0, 1)).agg(F.avg(F.col(label).cast("double"))).first()[0]
    return ToxicField().fit(labelled_sample(docs, labels, label, learn, per_class or PER_CLASS), share)


def score(docs: DataFrame, labels: DataFrame, per_class: dict[int, int] | int | None = None, spans: bool = False) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; with ``spans`` also the offending offsets."""
    field = fit(docs, labels, per_class=per_class)

    def make():
        tagger = Tagger(field)

        def run(cols, texts):
            s, lengths, logit = tagger.tag(texts)
            out = {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "score": s, "predicted": (s >= 0.5).astype(np.int32)}
            return out | ({"spans": tagger.spans(texts, lengths, logit)} if spans else {})

        return run

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), is_held_out("doc_id", 5, 0).alias("held_out"), "text")
    return map_texts(rows, "doc_id bigint, held_out boolean, score double, predicted int" + (", spans array<struct<start:int,end:int>>" if spans else ""), make)
