"""Personal data by base patterns and a skip-chain conditional random field.

Base kinds (email, ip, card, phone) are found by exact scans. The field then looks for further mentions.
Its nodes are the base spans, which are observed, and the other words of a document that hold a digit or
`@` or equal the name before the `@` of one of its addresses. Chain edges join neighbouring nodes. Skip
edges join mentions that are doubles (equal but for case and surrounding punctuation, equal last seven
digits, or an address and its name): each with the next one, however far, and each with the observed one
before and after it, so that many copies cannot outvote what was observed. Loopy sum-product message
passing over chain and skip edges gives the marginals of all nodes that are not observed. A word is
added if it has the same label as a double of it, with marginal `SURE` or more; a number is then extended
over the words before it as long as its digits continue those of the observed double.

The weights are fitted by pseudo-likelihood on a bounded, documented sample (about `SAMPLE` documents by
a hash of the id, `SAMPLE_CHARS` characters in all) with the base spans as labels. As plain text hardly
tells what a double in another form looks like, each base span of the sample is repeated in forms that
the base patterns miss, with its label, beside unrelated values of the same forms without one. Every
document is scanned whole, in time that grows with its mentions. Null text counts as empty, empty text
has no span, repeated rows are scanned row by row, an empty table gives an empty result, extra columns
are ignored. Offsets count code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import map_texts, sampled_texts

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 8000
SAMPLE_CHARS = 40_000_000
SURE = 0.6
ROUNDS = 8  #: rounds of message passing
DIGITS = 7  #: digits at the end by which numbers are doubles

_MARK = re.compile("[0-9@]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits that fails at its first digit fails at its others too, so only first digits are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\S+")
_CORE = re.compile(r"^[^\w+(]+|[^\w)]+$")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the base kinds in order; matches that fail their check are dropped without another try."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _NAME:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out["email"].append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    if not _MARK.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 40 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out["card"].append(m.span())
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out["phone"].append(m.span())
    return out


def _shape(word: str, gap_before: bool, gap_after: bool) -> list[int]:
    """Features of a word that do not tell whether a base pattern holds."""
    n = sum("0" <= c <= "9" for c in word)
    f = [0, 1 + min(n, 20) // 3, 8 + min(len(word), 40) // 5]
    f += [17 + k for k, c in enumerate("@.-()/:,") if c in word]
    f += [25 + min(word.count("."), 3), 29 + min(word.count("-"), 3), 33 + gap_before, 35 + gap_after]
    if 13 <= n <= 19:  # the check of a card is a matter of its digits, in whatever form they stand
        f.append(38 + luhn(_digits(word)))
    return f + ([37] if any(c.isalpha() for c in word) else [])


FEATURES = 40


def _name(word: str) -> str:
    """The name of an address if it tells enough to stand for it: three characters or more, a digit or a sign among them."""
    name = word.partition("@")[0].lower()
    return name if len(name) >= 3 and not name.isalpha() else ""


class Mentions:
    """The nodes of a text, in order, and its edges."""

    def __init__(self, text: str, spans: dict[str, list[tuple[int, int]]]):
        self.text = text
        observed = sorted((a, b, k) for k, kind in enumerate(KINDS, 1) for a, b in spans[kind])
        names = {n for a, b in spans["email"] if (n := _name(text[a:b]))}
        found, i = list(observed), 0
        for m in _WORD.finditer(text):
            while i < len(observed) and observed[i][1] <= m.start():
                i += 1
            if i < len(observed) and observed[i][0] < m.end():
                continue
            word = m.group()
            if _MARK.search(word) or names:
                core = _CORE.sub("", word)
                if _MARK.search(word) or core.lower() in names:
                    a = m.start() + word.find(core) if core else m.start()
                    found.append((a, a + len(core or word), 0))
        found.sort()
        self.where = [(a, b) for a, b, _ in found]
        self.labels = [k for _, _, k in found]
        self.words = words = [text[a:b] for a, b in self.where]
        self.chained = [i > 0 and self.where[i][0] - self.where[i - 1][1] <= 2 for i in range(len(found))]
        self.features = [_shape(w, self.chained[i], i + 1 < len(words) and self.chained[i + 1]) for i, w in enumerate(words)]
        groups: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            d = _digits(w)
            keys = {w.lower()}
            if len(d) >= DIGITS:
                keys.add(d[-DIGITS:])
            if n := _name(w):
                keys.add(n + "@")
            for key in keys:
                groups.setdefault(key, []).append(i)
        edges = set()
        for own in groups.values():
            edges.update(zip(own, own[1:], strict=False))
            for way in (own, own[::-1]):
                last = None
                for i in way:
                    if self.labels[i]:
                        last = i
                    elif last is not None:
                        edges.add((min(i, last), max(i, last)))
        self.skips = sorted(edges)

    def extended(self, i: int, others: list[int]) -> tuple[int, int]:
        """The span of an added number with the words before it that continue the digits of an observed double of it."""
        a, b = self.where[i]
        own = _digits(self.words[i])
        goals = [d for j in others if self.labels[j] and (d := _digits(self.words[j])).endswith(own)]
        while own and i and self.chained[i] and not self.labels[i - 1] and (more := _digits(self.words[i - 1])):
            own = more + own
            if not any(d.endswith(own) for d in goals):
                break
            i -= 1
            a = self.where[i][0]
        return a, b


def _forms(kind: str, value: str) -> list[str]:
    """Other forms of a value, which the base patterns miss."""
    d = _digits(value)
    if kind == "phone":
        n = d[-10:]
        return [f"{n[:-7]}-{n[-7:-4]}-{n[-4:]}", n, f"{n[-7:-4]}-{n[-4:]}", f"{n[:-7]}.{n[-7:-4]}.{n[-4:]}"]
    if kind == "email":
        return [n] if (n := _name(value)) else []
    if kind == "ip":
        return [value.replace(".", "-")]
    return [".".join(d[i : i + 4] for i in range(0, len(d), 4)), "/".join(d[i : i + 4] for i in range(0, len(d), 4))]


def _with_form(value: str, form: str, label: int, copies: int, rng: np.random.Generator) -> tuple[str, dict[tuple[int, int], int]]:
    """A text of a value, its copies in another form and as many unrelated values of that form, and the copies' places with their label."""
    other = "".join(str(rng.integers(1, 10)) if "0" <= c <= "9" else c for c in form)
    words = [(value, None), *[(form, label)] * copies, *[(other, None)] * (copies if other != form else 0)]
    text, places = "", {}
    for i in rng.permutation(len(words)).tolist():
        text += " and then "
        if words[i][1]:
            places[len(text), len(text) + len(form)] = label
        text += words[i][0]
    return text, places


class SkipChain:
    def __init__(self):
        n = len(KINDS) + 1
        self.w = np.zeros((FEATURES, n))
        self.chain = np.zeros((n, n))
        self.skip = np.zeros((n, n))

    def fit(self, texts: list[str], steps: int = 400) -> SkipChain:
        rng = np.random.default_rng(13)
        x, y, before, after, edges, shown = [], [], [], [], [], []
        for t in texts:
            if not _MARK.search(t):
                continue
            base = base_spans(t)
            shown.append((t, {}))
            for k, kind in enumerate(KINDS, 1):
                for a, b in base[kind][:20]:
                    shown += [_with_form(t[a:b], form, k, int(rng.integers(1, 4)), rng) for form in _forms(kind, t[a:b])]
        for t, places in shown:
            own = Mentions(t, base_spans(t))
            labels = [places.get(w, k) for w, k in zip(own.where, own.labels, strict=True)]
            at = len(y)
            x += own.features
            y += labels
            before += [labels[i - 1] if own.chained[i] else -1 for i in range(len(labels))]
            after += [labels[i + 1] if i + 1 < len(labels) and own.chained[i + 1] else -1 for i in range(len(labels))]
            edges += [(at + a, at + b) for a, b in own.skips]
        n = len(KINDS) + 1
        if y:
            m = np.zeros((len(y), FEATURES))
            for i, f in enumerate(x):
                m[i, f] = 1
            y, before, after = np.array(y), np.array(before), np.array(after)
            goal = np.eye(n)[y]
            one = lambda v: np.where(v[:, None] >= 0, np.eye(n)[v], 0)
            b, a, doubles = one(before), one(after), np.zeros((len(y), n))
            if edges:
                i, j = np.array(edges).T
                np.add.at(doubles, (i, y[j]), 1)
                np.add.at(doubles, (j, y[i]), 1)
            params = [self.w, self.chain, self.skip]
            mean, square = ([np.zeros_like(p) for p in params] for _ in range(2))
            for step in range(1, steps + 1):
                s = m @ self.w + b @ self.chain + a @ self.chain.T + doubles @ self.skip
                p = np.exp(s - s.max(1, keepdims=True))
                d = goal - p / p.sum(1, keepdims=True)
                sk = doubles.T @ d
                grads = [m.T @ d, b.T @ d + d.T @ a, (sk + sk.T) / 2]
                for p_, g, u, v in zip(params, grads, mean, square, strict=True):
                    g = g - 0.02 * p_
                    u += 0.1 * (g - u)
                    v += 0.01 * (g * g - v)
                    p_ += 0.15 * (1 - step / (steps + 1)) * u / (1 - 0.9**step) / np.sqrt(v / (1 - 0.99**step) + 1e-8)
        return self

    def marginals(self, labels: list[int], features: list[list[int]], chained: list[bool], skips: list[tuple[int, int]], rounds: int = ROUNDS) -> np.ndarray:
        """Label marginals of a document's nodes by loopy sum-product; base labels are observed."""
        n = len(KINDS) + 1
        own = np.array([self.w[f].sum(0) for f in features])
        labels = np.array(labels)
        own[labels > 0] = np.where(np.eye(n)[labels[labels > 0]] > 0, 0, -30)
        chain = [(i - 1, i) for i in range(1, len(labels)) if chained[i]]
        edges = []
        for pairs, t in ((chain, np.clip(self.chain, -12, 12)), (skips, np.clip(self.skip, -12, 12))):
            a, b = np.array(pairs, np.int64).reshape(-1, 2).T
            # What an observed node says is fixed, so it counts from the start; only the others' edges need messages.
            for x, y, table in ((a, b, t), (b, a, t.T)):
                told = (labels[x] > 0) & (labels[y] == 0)
                np.add.at(own, y[told], table[labels[x[told]]])
            free = (labels[a] == 0) & (labels[b] == 0)
            edges.append((a[free], b[free], np.exp(t)))
        a, b = (np.concatenate([e[i] for e in edges]) for i in (0, 1))
        kinds = ((slice(0, len(edges[0][0])), edges[0][2]), (slice(len(edges[0][0]), None), edges[1][2]))
        to_b, to_a = np.zeros((len(a), n)), np.zeros((len(a), n))
        new_b, new_a = np.empty_like(to_b), np.empty_like(to_a)
        for r in range(rounds + 1):
            belief = own.copy()
            np.add.at(belief, b, to_b)
            np.add.at(belief, a, to_a)
            if r == rounds or not len(a):
                break
            out_a, out_b = belief[a] - to_a, belief[b] - to_b
            out_a, out_b = np.exp(out_a - out_a.max(1, keepdims=True)), np.exp(out_b - out_b.max(1, keepdims=True))
            for part, t in kinds:
                new_b[part], new_a[part] = out_a[part] @ t, out_b[part] @ t.T
            to_b = 0.5 * to_b + 0.5 * np.log(new_b / new_b.sum(1, keepdims=True) + 1e-30)
            to_a = 0.5 * to_a + 0.5 * np.log(new_a / new_a.sum(1, keepdims=True) + 1e-30)
        p = np.exp(belief - belief.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def spans(self, text: str) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
        """Base spans, and base spans with the field's additions, of one text."""
        base = base_spans(text)
        if not _MARK.search(text):
            return base, base
        own = Mentions(text, base)
        doubles: dict[int, list[int]] = {}
        for a, b in own.skips:
            doubles.setdefault(a, []).append(b)
            doubles.setdefault(b, []).append(a)
        # Only words with a double and without a base label can be added.
        if all(own.labels[i] for i in doubles):
            return base, base
        p = self.marginals(own.labels, own.features, own.chained, own.skips)
        best = p.argmax(1)
        added: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        for i in sorted(doubles):
            k = int(best[i])
            if not own.labels[i] and k and p[i, k] >= SURE and any(best[j] == k for j in doubles[i]):
                span = own.extended(i, doubles[i])
                while added[KINDS[k - 1]] and added[KINDS[k - 1]][-1][0] >= span[0]:  # a part of this mention that was added on its own
                    added[KINDS[k - 1]].pop()
                added[KINDS[k - 1]].append(span)
        return base, {k: sorted(base[k] + added[k]) for k in KINDS}


def _joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def fit(docs: DataFrame, sample: int = SAMPLE) -> SkipChain:
    rows = docs.filter(F.col("text").isNotNull() & F.col("text").rlike("[0-9@]"))
    return SkipChain().fit(sampled_texts(rows, "pii", docs.count(), sample, SAMPLE_CHARS))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: counts, base_sha256 and all spans of each row."""
    field = fit(docs)

    def make():
        def run(cols, texts):
            found = [field.spans(t) for t in texts]
            out = {"doc_id": cols["doc_id"]}
            for kind in KINDS:
                out[f"n_{kind}"] = [len(b[kind]) for b, _ in found]
            out["base_sha256"] = [hashlib.sha256(_joined(b).encode()).hexdigest() for b, _ in found]
            out["spans"] = [_joined(every) for _, every in found]
            return out

        return run

    return map_texts(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string", make)
