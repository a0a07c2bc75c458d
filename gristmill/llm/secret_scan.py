"""Secret scan over a trigram inverted index.

Each rule is a regular expression. From its parse tree we derive a Boolean query over trigrams that
every match must contain (AND of OR of trigrams, as in code-search indexes). For a block of documents
we build the inverted index trigram -> sorted document numbers, restricted to trigrams that some query
names; evaluate each query by intersecting and uniting postings; and run the expression on the
candidates only. A rule from which no trigram follows scans the whole block.

Results are defined for every input: null text counts as empty, empty text has no span, repeated rows
are scanned row by row, an empty table gives an empty result, extra columns are ignored. Offsets count
code points, the end is exclusive. Base kinds are `assign`, `access` and `hex`; further rules only add.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from re import _constants as sre
from re import _parser as sre_parse

import numpy as np
from pyspark.sql import DataFrame

from gristmill.llm.common import give_back, map_texts, text_chunks

#: Fixed values of the contract's base kinds: kind, expression, group to measure, least length of it.
BASE = (
    ("assign", r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: Further public credential formats.
MORE = (
    ("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("gitlab", r"\bglpat-[A-Za-z0-9_-]{20,}", 0, 26),
    ("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("google", r"\bAIza[A-Za-z0-9_-]{35}", 0, 39),
    ("stripe", r"\b[sr]k_live_[A-Za-z0-9]{16,}", 0, 24),
    ("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20),
)
RULES = BASE + MORE
#: A character class of more members than this stands for "any character" in a query.
WIDE = 6
#: A set of exact strings larger than this is turned into its trigram query.
MANY = 64


def _grams(strings: set[str]) -> list[frozenset[str]]:
    """Clauses that hold for a text with one of these strings: one OR clause over a trigram of each."""
    if not strings or any(len(s) < 3 for s in strings):
        return []
    clauses = [frozenset(s[i : i + 3] for s in strings for i in (0,)), frozenset(s[-3:] for s in strings)]
    if len(strings) == 1:
        (s,) = strings
        clauses = [frozenset([s[i : i + 3]]) for i in range(len(s) - 2)]
    return clauses


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """A conjunction of clauses, each a set of lower-case trigrams of which a matching text has one; [] if none follows."""

    def walk(items) -> tuple[set[str] | None, list[frozenset[str]]]:
        """The exact strings of a sequence (None: too many) and the clauses found inside."""
        run: set[str] = {""}
        clauses: list[frozenset[str]] = []

        def flush() -> None:
            nonlocal run
            clauses.extend(_grams(run))
            run = {""}

        exact = True
        for op, arg in items:
            part: set[str] | None = None
            if op is sre.LITERAL:
                part = {chr(arg).lower() if arg < 128 else chr(arg)}
            elif op is sre.IN:
                chars: set[str] | None = set()
                for kind, x in arg:
                    if chars is None or kind is sre.NEGATE or kind is sre.CATEGORY:
                        chars = None
                    elif kind is sre.LITERAL:
                        chars.add(chr(x).lower())
                    elif kind is sre.RANGE:
                        chars = chars | {chr(c).lower() for c in range(x[0], x[1] + 1)} if x[1] - x[0] < 64 else None
                part = chars if chars is not None and len(chars) <= WIDE else None
            elif op is sre.SUBPATTERN:
                part, inner = walk(arg[-1])
                clauses.extend(inner)
            elif op is sre.BRANCH:
                ways = [walk(x) for x in arg[1]]
                if all(w[0] is not None for w in ways):
                    part = set().union(*(w[0] for w in ways))
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
                low, high, body = arg
                inner, more = walk(body)
                if low:
                    clauses.extend(more)
                if inner is not None and high != sre.MAXREPEAT and high <= 2 and len(inner) <= WIDE:
                    part = {"".join(x) for n in range(low, high + 1) for x in itertools.product(inner, repeat=n)}
                elif inner is not None and low == high and len(inner) == 1:
                    part = {next(iter(inner)) * low}
            elif op is sre.AT or op is sre.ASSERT or op is sre.ASSERT_NOT:
                part = {""}
            if part is None or len(run) * len(part) > MANY:
                exact = False
                flush()
                if part is not None:
                    run = set(part)
            else:
                run = {a + b for a in run for b in part}
        if exact:
            return run, clauses
        flush()
        return None, clauses

    strings, clauses = walk(sre_parse.parse(pattern))
    if strings is not None:
        clauses = clauses + _grams(strings)
    return list(dict.fromkeys(clauses))


class TrigramIndex:
    """Postings of the named trigrams over a block of texts."""

    def __init__(self, texts: list[str], wanted: np.ndarray, codes: np.ndarray):
        """wanted: a flag for each 24-bit trigram; codes: the flagged ones, sorted."""
        self.n = len(texts)
        # Bytes of all texts with separators between; lower() of bytes folds ASCII letters only.
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        ends = np.cumsum([len(b) + 2 for b in raw])
        data = np.frombuffer(b"\x00\x00".join(raw).lower() + b"\x00\x00", np.uint8)
        code = data[:-2].astype(np.uint32) << 16
        code |= data[1:-1].astype(np.uint32) << 8
        code |= data[2:]
        at = np.flatnonzero(wanted[code])
        docs = np.searchsorted(ends, at, side="right")
        pairs = np.unique(np.searchsorted(codes, code[at]).astype(np.int64) * (self.n + 1) + docs)
        gram, self.docs = pairs // (self.n + 1), pairs % (self.n + 1)
        self.starts = np.searchsorted(gram, np.arange(len(codes) + 1))

    def postings(self, slot: int) -> np.ndarray:
        return self.docs[self.starts[slot] : self.starts[slot + 1]]

    def candidates(self, clauses: list[list[int]]) -> np.ndarray:
        """Documents that satisfy every clause; the rarest clause first."""
        lists = [np.unique(np.concatenate([self.postings(g) for g in c])) for c in clauses]
        lists.sort(key=len)
        out = lists[0]
        for other in lists[1:]:
            if not len(out):
                break
            out = out[np.isin(out, other, assume_unique=True)]
        return out


def _code(gram: str) -> int:
    b = gram.encode()
    return b[0] << 16 | b[1] << 8 | b[2]


class Scanner:
    """Finds the spans of all rules in blocks of texts."""

    def __init__(self, rules=RULES):
        self.rules = [(k, re.compile(p), g, n) for k, p, g, n in rules]
        self.order = {k: i for i, (k, *_) in enumerate(rules)}
        queries = [trigram_query(p) for _, p, _, _ in rules]
        # Only ASCII trigrams are indexed; a clause with another one is left out, which only widens the candidates.
        queries = [[c for c in q if all(g.isascii() for g in c)] for q in queries]
        self.codes = np.array(sorted({_code(g) for q in queries for c in q for g in c}), np.uint32)
        self.wanted = np.zeros(1 << 24, bool)
        self.wanted[self.codes] = True
        slot = {c: i for i, c in enumerate(self.codes.tolist())}
        self.queries = [[[slot[_code(g)] for g in c] for c in q] for q in queries]

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """For each text its spans (start, end, kind), in order of start, then rule."""
        found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        index = TrigramIndex(texts, self.wanted, self.codes)
        for (kind, rule, group, least), query in zip(self.rules, self.queries, strict=True):
            for i in index.candidates(query).tolist() if query else range(len(texts)):
                self._verify(texts[i], kind, rule, group, least, found[i])
        for spans in found:
            spans.sort(key=lambda s: (s[0], self.order[s[2]]))
        return found

    @staticmethod
    def _verify(text: str, kind: str, rule: re.Pattern, group: int, least: int, into: list) -> None:
        if kind == "hex":  # the runs that are long enough, which are the matches of the same expression that are kept
            rule = _LONG_HEX
        for m in rule.finditer(text):
            a, b = m.span(group)
            if b - a >= least:
                into.append((*m.span(), kind))


_LONG_HEX = re.compile(r"[0-9a-f]{24,}")


def _joined(spans: list[tuple[int, int, str]], kinds: set[str] | None = None) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans if kinds is None or k in kinds)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text and `spans`: array of (start, end, kind) of each row."""

    def make():
        scanner = Scanner()
        return lambda cols, texts: {"doc_id": cols["doc_id"], "text": texts, "spans": [[{"start": a, "end": b, "kind": k} for a, b, k in s] for s in scanner.scan(texts)]}

    return map_texts(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), "doc_id bigint, text string, spans array<struct<start:int,end:int,kind:string>>", make)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: counts, base_sha256 and all spans of each row."""
    base = {k for k, *_ in BASE}

    def make():
        scanner = Scanner()

        def run(cols, texts):
            spans = scanner.scan(texts)
            out = {"doc_id": cols["doc_id"]}
            for kind, *_ in BASE:
                out[f"n_{kind}"] = [sum(s[2] == kind for s in x) for x in spans]
            out["base_sha256"] = [hashlib.sha256(_joined(x, base).encode()).hexdigest() for x in spans]
            out["spans"] = [_joined(x) for x in spans]
            return out

        return run

    return map_texts(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string", make)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans count as one."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """All columns of the input, in its order; texts with secrets redacted, and n_chars, if there, their new length."""
    schema = docs.schema
    names = docs.columns

    def run(batches):
        import pyarrow as pa

        scanner = Scanner()
        for batch in batches:
            at = batch.schema.names.index("text")
            texts = batch.column(at).to_pylist()
            spans = [s for _, part in text_chunks([batch.select(["text"])], 2_000_000) for s in scanner.scan(part)]
            new = [None if t is None else redact(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            arrays = list(batch.columns)
            arrays[at] = pa.array(new, batch.schema.field(at).type)
            if "n_chars" in names:
                n = names.index("n_chars")
                arrays[n] = pa.array([old if a == b else len(b) for a, b, old in zip(texts, new, arrays[n].to_pylist(), strict=True)], batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)
        del scanner
        give_back()

    return docs.mapInArrow(run, schema)
