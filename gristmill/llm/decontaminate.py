"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of words. Words (lower-cased runs of letters and digits) are hashed to `TERMS`
columns and weighted by inverse document frequency over passages of all documents; columns that occur
in more than `STOP` of the passages carry no weight, unless a benchmark passage has no other. Passages that have few
others are searched a second time with their rarest half weighted, by a latent space of its own, as a window's
other words would outweigh the few. A randomised singular value decomposition of the
TF-IDF passages, worked out by one distributed pass that adds up the parts of A'(AX), gives the latent
space. Windows of 16, 32 and 64 words slide over every whole document by half their length; each is
projected, and its cosine with the benchmark items of its scale, relative to an item's with itself in
the latent space, picks candidates. A candidate is
contaminated if the longest common subsequence of the item and the words around the window covers
`SAME` of the item, or `ALIKE` of it and the item's answer terms (its rarest third) are mostly there too,
which catches paraphrases. Items of under `SHORT` words must occur word for word.

Decomposition, frequencies, windows and searches cover all benchmark passages and all documents. Null texts and
items have no word and match nothing. Repeated rows are judged row by row, repeated items once each id.
Empty tables give an empty result. Extra columns are ignored. Benchmarks beyond `ITEMS` passages are
searched in several runs of that many, so that what is sent to the tasks has a fixed bound.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import give_back, lockstep, shuffles_dropped, text_chunks

TERMS = 1 << 15
RANK, MORE = 64, 16
EMPHASIS = 20.0
STOP = 0.02
STEP = 8  #: words of a step; windows are 2, 4 and 8 steps
SCALES = (2, 4, 8)
#: The least cosine, as a share of what the item has with itself in the latent space.
COSINE = 0.4
SAME, ALIKE, ANSWER = 0.75, 0.55, 0.6
SHORT = 8
ITEMS = 20_000
UNITS = 65536.0  #: parts of one in which the basis is added up
BLOCK = 2048  #: rows that are summed at a time
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_IN_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


class Words:
    """Word numbers (32-bit hashes) of texts, worked out for all bytes at once.

    A word is a run of letters, digits and non-ASCII bytes of the lower-cased text. With P(i) the sum of b(j) * f^j
    over the bytes before i, a word's hash is (P(end) - P(start)) / f^start modulo 2^64, so one running sum gives all.
    """

    def __init__(self):
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            with np.errstate(over="ignore"):
                self.powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _FACTOR, np.uint64))])
                self.inverse = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _INVERSE, np.uint64))])

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
        data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        self._grow(len(data))
        inside = _IN_WORD[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(data) and inside[0]:
            edges = np.concatenate([[0], edges])
        starts, ends = edges[::2], edges[1::2]
        with np.errstate(over="ignore"):
            total = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)])
            before = np.where(starts > 0, total[starts - 1], np.uint64(0))
            hashes = (total[ends - 1] - before) * self.inverse[starts]
            hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(_FACTOR)
        return (hashes >> np.uint64(32)).astype(np.int64), np.diff(np.searchsorted(starts, begins))


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """For each column the passages (64 words, end to end) of all documents that hold it, and the passages."""
    size = STEP * SCALES[-1]

    def run(batches):
        words, total, n = Words(), np.zeros(TERMS, np.int64), 0
        for _, texts in text_chunks(batches, 1_000_000):
            ids, lengths = words.of(texts)
            if not len(ids):
                continue
            within = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            passage = np.cumsum(within % size == 0) - 1
            count = int(passage[-1]) + 1
            n += count
            grid = np.full((count, size), -1, np.int32)
            grid[passage, within % size] = ids % TERMS
            grid.sort(axis=1)
            first = np.ones(grid.shape, bool)
            first[:, 1:] = grid[:, 1:] != grid[:, :-1]
            total += np.bincount(grid[first & (grid >= 0)], minlength=TERMS)
        del words
        give_back()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], at])), pa.array(np.concatenate([[n], total[at]]))], names=["term", "n"])

    out, n = np.zeros(TERMS, np.int64), 0
    for r in docs.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        if r.term < 0:
            n = r.n
        else:
            out[r.term] = r.n
    return out, n


def passages_of(items: list[tuple[int, str]]) -> tuple[list[int], list[list[int]]]:
    """The items' ids and word numbers, passage by passage; items of over 64 words are cut into overlapping ones."""
    words, owner, passages = Words(), [], []
    size = STEP * SCALES[-1]
    for item, text in items:
        ids, _ = words.of([text])
        n = len(ids)
        for a in range(0, max(1, n - size // 4), size * 3 // 4) if n > size else [0]:
            if len(part := ids[a : a + size]):
                owner.append(item)
                passages.append(part.tolist())
    return owner, passages


def weights(df: np.ndarray, n: int, passages: list[list[int]] = ()) -> np.ndarray:
    """Weights of the columns. A benchmark passage of frequent words alone (it may itself be copied that often)
    would be invisible, so the rarest half of its columns weigh as much as one at the limit.
    """
    idf = np.log((n + 1) / (df + 1))
    # Small collections need some passages before a share says anything.
    out = np.where(df > max(STOP * n, 20), 0.0, idf)
    for p in passages:
        cols = np.unique(np.array(p) % TERMS)
        if len(cols) and not out[cols].any():
            rare = cols[np.argsort(df[cols], kind="stable")[: -(-len(cols) // 2)]]
            out[rare] = -np.log(STOP)
    return out.astype(np.float32)


def few_weighted(idf: np.ndarray, passage: list[int]) -> bool:
    """Whether some of a passage's columns, but under half, have a weight."""
    cols = np.unique(np.array(passage) % TERMS)
    return 0 < 2 * np.count_nonzero(idf[cols]) < len(cols)


def raised(df: np.ndarray, idf: np.ndarray, passages: list[list[int]]) -> np.ndarray:
    """Weights by which the rarest half of each of the passages' columns weigh at least as much as one at the limit."""
    out = idf.copy()
    for p in passages:
        cols = np.unique(np.array(p) % TERMS)
        rare = cols[np.argsort(df[cols], kind="stable")[: -(-len(cols) // 2)]]
        out[rare] = np.maximum(out[rare], -np.log(STOP))
    return out


def _columns(ids: np.ndarray, lengths: np.ndarray, weighted: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The columns of 64-word passages as (row, column), rows in order, columns that carry a weight only, and the passages' number."""
    within = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    row = np.cumsum(within % (STEP * SCALES[-1]) == 0) - 1
    size, count = STEP * SCALES[-1], int(row[-1]) + 1 if len(row) else 0
    grid = np.full((count, size), -1, np.int32)
    grid[row, within % size] = ids % TERMS
    grid.sort(axis=1)
    first = (grid >= 0) & weighted[grid]
    first[:, 1:] &= grid[:, 1:] != grid[:, :-1]  # a term counts once in a passage: one word repeated is no topic
    return np.nonzero(first)[0], grid[first], count


def _summed(table: np.ndarray, take: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of ``counts`` (1 at least) numbers in ``take`` the sums of those rows of the table, each run from its first to its last; and the runs' order in the result."""
    order, active = lockstep(counts)
    starts = (np.cumsum(counts) - counts)[order]
    out = np.empty((len(counts), table.shape[1]), table.dtype)
    rows = np.empty((min(len(counts), BLOCK), table.shape[1]), table.dtype)
    for a in range(0, len(counts), BLOCK):
        own, at = out[a : a + BLOCK], starts[a : a + BLOCK]
        np.take(table, take[at], axis=0, out=own, mode="clip")
        for j in range(1, int(counts[order[a]])):
            n = min(int(active[j]) - a, BLOCK)
            np.take(table, take[at[:n] + j], axis=0, out=rows[:n], mode="clip")
            own[:n] += rows[:n]
    return out, order


def _gram_product(ids: np.ndarray, lengths: np.ndarray, idfs: list[np.ndarray], weighed: np.ndarray, into: np.ndarray) -> None:
    """Adds C'DD(CWX) of the passages to ``into`` (TERMS x weightings * width), with ``weighed`` WX of all weightings side by side.

    C tells which columns a passage has, W weighs them and D scales rows to unit length, so A is DCW, and A'(AX) is W times
    this. All dimensions of all weightings are read and added a row at a time. What is added is rounded to multiples of
    1 / `UNITS`, so that sums are exact and in no order.
    """
    row, col, n = _columns(ids, lengths, np.any([idf > 0 for idf in idfs], axis=0))
    if not len(row):
        return
    square = np.stack([np.bincount(row, weights=idf[col].astype(np.float64) ** 2, minlength=n) for idf in idfs], axis=1)
    counts = np.bincount(row, minlength=n)
    kept = np.flatnonzero(counts)
    y, order = _summed(weighed, col, counts[kept])
    scale = (UNITS / np.maximum(square[kept[order]], 1e-9)).astype(np.float32)
    z = np.rint(y.reshape(len(y), len(idfs), -1) * scale[:, :, None]).reshape(len(y), -1)
    line = np.empty(n, np.int64)
    line[kept[order]] = np.arange(len(y))
    by_col = np.argsort(col.astype(np.uint16), kind="stable")  # two bytes are sorted by radix
    counts = np.bincount(col, minlength=TERMS)
    held = np.flatnonzero(counts)
    exact = np.int32 if float(np.abs(z).max()) * int(counts.max()) < 2**31 else np.int64
    sums, order = _summed(z.astype(exact), line[row[by_col]], counts[held])
    for a in range(0, len(sums), BLOCK):
        into[held[order[a : a + BLOCK]]] += sums[a : a + BLOCK]


def _start() -> np.ndarray:
    """The random directions (TERMS x width) from which the decomposition starts."""
    return np.ascontiguousarray(np.random.default_rng(3).normal(size=(RANK + MORE, TERMS)).astype(np.float32).T)


def _weighed(idfs: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.concatenate([idf[:, None] * x for idf in idfs], axis=1))


def latent_spaces(docs: DataFrame, items: list[str], idfs: list[np.ndarray], passages: int) -> list[np.ndarray]:
    """For each weighting the leading right singular vectors (TERMS x RANK) of benchmark passages and all documents' passages.

    One pass over the documents adds up Y = A'(AX) for all weightings; the vectors are those of the approximation
    Y (X'Y)^-1 Y' of A'A. Benchmark rows weigh `EMPHASIS` times as much as the documents' ``passages`` together, so that
    the space keeps their directions. As many tasks as cores read the documents, so the parts' size has no part of the input's.
    """
    width, slices = RANK + MORE, 64
    step = TERMS // slices

    def part(batches):
        words, out = Words(), np.zeros((TERMS, len(idfs) * width))
        weighed = _weighed(idfs, _start())
        for _, texts in text_chunks(batches, 1_000_000):
            _gram_product(*words.of(texts), idfs, weighed, out)
        del words, weighed
        give_back()
        for i in range(slices):
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([out[i * step : (i + 1) * step].tobytes()], pa.binary())], names=["slice", "part"])

    def added(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        s = np.zeros(step * len(idfs) * width)
        for b in table.column("part"):
            s += np.frombuffer(b.as_buffer())
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([(s / UNITS).astype(np.float32).tobytes()], pa.binary())})

    y = np.zeros((TERMS, len(idfs) * width), np.float32)
    spark = docs.sparkSession
    with shuffles_dropped(spark):
        parts = docs.select("text").coalesce(spark.sparkContext.defaultParallelism).mapInArrow(part, "slice bigint, part binary").groupBy("slice").applyInArrow(added, "slice bigint, part binary").collect()
        for r in parts:
            y[r.slice * step : (r.slice + 1) * step] = np.frombuffer(r.part, np.float32).reshape(step, -1)
    del parts
    x, bench = _start(), np.zeros(y.shape)
    _gram_product(*Words().of(items), idfs, _weighed(idfs, x), bench)
    y += EMPHASIS * max(1.0, passages / max(1, len(items))) / UNITS * bench
    del bench
    return [_leading(idf[:, None] * y[:, k * width : (k + 1) * width], x) for k, idf in enumerate(idfs)]


def _leading(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Singular vectors from A'(AX) and X."""
    y = y.astype(np.float64)
    y += 1e-6 * np.linalg.norm(y) / np.linalg.norm(x) * x  # keeps X'Y from being singular
    core = x.T @ y
    values, turns = np.linalg.eigh((core + core.T) / 2)
    values = np.maximum(values, 1e-9 * max(float(values[-1]), 1e-30))
    left = np.linalg.svd(y @ (turns / np.sqrt(values)), full_matrices=False)[0]
    return np.ascontiguousarray(left[:, :RANK].astype(np.float32))


class Retrieval:
    """Benchmark passages in the latent space, and the checks of a candidate."""

    def __init__(self, items: list[tuple[int, str]], idf: np.ndarray, v: np.ndarray, wanted: Callable[[list[int]], bool] = lambda _: True):
        self.idf = idf
        self.weighted = np.vstack([v * idf[:, None], np.zeros((1, v.shape[1]), np.float32)])  # the last row for no word
        self.square = np.append(idf**2, np.float32(0))
        kept = [(k, p) for k, p in zip(*passages_of(items), strict=True) if wanted(p)]
        self.owner, self.passages = [k for k, _ in kept], [p for _, p in kept]
        lengths = [len(p) for p in self.passages]
        self.scale = np.array([next((s for s in SCALES if STEP * s >= n), SCALES[-1]) for n in lengths], np.int64)
        self.z = np.zeros((len(lengths), RANK), np.float32)
        self.masks: list[dict[int, int]] = []
        self.answers: list[set[int]] = []
        for k, p in enumerate(self.passages):
            cols = np.array(p) % TERMS
            w = idf[cols]
            norm = float(np.sqrt((w**2).sum()))
            if norm:
                self.z[k] = (v[cols] * w[:, None]).sum(0) / norm
                self.z[k] /= max(float(self.z[k] @ self.z[k]), 1e-6)
            masks: dict[int, int] = {}
            for i, t in enumerate(p):
                masks[t] = masks.get(t, 0) | 1 << i
            self.masks.append(masks)
            self.answers.append(set(sorted(set(p), key=lambda t: (-idf[t % TERMS], t))[: max(1, len(set(p)) // 3)]))
        self.by_scale = {s: np.flatnonzero(self.scale == s) for s in SCALES}

    def judge(self, k: int, region: list[int]) -> tuple[int, float] | None:
        """LCS and share of answer terms if the region of words holds passage k, else nothing."""
        masks, own = self.masks[k], self.passages[k]
        n = len(own)
        if n < SHORT:
            hit = any(region[i : i + n] == own for i in range(len(region) - n + 1))
            return (n, 1.0) if hit else None
        full = (1 << n) - 1
        v = full
        for t in region:
            m = masks.get(t)
            if m:
                u = v & m
                v = ((v + u) | (v - u)) & full
        lcs = n - v.bit_count()
        answers = self.answers[k]
        share = len(answers.intersection(region)) / len(answers)
        if lcs >= SAME * n or (lcs >= ALIKE * n and share >= ANSWER):
            return lcs, share
        return None

    def search(self, ids: np.ndarray, lengths: np.ndarray) -> dict[tuple[int, int], tuple]:
        """Hits (document, item) -> (LCS, words of the passage, cosine, answer share, first word of the window)."""
        out: dict[tuple[int, int], tuple] = {}
        if not len(ids) or not len(self.passages):
            return out
        pad = SCALES[-1] - 1
        steps = -(-lengths // STEP) + pad
        first_step = np.cumsum(steps) - steps
        starts = np.cumsum(lengths) - lengths
        doc = np.repeat(np.arange(len(lengths)), lengths)
        within = np.arange(len(ids)) - starts[doc]
        grid = np.full((int(steps.sum()), STEP), TERMS, np.int64)
        grid[first_step[doc] + within // STEP, within % STEP] = ids % TERMS
        sums = np.empty((len(grid), RANK), np.float32)
        for a in range(0, len(grid), 4096):
            part = grid[a : a + 4096]
            own = self.weighted[part[:, 0]]
            for j in range(1, STEP):
                own += self.weighted[part[:, j]]
            sums[a : a + 4096] = own
        norms = self.square[grid].sum(1)
        step_doc = np.repeat(np.arange(len(lengths)), steps)
        size = 1
        while size < SCALES[-1]:
            # Windows of twice the size; the empty steps between documents keep them apart.
            half = size
            sums = sums[:-half] + sums[half:]
            norms = norms[:-half] + norms[half:]
            size *= 2
            items = self.by_scale.get(size, [])
            if not len(items):
                continue
            inside = (np.arange(len(sums)) - first_step[step_doc[: len(sums)]]) % (size // 2) == 0
            at = np.flatnonzero(inside & (norms > 0))
            for a in range(0, len(at), 8192):
                own = at[a : a + 8192]
                cosine = (sums[own] @ self.z[items].T) / np.sqrt(norms[own])[:, None]
                r, c = np.nonzero(cosine >= COSINE)
                for row, k, value in zip(own[r].tolist(), items[c].tolist(), cosine[r, c].tolist(), strict=True):
                    d = int(step_doc[row])
                    begin = (row - int(first_step[d])) * STEP
                    key = (d, self.owner[k])
                    if key in out and out[key][0] == len(self.passages[k]):
                        continue
                    # Around the window; one that begins before the text's first words is cut there.
                    lo, hi = max(0, begin - 2 * STEP), min(int(lengths[d]), begin + (size + 2) * STEP)
                    hit = self.judge(k, ids[starts[d] + lo : starts[d] + hi].tolist())
                    if hit and (key not in out or hit[0] > out[key][0]):
                        out[key] = (hit[0], len(self.passages[k]), value, hit[1], begin)
        return out


def _found(retrievals: list[Retrieval], ids: np.ndarray, lengths: np.ndarray) -> dict[tuple[int, int], tuple]:
    """The hits of several searches, the longest of each document and item."""
    out: dict[tuple[int, int], tuple] = {}
    for retrieval in retrievals:
        for key, hit in retrieval.search(ids, lengths).items():
            if key not in out or hit[0] > out[key][0]:
                out[key] = hit
    return out


def _prepared(docs: DataFrame, benchmark: DataFrame) -> list[list[Retrieval]]:
    """For each run the searches of its items."""
    items = [(r.item_id, r.text) for r in benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text is not null").orderBy("item_id", "text").collect()]
    if not items:
        return []
    df, n = frequencies(docs)
    passages = passages_of(items)[1]
    plain, idf = weights(df, n), weights(df, n, passages)
    few = [p for p in passages if few_weighted(plain, p)]
    idfs = [idf, raised(df, idf, few)] if few else [idf]
    wanted = [lambda _: True, lambda p: few_weighted(plain, p)]
    spaces = list(zip(idfs, latent_spaces(docs, [t for _, t in items], idfs, n), wanted, strict=False))
    return [[Retrieval(items[a : a + ITEMS], *space) for space in spaces] for a in range(0, len(items), ITEMS)]


SCHEMA = "doc_id bigint, item_id bigint, lcs int, item_words int, cosine double, answer_share double, first_word int"


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document row and benchmark item that it holds; clean documents have none."""
    own = docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
    found = None
    for retrievals in _prepared(docs, benchmark):

        def run(batches, retrievals=retrievals):
            words = Words()
            for cols, texts in text_chunks(batches, 1_000_000):
                hits = _found(retrievals, *words.of(texts))
                rows = [(cols["doc_id"][d], item, *x) for (d, item), x in sorted(hits.items())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int32()))],
                    names=["doc_id", "item_id", "lcs", "item_words", "cosine", "answer_share", "first_word"],
                )
            del words
            give_back()

        part = own.mapInArrow(run, SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, that hold no benchmark item."""
    for retrievals in _prepared(docs, benchmark):

        def run(batches, retrievals=retrievals):
            words = Words()
            for batch in batches:
                texts = [t or "" for t in batch.column(batch.schema.names.index("text")).to_pylist()]
                bad: set[int] = set()
                at, size = 0, 0
                for i, t in enumerate(texts):
                    size += len(t)
                    if size > 1_000_000 or i == len(texts) - 1:
                        bad |= {at + d for d, _ in _found(retrievals, *words.of(texts[at : i + 1]))}
                        at, size = i + 1, 0
                yield batch.filter(pa.array([i not in bad for i in range(len(texts))], pa.bool_()))
            del words
            give_back()

        docs = docs.mapInArrow(run, docs.schema)
    return docs
