"""Language-model scores by a weighted backoff automaton.

Training tokens are the words `[^\\x20\\x09-\\x0D]+` of the documents to learn from, with A-Z lower-cased,
and one end after each document. Unigrams are counted whatever the vocabulary's size, and smoothed with
0.5 a word. Every bigram and trigram of the training tokens is an arc, none is pruned. The model grows with
the corpus, so it is never in one place: documents are packed into blocks, each block lists its own distinct
n-grams as sorted 64-bit keys, and key ranges of all blocks meet to be summed and go back to the blocks that
asked. Each block so gets the part of the model that its own documents can reach. (Two n-grams share a key
with a chance of 2^-64 a pair.)

States are contexts (none, one word, two words). An arc carries the discounted log-probability of its
n-gram; where a state lacks the arc, its failure arc leads to the next shorter context and adds the
backoff weight that makes the probabilities of each state sum to one. The weight needs the number of
words that follow a context and the sum of their counts; these are summed over the blocks in the same way,
each n-gram being put in by the first block that learned it. As every n-gram is an arc, the state before
a token is the longest learned one of its last two words, so the arcs and failure arcs of all tokens of a
block are followed side by side, and a document's log10-probabilities are added up.

Null text counts as empty: the end alone. A null doc_id is scored, not learned from and not held out.
Repeated rows count as often as they stand there. An empty table gives an empty result. With nothing to
learn from, the vocabulary has the unknown word alone and every token gets probability one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import remainder, shuffles_dropped, stored, text_chunks

BLOCK_TOKENS = 700_000  #: a block of documents closes at so many tokens
PART_KEYS = 2_000_000  #: most keys, about, that meet in a key range
DISCOUNT = 0.5
END = b""  #: the end, which no word equals

_BLOCKS = "block bigint, doc_ids array<bigint>, learn array<boolean>, held_out array<boolean>, lengths array<bigint>, codes binary, words binary"


def blocks(docs: DataFrame) -> DataFrame:
    """Documents as blocks: token codes in the block's own vocabulary and its words, as they first occur."""
    out = pa.schema(
        [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("learn", pa.list_(pa.bool_())), ("held_out", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())), ("codes", pa.binary()), ("words", pa.binary())]
    )

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0

        def closed(rows, vocabulary, parts):
            codes = np.concatenate(parts)
            fields = [task * (1 << 32) + number, *([r[i] for r in rows] for i in range(4)), zlib.compress(codes.tobytes(), 1), zlib.compress(b" ".join(vocabulary), 1)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(fields, out, strict=True)], schema=out)

        vocabulary: dict[bytes, int] = {END: 0}
        rows, parts, size = [], [], 0
        for cols, texts in text_chunks(batches, 1_000_000):
            for doc, rest, t in zip(cols["doc_id"], cols["rest"], texts, strict=True):
                tokens = t.encode("utf-8", "surrogatepass").lower().split()
                add = vocabulary.setdefault
                codes = np.fromiter([*(add(w, len(vocabulary)) for w in tokens), 0], np.int32, len(tokens) + 1)
                rows.append((doc, rest is not None and rest != 1, rest == 1, len(codes)))
                parts.append(codes)
                size += len(codes)
                if size >= BLOCK_TOKENS:
                    yield closed(rows, vocabulary, parts)
                    vocabulary, rows, parts, size, number = {END: 0}, [], [], 0, number + 1
        if rows:
            yield closed(rows, vocabulary, parts)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", remainder("doc_id", 5).alias("rest")).mapInArrow(run, _BLOCKS)


def _list(data: bytes) -> list[bytes]:
    return zlib.decompress(data).split(b" ")


def _planes(a: np.ndarray) -> bytes:
    """Eight-byte numbers as their first bytes, second bytes and so on, which Spark's compression shortens."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes()


def _small(a: np.ndarray) -> bytes:
    return zlib.compress(_planes(a), 1)


def _numbers(data: bytes, kind=np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Keys of n-grams from those of the context and of the word."""
    z = (x * np.uint64(0x9E3779B97F4A7C15)) ^ (y + np.uint64(0xD1B54A32D192ED03))
    z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return z ^ (z >> np.uint64(32))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the place of each key among them."""
    order = np.argsort(keys)
    ranked = keys[order]
    first = np.ones(len(keys), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=first[1:])
    at = np.empty(len(keys), np.int32)
    at[order] = np.cumsum(first, dtype=np.int32) - 1
    return ranked[first], at


class Grams:
    """A block's distinct n-grams and which of them each token completes: words and bigrams sorted by key, then trigrams sorted by key.

    ``orders`` says which of the two parts are worked out; the other is left empty.
    """

    def __init__(self, row: dict, orders: tuple[int, ...] = (2, 3)):
        self.lengths = np.array(row["lengths"], np.int64)
        self.codes = codes = np.frombuffer(zlib.decompress(row["codes"]), np.int32)
        words = _list(row["words"])
        own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.within = np.arange(len(codes), dtype=np.int32) - np.repeat(self.starts, self.lengths)
        two = np.flatnonzero(self.within >= 1)
        pairs = _joined(own[codes[two - 1]], own[codes[two]])
        self.one, self.two, self.three = (np.full(len(codes), -1, np.int32) for _ in range(3))
        low, high, order, token = np.zeros(0, np.uint64), np.zeros(0, np.uint64), [], []
        if 2 in orders:
            low, at = _distinct(np.concatenate([own, pairs]))
            self.one, self.two[two] = at[: len(own)][codes], at[len(own) :]
            order.append(np.ones(len(low), np.int8))
            token.append(np.zeros(len(low), np.int32))
            order[0][self.two[two]], token[0][self.two[two]] = 2, two
        if 3 in orders:
            three = np.flatnonzero(self.within >= 2)
            every = np.zeros(len(codes), np.uint64)
            every[two] = pairs
            high, at = _distinct(_joined(every[three - 1], own[codes[three]]))
            self.three[three] = at + len(low)
            order.append(np.full(len(high), 3, np.int8))
            token.append(np.zeros(len(high), np.int32))
            token[-1][at] = three
        self.keys, self.split = np.concatenate([low, high]), len(low)
        self.order = np.concatenate([np.zeros(0, np.int8), *order])
        self.token = np.concatenate([np.zeros(0, np.int32), *token])  #: one token that completes the n-gram

    def learned(self, learn: list[bool]) -> np.ndarray:
        """Training counts of the n-grams within the block."""
        on = np.repeat(np.array(learn, bool), self.lengths)
        return sum(np.bincount(at[on & (at >= 0)], minlength=len(self.keys)) for at in (self.one, self.two, self.three))

    def followers(self, totals: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each n-gram as a context: the words known to follow it by n-grams in ``first``, and the sum of the counts that they have in the next shorter context."""
        n, s = np.zeros(len(self.keys), np.int64), np.zeros(len(self.keys), np.int64)
        for order, context, shorter in ((2, self.one, self.one), (3, self.two, self.two)):
            i = self.token[first & (self.order == order)]
            n += np.bincount(context[i - 1], minlength=len(n))
            s += np.bincount(context[i - 1], weights=totals[shorter[i]], minlength=len(n)).astype(np.int64)
        return n, s

    def failing(self, totals: np.ndarray) -> np.ndarray:
        """Which n-grams are contexts whose failure arc some token of the block takes."""
        out = np.zeros(len(self.keys), bool)
        for at, context, on in ((self.two, self.one, self.within >= 1), (self.three, self.two, self.within >= 2)):
            i = np.flatnonzero(on)
            out[context[i[totals[at[i]] == 0] - 1]] = True
        return out & (totals > 0)

    def scores(self, totals: np.ndarray, n: np.ndarray, s: np.ndarray, denominator: float) -> tuple[np.ndarray, np.ndarray]:
        """log10-probabilities of the tokens at the state without context, and at their own states."""
        c = np.maximum(totals, 1)
        # What a state's arcs leave over, and what the same words leave over in the next shorter context.
        low = np.where(self.order == 1, (s + 0.5 * n) / denominator, (s - DISCOUNT * n) / c[self.one[self.token]])
        fail = np.where(n > 0, np.log10(np.maximum(DISCOUNT * n / c, 1e-9) / np.maximum(1 - low, 1e-9)), 0.0)
        base = np.log10((totals[self.one] + 0.5) / denominator)
        p = base.copy()
        for at, context, on in ((self.two, self.one, self.within >= 1), (self.three, self.two, self.within >= 2)):
            i = np.flatnonzero(on)
            i = i[totals[context[i - 1]] > 0]
            arc, state = totals[at[i]], context[i - 1]
            p[i] = np.where(arc > 0, np.log10(np.maximum(arc - DISCOUNT, DISCOUNT) / c[state]), fail[state] + p[i])
        return base, p


def _rows(block: int, keys: np.ndarray, columns: list[np.ndarray], ranges: int, start: int = 0) -> pa.RecordBatch:
    """Sorted keys and their figures, a row for each range of keys; the ranges are numbered from ``start``."""
    edges = [0, *np.searchsorted(keys, np.arange(1, ranges, dtype=np.uint64) * np.uint64((1 << 64) // ranges)).tolist(), len(keys)]
    parts = [(k, a, b) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
    fields = [[_planes(np.diff(keys[a:b], prepend=np.uint64(0))) for _, a, b in parts], *([_small(c[a:b]) for _, a, b in parts] for c in columns)]
    return pa.RecordBatch.from_arrays([pa.array([start + k for k, _, _ in parts], pa.int32()), pa.array([block] * len(parts), pa.int64()), *(pa.array(f, pa.binary()) for f in fields)], names=["part", "block", "keys", "x", "y"][: 3 + len(columns)])


def _met(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each key of a range's rows stands among its distinct keys, the blocks that hold it, and where rows end."""
    keys = [np.cumsum(_numbers(k, np.uint64), dtype=np.uint64) for k in table.column("keys").to_pylist()]
    _, at = _distinct(np.concatenate(keys))
    return at, np.bincount(at), np.cumsum([len(k) for k in keys])[:-1]


def _back(table: pa.Table, new: int, *columns: list[np.ndarray]) -> pa.Table:
    x, y = (pa.array([_small(np.ascontiguousarray(v)) for v in c], pa.binary()) for c in columns)
    return pa.table({"block": table.column("block"), "part": table.column("part"), "x": x, "y": y, "new": pa.array([new, *[0] * (len(table) - 1)], pa.int64())})


_RANGES = "block bigint, part int, x binary, y binary, new bigint"


def _added_counts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Training counts over all blocks (x); whether several blocks have the key (2), and whether a block is the first that learned it (1) (y)."""
    at, blocks_, ends = _met(table)
    own = np.concatenate([_numbers(zlib.decompress(x)) for x in table.column("x").to_pylist()])
    c, is_word = own >> 1, (own & 1) > 0
    totals = np.bincount(at, weights=c).astype(np.int64)
    learned = np.flatnonzero(c > 0)
    first = np.zeros(len(at), np.int64)
    first[learned[np.unique(at[learned], return_index=True)[1]]] = 1
    return _back(table, int(first[is_word].sum()), np.split(totals[at], ends), np.split((blocks_[at] > 1) * 2 + first, ends))


def _added_followers(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Followers and the sums of their counts over all blocks, for the keys that a block asked for."""
    at, _, ends = _met(table)
    x, y = (np.concatenate([_numbers(zlib.decompress(v)) for v in table.column(k).to_pylist()]) for k in ("x", "y"))
    asked = np.split(x & 1 > 0, ends)
    sums = (np.split(np.bincount(at, weights=v).astype(np.int64)[at], ends) for v in (x >> 1, y))
    return _back(table, 0, *([v[on] for v, on in zip(c, asked, strict=True)] for c in sums))


def _figures(rows_: pa.Table, step: int) -> list[np.ndarray]:
    """A block's two columns of a step, in the order of its keys."""
    rows = sorted((r for r in rows_.select(["step", "part", "x", "y"]).to_pylist() if r["step"] == step), key=lambda r: r["part"])
    return [np.concatenate([np.zeros(0, np.int64), *(_numbers(zlib.decompress(r[k])) for r in rows)]) for k in ("x", "y")]


class BackoffAutomaton:
    """States, arcs and failure arcs over word numbers; number 0 stands for every word that is in no kept n-gram.

    State 0 has no context, state v the context of word v, further states contexts of two words. `arcs` maps
    state * base + word to (next state, log10-probability); `fail` maps a state to (shorter state, log10 backoff weight).
    """

    def __init__(self, words: int, unigram: np.ndarray, pairs: dict[int, int], triples: dict[int, int], counts: np.ndarray):
        """unigram: log10-probabilities by word number; counts: training counts by word number, both for 1 to ``words``."""
        self.base = base = words + 1
        kept: dict[int, list[tuple[int, float]]] = {}
        for gram, c in pairs.items():
            kept.setdefault(gram // base, []).append((gram % base, (c - DISCOUNT) / counts[gram // base]))
        low = 10.0**unigram
        self.fail: dict[int, tuple[int, float]] = {}
        p2: dict[int, float] = {}
        for h, arcs in kept.items():
            left, other = 1 - sum(p for _, p in arcs), 1 - sum(low[w] for w, _ in arcs)
            alpha = max(left, 1e-9) / max(other, 1e-9)
            self.fail[h] = (0, float(np.log10(alpha)))
            p2.update({h * base + w: p for w, p in arcs})
        contexts: dict[int, list[tuple[int, float]]] = {}
        for gram, c in triples.items():
            if gram // base in pairs:
                contexts.setdefault(gram // base, []).append((gram % base, (c - DISCOUNT) / pairs[gram // base]))
        self.state = {h: words + 1 + i for i, h in enumerate(sorted(contexts))}
        self.arcs: dict[int, tuple[int, float]] = {}
        for gram, p in p2.items():
            self.arcs[gram] = (self.state.get(gram, gram % base), float(np.log10(p)))
        for h, arcs in contexts.items():
            s, shorter = self.state[h], h % base

            def lower(w: int, shorter: int = shorter) -> float:
                return p2.get(shorter * base + w) or low[w] * 10.0 ** self.fail.get(shorter, (0, 0.0))[1]

            left, other = 1 - sum(p for _, p in arcs), 1 - sum(lower(w) for w, _ in arcs)
            self.fail[s] = (shorter, float(np.log10(max(left, 1e-9) / max(other, 1e-9))))
            for w, p in arcs:
                self.arcs[s * base + w] = (self.state.get(shorter * base + w, w), float(np.log10(p)))

    def traverse(self, numbers: list[int], unigram: list[float]) -> float:
        """The log10-probability of a document; ``unigram`` has each token's own at state 0."""
        arcs, fail, base = self.arcs.get, self.fail.get, self.base
        state, total = 0, 0.0
        for w, p in zip(numbers, unigram, strict=True):
            if w:
                hit = arcs(state * base + w) if state else None
                while hit is None:
                    if not state:
                        hit = (w, p)
                        break
                    state, weight = fail(state, (0, 0.0))
                    total += weight
                    if state:
                        hit = arcs(state * base + w)
                state, p = hit
                total += p
            else:
                while state:
                    state, weight = fail(state, (0, 0.0))
                    total += weight
                total += p
        return total


def _stored_alone(df: DataFrame) -> DataFrame:
    """The frame stored; the files of the shuffles that led to it are dropped."""
    with shuffles_dropped(df.sparkSession):
        return stored(df)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    own = stored(blocks(docs))
    sums = own.select(F.explode(F.arrays_zip("learn", "lengths")).alias("d")).agg(F.sum(F.when(F.col("d.learn"), F.col("d.lengths"))), F.sum("d.lengths")).first()
    n, tokens = sums[0] or 0, sums[1] or 0
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * tokens // PART_KEYS))

    def counted(order: int) -> DataFrame:
        """Counts of words and bigrams (2) or of trigrams (3) over all blocks, by block. One after the other, they need half the disk at once."""

        def counts(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    grams = Grams(row, (order,))
                    yield _rows(row["block"], grams.keys, [grams.learned(row["learn"]) * 2 + (grams.order == 1)], ranges, ranges * (order - 2))

        rows = own.select("block", "learn", "lengths", "codes", "words").mapInArrow(counts, "part int, block bigint, keys binary, x binary")
        return _stored_alone(rows.groupBy("part").applyInArrow(_added_counts, _RANGES))

    learned = counted(2).unionByName(counted(3))
    denominator = n + 0.5 * ((learned.agg(F.sum("new")).first()[0] or 0) + 1)
    # Blocks (step 0) and their counts (step 1) in one frame, so that both steps below share one shuffle.
    pool = own.withColumn("step", F.lit(0)).unionByName(learned.select("block", "part", "x", "y", F.lit(1).alias("step")), allowMissingColumns=True)

    def block_row(rows: pa.Table) -> dict:
        return rows.filter(pa.compute.equal(rows.column("step"), 0)).drop_columns(["part", "x", "y"]).to_pylist()[0]

    def ask(key: tuple[pa.Scalar, ...], left: pa.Table) -> pa.Table:
        grams = Grams(block_row(left))
        totals, flags = _figures(left, 1)
        followers, needed = grams.followers(totals, flags % 2 == 1), grams.failing(totals)
        # The followers of what only one block has are all in that block.
        at = np.flatnonzero(((flags >= 2) & (needed | (followers[0] > 0)))[: grams.split])
        return pa.Table.from_batches([_rows(key[0].as_py(), grams.keys[at], [followers[0][at] * 2 + needed[at], followers[1][at]], ranges)])

    asked = pool.groupBy("block").applyInArrow(ask, "part int, block bigint, keys binary, x binary, y binary")
    followed = asked.groupBy("part").applyInArrow(_added_followers, _RANGES).select("block", "part", "x", "y", F.lit(2).alias("step"))

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        row = block_row(left)
        grams = Grams(row)
        totals, flags = _figures(left, 1)
        followers = grams.followers(totals, flags % 2 == 1)
        at = np.flatnonzero(((flags >= 2) & grams.failing(totals))[: grams.split])
        for own_, every in zip(followers, _figures(right, 2), strict=True):
            own_[at] = every
        base, p = grams.scores(totals, *followers, denominator)
        known, base, p = (np.add.reduceat(v, grams.starts) for v in ((totals[grams.one] > 0).astype(np.int64), base, p))
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        names = ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")
        return pa.table({k: pa.array(f, t) for k, f, t in zip(names, (row["doc_ids"], row["held_out"], row["lengths"], known, base, p), kinds, strict=True)})

    scored = pool.groupBy("block").cogroup(followed.groupBy("block")).applyInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")
