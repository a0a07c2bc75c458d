"""Approximate nearest neighbours by multi-index hashing over learned binary codes.

Codes: vectors are centred and turned by two learned rotations (principal axes, then iterative
quantisation from different starts); the signs give 2 x d bits, at least 64. Each code is split into
substrings of about log2(N) bits. An index row of a code goes, for each substring, to the part that the
substring's first bits name; a query goes to the parts whose first bits are near enough to its own. So
only rows that can share a bucket meet, and nothing is compared with the whole table.

Radius: a query's k-th nearest code, and the slack that this distance needs so that `CAUGHT` of the true
neighbours lie within, learned on the fitting sample. The k-th nearest is taken among the sample's codes
and, where that leaves more than one bit a substring to flip, among the buckets that the query itself
falls into, so the radius grows no further than the index needs. By the pigeonhole principle a code
within radius r agrees with the query in some substring j up to t(j) bits, where the t(j) + 1 add up to
r + 1; probing all buckets that near retrieves every code within the radius, each once (at the first such
substring). Those are ranked by the exact distance of the vectors.

Buckets of a part are found by writing out the values within t(j), or by comparing with the part's list
of buckets if that is shorter; both give the same buckets. On data without structure the radius is two
fifths of the bits, and most buckets are that near; on clustered data few are.

The rotations are fitted on a bounded, documented sample (at most `SAMPLE` vectors, by a hash of the id);
every vector is indexed. Vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, neither as queries nor as candidates. Ties go to the smaller id.
Fewer candidates than k give fewer rows; an empty table gives an empty result. Exact repeats of a row
count once; rows of one id with different vectors are candidates of their own, and that id is searched
by the least of its vectors. A query's own id never is its candidate. Of equal vectors only the k + 1
smallest ids are indexed, as no other can be among the nearest. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import cut, shuffles_dropped, stored

SAMPLE = 8192
CAUGHT = 0.97  #: share of the sample's true neighbours that the slack of the radius lets in
PART = 16_384  #: codes of a part; one with over four times as many is dealt over several cells
PAIRS = 50_000  #: pairs whose distances are worked out at once
SALT = 8
NOBODY = -(1 << 63)  #: stands for no id


def _masks(bits: int, most: int) -> np.ndarray:
    """All values of so many bits with at most ``most`` ones, fewest ones first."""
    return np.array([sum(1 << b for b in c) for n in range(min(bits, most) + 1) for c in itertools.combinations(range(bits), n)], np.int64)


def _volume(bits: int, most: int) -> int:
    return sum(math.comb(bits, n) for n in range(min(bits, most) + 1))


class Codes:
    """Learned rotations, the binary codes that they give, and their substrings."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, total: int, k: int = 10, rounds: int = 25):
        rng = np.random.default_rng(5)
        self.mean = sample.mean(0)
        x = sample - self.mean
        _, _, axes = np.linalg.svd(x, full_matrices=False)
        d = x.shape[1]
        axes = np.vstack([axes, np.zeros((d - len(axes), d))])
        p = x @ axes.T
        self.turns = []
        for _ in range(max(2, -(-64 // d))):
            r, _ = np.linalg.qr(rng.normal(size=(d, d)))
            for _ in range(rounds):
                u, _, v = np.linalg.svd(np.sign(p @ r).T @ p)
                r = (u @ v).T
            self.turns.append(axes.T @ r)
        self.bits = d * len(self.turns)
        self.size = -(-self.bits // 64) * 8  #: bytes of a code
        own = min(32, max(8, math.ceil(math.log2(max(total, 2)))))
        edges = np.linspace(0, self.bits, -(-self.bits // own) + 1).astype(int).tolist()
        self.subs = list(itertools.pairwise(edges))
        self.high = [min(b - a, max(0, math.ceil(math.log2(max(total, 1) / PART)))) for a, b in self.subs]
        self.ids, self.sample, self.k = ids, self.encode(sample), k
        self.slack = self._learned_slack(sample)

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes as rows of 64-bit words."""
        packed = np.packbits(np.hstack([(x - self.mean) @ r > 0 for r in self.turns]), axis=1, bitorder="little")
        return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, self.size - packed.shape[1])))).view("<u8")

    def value(self, codes: np.ndarray, j: int) -> np.ndarray:
        """Substring j of each code as a number."""
        a, b = self.subs[j]
        out = codes[:, a // 64] >> np.uint64(a % 64)
        if b > (a // 64 + 1) * 64:
            out = out | codes[:, a // 64 + 1] << np.uint64(64 - a % 64)
        return (out & np.uint64((1 << (b - a)) - 1)).astype(np.int64)

    def prefix(self, value: np.ndarray, j: int) -> np.ndarray:
        a, b = self.subs[j]
        return value >> (b - a - self.high[j])

    def thresholds(self, radius: np.ndarray) -> np.ndarray:
        """For each radius the bits that each substring may differ by (-1: it need not be looked at)."""
        m = len(self.subs)
        return (radius[:, None] + 1) // m + (np.arange(m) < (radius[:, None] + 1) % m) - 1

    def _learned_slack(self, sample: np.ndarray) -> int:
        n, k = len(sample), min(self.k, len(sample) - 1)
        slack = [0]
        for q in range(0, n, max(1, n // 200)) if k else []:
            far = ((sample - sample[q]) ** 2).sum(1)
            far[q] = np.inf
            h = np.bitwise_count(self.sample ^ self.sample[q]).sum(1).astype(np.int64)
            h[q] = self.bits + 1
            slack += (h[np.argpartition(far, k - 1)[:k]] - np.partition(h, k - 1)[k - 1]).tolist()
        return max(0, math.ceil(float(np.quantile(slack, CAUGHT))))

    def radius(self, codes: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Each query's radius by the sample; a query's own rows do not count."""
        out = np.full(len(codes), self.bits, np.int64)
        for i, code in enumerate(codes):
            h = np.bitwise_count(self.sample[self.ids != own[i]] ^ code).sum(1)
            if len(h) > self.k:
                out[i] = min(self.bits, int(np.partition(h, self.k)[self.k]) + self.slack)
        return out


class PartIndex:
    """The buckets of one substring among the codes of one part, that is, codes of one prefix."""

    def __init__(self, codes: Codes, part: int, words: np.ndarray, ids: np.ndarray, vectors: np.ndarray | None):
        self.codes, self.j = codes, part >> 40
        self.a_prefix = part & ((1 << 40) - 1)
        value = codes.value(words, self.j)
        order = np.lexsort((ids, value))
        self.words, self.ids, self.vectors = words[order], ids[order], None if vectors is None else vectors[order]
        self.buckets, first = np.unique(value[order], return_index=True)
        self.first = np.append(first, len(value))
        a, b = codes.subs[self.j]
        self.low = b - a - codes.high[self.j]
        self.sub_words = [sum(((np.uint64(1) << np.uint64(x % 64)) * (np.arange(words.shape[1]) == x // 64).astype(np.uint64) for x in range(*s)), np.zeros(words.shape[1], np.uint64)) for s in codes.subs[: self.j]]
        self.looked = 0  #: pairs of a query and a code in a bucket probed for it

    def pairs(self, words: np.ndarray, radius: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Queries' numbers, codes' positions and Hamming distances of all pairs within the radius that meet here first."""
        limits = self.codes.thresholds(radius)
        value = self.codes.value(words, self.j)
        rest = limits[:, self.j] - np.bitwise_count(self.codes.prefix(value, self.j) ^ self.a_prefix)
        for r in np.unique(rest[rest >= 0]).tolist():
            group = np.flatnonzero(rest == r)
            flips = _masks(self.low, r) if _volume(self.low, r) <= len(self.buckets) else None
            step = max(1, 1_000_000 // max(len(self.ids), 1))
            for s in range(0, len(group), step):
                q = group[s : s + step]
                if flips is not None:
                    wanted = (self.a_prefix << self.low | (value[q] & ((1 << self.low) - 1)))[:, None] ^ flips
                    at = np.minimum(np.searchsorted(self.buckets, wanted), len(self.buckets) - 1)
                    row, col = np.nonzero(self.buckets[at] == wanted)
                    bucket = at[row, col]
                else:
                    row, bucket = np.nonzero(np.bitwise_count(self.buckets ^ value[q][:, None]) <= limits[q, self.j][:, None])
                n = self.first[bucket + 1] - self.first[bucket]
                self.looked += int(n.sum())
                who = np.repeat(q[row], n)
                at = np.repeat(self.first[bucket] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                differ = self.words[at] ^ words[who]
                h = np.bitwise_count(differ).sum(1).astype(np.int64)
                keep = (h <= radius[who]) & (self.ids[at] != own[who])
                who, at, h, differ = who[keep], at[keep], h[keep], differ[keep]
                new = np.ones(len(who), bool)
                for i, mask in enumerate(self.sub_words):
                    new &= np.bitwise_count(differ & mask).sum(1) > limits[who, i]
                yield who[new], at[new], h[new]

    def nearest(self, words: np.ndarray, radius: np.ndarray, own: np.ndarray, vectors: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries' numbers, ids and distances of the k nearest retrieved of each query; Hamming distances without vectors."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for who, at, h in self.pairs(words, radius, own):
            if vectors is None:
                far = h.astype(np.float64)
            else:
                far = np.empty(len(who))
                for s in range(0, len(who), PAIRS):
                    gap = self.vectors[at[s : s + PAIRS]].astype(np.float64) - vectors[who[s : s + PAIRS]].astype(np.float64)
                    far[s : s + PAIRS] = np.sqrt((gap**2).sum(1))
            found.append(best_of(who, self.ids[at], far, k))
        who, ids, far = (np.concatenate(x) for x in zip(*found, strict=True))
        return best_of(who, ids, far, k)


def best_of(who: np.ndarray, ids: np.ndarray, far: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of each query, ties to the smaller id."""
    order = np.lexsort((ids, far, who))
    who, ids, far = who[order], ids[order], far[order]
    first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]])) if len(who) else np.zeros(0, np.int64)
    keep = np.arange(len(who)) - np.repeat(first, np.diff(np.append(first, len(who)))) < k
    return who[keep], ids[keep], far[keep]


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of numbers as binary values."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32)), pa.py_buffer(rows)])


def _rows(column: pa.Array, kind) -> np.ndarray:
    """Binary values of one length as rows of numbers."""
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[edges[0] : edges[-1]].reshape(len(column), -1).view(kind)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and v of the vectors that take part, but for their length; single precision stays single."""
    kind = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast(kind).alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0)
    )


def encoded(rows: DataFrame, codes: Codes) -> DataFrame:
    """The rows with their vectors as bytes and their codes."""

    def run(batches):
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column(batch.schema.names.index("v")))
                others = [n for n in batch.schema.names if n != "v"]
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(n)) for n in others), _binary(x), _binary(codes.encode(x.astype(np.float64)))], names=[*others, "vec", "code"])

    others = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "v")
    return rows.mapInArrow(run, f"{others}, vec binary, code binary")


_MEET = "part bigint, kind int, id bigint, own bigint, radius int, code binary, vec binary"


def _meeting(fields: list, vec: pa.Array | None) -> pa.RecordBatch:
    part, kind, ids, own, radius, code = fields
    arrays = [pa.array(part, pa.int64()), pa.array(np.full(len(part), kind), pa.int32()), pa.array(ids, pa.int64()), pa.array(own, pa.int64()), pa.array(radius, pa.int32()), _binary(code)]
    return pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(part), pa.binary()) if vec is None else vec], names=["part", "kind", "id", "own", "radius", "code", "vec"])


def _indexed(batch: pa.RecordBatch, codes: Codes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    words = _rows(batch.column("code"), "<u8")
    for j in range(len(codes.subs)):
        yield words, j << 40 | codes.prefix(codes.value(words, j), j)


def probe(index: DataFrame, queries: DataFrame, codes: Codes, k: int, by_vector: bool) -> DataFrame:
    """id (of the query), vec_id and far of the k nearest retrieved of each query in each cell.

    ``index`` has vec_id, code and vec; ``queries`` has id, own (an id that is no candidate), radius, code and vec.
    The rows of a cell reach a task in order, index first, so a task holds one cell's index and streams the queries.
    """

    def deal_index(batches):
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            for words, part in _indexed(batch, codes):
                yield _meeting([part, 0, ids, np.full(len(ids), NOBODY), np.zeros(len(ids)), words], batch.column("vec") if by_vector else None)

    def deal_queries(batches):
        for batch in batches:
            words, ids, own, radius = _rows(batch.column("code"), "<u8"), *(batch.column(n).to_numpy() for n in ("id", "own", "radius"))
            limits = codes.thresholds(radius.astype(np.int64))
            for j in range(len(codes.subs)):
                prefix = codes.prefix(codes.value(words, j), j)
                for t in np.unique(limits[:, j][limits[:, j] >= 0]).tolist():
                    group, flips = np.flatnonzero(limits[:, j] == t), _masks(codes.high[j], t)
                    step = max(1, 10_000 // len(flips))
                    for s in range(0, len(group), step):
                        at = np.repeat(group[s : s + step], len(flips))
                        for a in range(0, len(at), 10_000):
                            own_at = at[a : a + 10_000]
                            part = j << 40 | (prefix[own_at] ^ np.resize(flips, len(at))[a : a + 10_000])
                            yield _meeting([part, 1, ids[own_at], own[own_at], radius[own_at], words[own_at]], batch.column("vec").take(pa.array(own_at)) if by_vector else None)

    def count(batches):
        total: dict[int, int] = {}
        for batch in batches:
            for _, part in _indexed(batch, codes):
                for p, n in zip(*(x.tolist() for x in np.unique(part, return_counts=True)), strict=True):
                    total[p] = total.get(p, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["part", "n"])

    # Parts of many times the usual size (of dense clusters) are fewer than codes / PART, so they may be broadcast.
    large = index.select("code").mapInArrow(count, "part bigint, n bigint").groupBy("part").agg(F.sum("n").alias("n")).filter(F.col("n") > 4 * PART)
    large = cut(large.select("part", F.ceil(F.col("n") / PART).cast("int").alias("cells")))
    left = index.select("vec_id", "code", "vec").mapInArrow(deal_index, _MEET).join(F.broadcast(large), "part", "left")
    right = queries.select("id", "own", F.col("radius").cast("int").alias("radius"), "code", "vec").mapInArrow(deal_queries, _MEET).join(F.broadcast(large), "part", "left")
    cells = F.coalesce("cells", F.lit(1))
    left = left.withColumn("cell", F.pmod(F.xxhash64("id", "code"), cells).cast("int")).drop("cells")
    right = right.withColumn("cell", F.explode(F.sequence(F.lit(0), cells - 1))).drop("cells")

    def search(batches):
        now, held, index = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy() for n in ("part", "cell", "kind")], 1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in itertools.pairwise(edges):
                part, cell, kind = keys[a].tolist() if b > a else (None, None, None)
                rows = batch.slice(a, b - a)
                if b == a:
                    continue
                if (part, cell) != now:
                    now, held, index = (part, cell), [], None
                if kind == 0:
                    held.append(rows)
                    continue
                if index is None and held:
                    whole = pa.Table.from_batches(held).combine_chunks().to_batches()
                    columns = [np.concatenate([get(w) for w in whole]) for get in (lambda w: _rows(w.column("code"), "<u8"), lambda w: w.column("id").to_numpy(), *([lambda w: _vectors(w)] if by_vector else []))]
                    index, held = PartIndex(codes, part, *columns, *([] if by_vector else [None])), []
                if index is not None:
                    who, ids, far = index.nearest(_rows(rows.column("code"), "<u8"), rows.column("radius").to_numpy().astype(np.int64), rows.column("own").to_numpy(), _vectors(rows) if by_vector else None, k)
                    yield pa.RecordBatch.from_arrays([pa.array(rows.column("id").to_numpy()[who]), pa.array(ids), pa.array(far)], names=["id", "vec_id", "far"])

    kind = "<f4" if index.schema["single"].dataType.simpleString() == "float" else "<f8"

    def _vectors(batch: pa.RecordBatch) -> np.ndarray:
        return _rows(batch.column("vec"), kind)

    met = left.unionByName(right).repartition("part", "cell").sortWithinPartitions("part", "cell", "kind")
    return met.mapInArrow(search, "id bigint, vec_id bigint, far double")


def _grown(queries: DataFrame, index: DataFrame, codes: Codes, k: int) -> DataFrame:
    """The queries; a wide radius by the sample falls to what the buckets that the query itself falls into call for."""
    wide = F.col("radius") >= 2 * len(codes.subs)
    near = probe(index, queries.filter(wide).withColumn("radius", F.lit(len(codes.subs) - 1)), codes, k + 1, False)
    place = F.row_number().over(Window.partitionBy("id").orderBy("far"))
    near = near.withColumn("place", place).filter(F.col("place") == k + 1).select(F.col("id").alias("id_"), (F.col("far") + codes.slack).cast("int").alias("nearer"))
    with shuffles_dropped(queries.sparkSession):
        return stored(queries.join(near, queries.id == F.col("id_"), "left").select("id", "own", "code", "vec", F.least("radius", "nearer").alias("radius")))


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found to each row whose id ``every`` divides, among all others."""
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    d, total = lengths[0]
    rows = rows.filter(F.size("v") == d).dropDuplicates(["vec_id", "v"])
    draw = F.xxhash64(F.lit("codes"), "vec_id")
    likely = F.pmod(draw, F.lit(1_000_000)) < int(min(1.0, 2 * SAMPLE / total) * 1_000_000 + 0.5)
    sample = (rows.filter(likely) if total > 2 * SAMPLE else rows).orderBy(draw, "vec_id", "v").limit(SAMPLE).collect()
    if not sample:
        sample = rows.orderBy(draw, "vec_id", "v").limit(SAMPLE).collect()
    codes = Codes(np.array([r.v for r in sample], np.float64), np.array([r.vec_id for r in sample], np.int64), total, k)
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    kept = rows.withColumn("nth", nth).filter(F.col("nth") <= k + 1).select("vec_id", "v", F.element_at("v", 1).alias("single"))
    index = stored(encoded(kept, codes))

    # Queries of equal vectors are searched once; an id of several vectors is searched on its own, without its own rows.
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("n"))
    own = F.when(F.col("n") > 1, F.col("vec_id")).otherwise(F.lit(NOBODY))
    asked = asked.select("vec_id", "v", own.alias("own"), F.xxhash64("v").alias("x"), F.xxhash64(F.lit(1), "v").alias("y"))
    searched = stored(encoded(asked.groupBy("x", "y", "own").agg(F.min("vec_id").alias("id"), F.min("v").alias("v")), codes))

    def first_radius(batches):
        for batch in batches:
            r = codes.radius(_rows(batch.column("code"), "<u8"), batch.column("own").to_numpy()) if len(batch) else []
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("id", "own", "code", "vec")), pa.array(r, pa.int32())], names=["id", "own", "code", "vec", "radius"])

    queries = searched.select("id", "own", "code", "vec").mapInArrow(first_radius, "id bigint, own bigint, code binary, vec binary, radius int")
    if total > SAMPLE:  # else the sample has every code, and no bucket a nearer one
        queries = _grown(stored(queries), index, codes, k)
    found = probe(index, queries, codes, k + 1, True)
    place = F.row_number().over(Window.partitionBy("id").orderBy("far", "vec_id"))
    found = found.withColumn("place", place).filter(F.col("place") <= k + 1).select("id", "vec_id", "far")
    found = searched.select("id", "x", "y", "own").join(found, "id").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))).drop("id")
    given = asked.select(F.col("vec_id").alias("query_id"), "x", "y", "own", F.pmod(F.xxhash64("vec_id"), F.lit(SALT)).cast("int").alias("salt"))
    out = given.join(found, ["x", "y", "own", "salt"]).filter(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("far", "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("far").alias("score"))
