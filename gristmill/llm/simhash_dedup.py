"""Near duplicates by SimHash, searched with the generalised pigeonhole principle.

Fingerprints: A-Z lower-cased, words `[^\\x20\\x09-\\x0D]+`, 4-word shingles with repeats (fewer words: the
whole sequence; none: fingerprint zero), XXH64 with seed 42 of each; a bit is one if it is set in over
half of the hashes. Fingerprints link at `BITS` or fewer differing bits; classes are the connected parts.

Search: copies fall together first, so only distinct fingerprints are compared. Correlated bits are
grouped into partitions; a dynamic programme gives every partition its own threshold T (-1: not used),
with sum(T + 1) = BITS + 1, so that any linked pair is within T bits in some partition; it minimises
rows to probe plus candidate pairs, estimated from all fingerprints' number and a bounded sample's
distances, over several numbers of partitions. Each fingerprint is indexed by its value in every used
partition and probes the values within T. Buckets are compared in full, verified, and passed on as
stars (one link less than members), never as all pairs; very large buckets are dealt over several tasks.

A null text counts as empty, so all texts without a word are one class. Repeated rows are rows of one
class. component_id ignores null ids (null if a class has no other). An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gristmill.llm.common import cut, give_back, map_texts, stored, text_chunks

BITS = 4
SHINGLE = 4
SAMPLE = 3000  #: fingerprints whose distances the estimates use
ROW_COST, PAIR_COST = 3e-6, 2e-8  #: seconds for a probed row and for a candidate pair
HOT_SHARE = 10_000  #: a fingerprint with over 1 / HOT_SHARE of all rows has its class broadcast; there are fewer than HOT_SHARE of them
BUCKET = 20_000  #: members of a bucket that one task compares; a larger one is dealt over more


def fingerprints_of(texts: list[str]) -> np.ndarray:
    """Fingerprints of whole texts, as unsigned 64-bit integers."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        words = t.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            continue
        line = b" ".join(words)
        if len(words) <= SHINGLE:
            hashes.append(digest(line, 42))
            counts[k] = 1
            continue
        ends = list(itertools.accumulate(len(w) + 1 for w in words))
        starts = [0, *ends]
        hashes += [digest(line[a : b - 1], 42) for a, b in zip(starts, ends[SHINGLE - 1 :], strict=False)]
        counts[k] = len(words) - SHINGLE + 1
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(counts) - counts)[full]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > counts[full, None], axis=1, bitorder="little").reshape(-1).view("<u8")
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (signed) of every row."""

    def make():
        return lambda cols, texts: {"doc_id": cols["doc_id"], "fp": fingerprints_of(texts).view(np.int64)}

    return map_texts(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), "doc_id bigint, fp bigint", make, max_chars=1_000_000)


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how often each two bits are set together, over all of them."""

    def run(batches):
        total, n = np.zeros((64, 64), np.int64), 0
        for batch in batches:
            x = batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(x, axis=1, bitorder="little").astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, 4096)), pa.array(np.concatenate([[n], total.ravel()]))], names=["k", "c"])

    rows = fps.select("fp").mapInArrow(run, "k bigint, c bigint").groupBy("k").agg(F.sum("c").alias("c")).collect()
    got = np.zeros(4097, np.int64)
    for r in rows:
        got[r.k + 1] = r.c
    return int(got[0]), got[1:].reshape(64, 64)


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in groups of nearly equal size, each bit with those it is most correlated with."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(64)), []
    for k in range(parts):
        size = 64 // parts + (k < 64 % parts)
        own = [max(sorted(free), key=lambda b: corr[b, sorted(free)].sum())]
        free.discard(own[0])
        while len(own) < size:
            b = max(sorted(free), key=lambda b: corr[b, own].sum())
            own.append(b)
            free.discard(b)
        groups.append(sorted(own))
    return groups


def value_of(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def plan(n: int, together: np.ndarray, sample: np.ndarray, bits: int = BITS) -> tuple[float, list[tuple[list[int], int]]]:
    """Estimated seconds, and partitions with thresholds, by dynamic programming for each number of partitions."""
    ones = np.diag(together) / max(n, 1)
    same = np.clip(ones**2 + (1 - ones) ** 2, 0.5, 1)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    i, j = np.triu_indices(len(sample), 1)
    for parts in range(2, bits + 2):
        groups = group_bits(n, together, parts)
        costs = []
        for own in groups:
            # Chance of t differing bits: by independent bits, or as seen in the sample if that is more.
            chance = np.zeros(bits + 1)
            chance[0] = 1.0
            for b in own:
                chance = chance * same[b] + np.concatenate([[0], chance[:-1]]) * (1 - same[b])
            if len(i):
                v = value_of(sample, own)
                seen = np.bincount(np.minimum(np.bitwise_count(v[i] ^ v[j]), bits + 1), minlength=bits + 2)[: bits + 1] / len(i)
                chance = np.maximum(chance, np.where(seen * len(i) >= 3, seen, 0))
            probes = np.cumsum([math.comb(len(own), t) for t in range(bits + 1)])
            costs.append([0.0, *(n * probes * ROW_COST + n * n / 2.0 * np.cumsum(chance) * PAIR_COST).tolist()])
        # table[s]: least cost of partitions so far with sum(T + 1) = s, and the thresholds.
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for own_costs in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for s, (c, ts) in table.items():
                for t1, more in enumerate(own_costs):
                    if s + t1 <= bits + 1 and (s + t1 not in step or c + more < step[s + t1][0]):
                        step[s + t1] = (c + more, [*ts, t1 - 1])
            table = step
        cost, ts = table[bits + 1]
        if best is None or cost < best[0]:
            best = cost, [(g, t) for g, t in zip(groups, ts, strict=True) if t >= 0]
    return best


def _labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest member of each node's connected part."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        on = label[a] != label[b]
        a, b = a[on], b[on]
    while True:
        step = label[label]
        if (step == label).all():
            return label
        label = step


def stars(bucket: np.ndarray, fp: np.ndarray, probe: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a task's buckets, linked within them, as stars: members and their centres."""
    order = np.lexsort((fp, probe, bucket))
    bucket, fp, probe = bucket[order], fp[order], probe[order]
    nodes, at = np.unique(fp, return_inverse=True)
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.repeat(np.concatenate([edge[1:], [len(bucket)]]), np.diff(np.concatenate([edge, [len(bucket)]])))
    left = np.flatnonzero(~probe)
    label = np.arange(len(nodes))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    step = 1
    while len(left):
        left = left[left + step < ends[left]]
        right = left + step
        near = np.bitwise_count(fp[left] ^ fp[right]) <= bits
        a, b = label[at[left[near]]], label[at[right[near]]]
        new = a != b
        if new.any():
            found.append((a[new], b[new]))
            held += int(new.sum())
            if held > 200_000:
                label = _labels(np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]), len(nodes))[label]
                found, held = [], 0
        step += 1
    if found:
        label = _labels(np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]), len(nodes))[label]
    member = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[member], nodes[label[member]]


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that span every class of linked ones."""
    n, together = bit_counts(fps)
    draw = F.pmod(F.xxhash64(F.lit("bits"), "fp"), F.lit(1_000_000)) < int(min(1.0, SAMPLE / max(n, 1)) * 1_000_000 + 1)
    sample = np.array(sorted(r.fp for r in fps.filter(draw).select("fp").collect()), np.int64).view(np.uint64)
    _, parts = plan(n, together, sample, bits)
    masks = [np.array([sum(1 << k for k in c) for t in range(limit + 1) for c in itertools.combinations(range(len(own)), t)], np.uint64) for own, limit in parts]

    def probe(batches):
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for start in range(0, len(every), 2_000):
                fp = every[start : start + 2_000]
                for k, ((own, _), flips) in enumerate(zip(parts, masks, strict=True)):
                    values = (value_of(fp, own)[:, None] ^ flips[None, :]).ravel()
                    is_probe = np.tile(flips != 0, len(fp))
                    bucket = values.view(np.int64) * 8 + k if max(map(len, (o for o, _ in parts))) < 60 else values.view(np.int64) ^ k
                    yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.repeat(fp, len(flips)).view(np.int64)), pa.array(is_probe)], names=["bucket", "fp", "probe"])

    rows = fps.select("fp").mapInArrow(probe, "bucket bigint, fp bigint, probe boolean")
    # Only buckets with two members or more matter, and large ones are dealt by pairs of shares of their members.
    large = rows.groupBy("bucket").count().filter(F.col("count") > BUCKET)
    large = cut(large.withColumn("shares", F.ceil(F.col("count") / BUCKET).cast("int")).drop("count"))
    if large.limit(1).count():
        # There are at most rows / BUCKET of them, and a broadcast leaves the rows of a large bucket where they are.
        rows = rows.join(F.broadcast(large), "bucket", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
        own = F.pmod(F.xxhash64("fp"), F.col("shares")).cast("int")
        rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        rows = rows.withColumn("cell", F.least("own", "other") * F.col("shares") + F.greatest("own", "other"))
    else:
        rows = rows.withColumn("cell", F.lit(0))
    probed = n * sum(len(m) for m in masks)
    tasks = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-probed // 1_000_000))

    def compare(batches):
        parts_ = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy()) for b in batches]
        if not parts_:
            return
        bucket, fp, is_probe, cell = (np.concatenate([p[i] for p in parts_]) for i in range(4))
        _, key = np.unique(np.stack([bucket, cell.astype(np.int64)]), axis=1, return_inverse=True) if cell.any() else (None, bucket)
        a, b = stars(np.ravel(key), fp.view(np.uint64), is_probe, bits)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return rows.select("bucket", "fp", "probe", "cell").repartition(tasks, "bucket", "cell").mapInArrow(compare, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """node and root (its class's least node) of every node of the edges, by alternating large and small stars."""
    edges = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = lambda e: tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = cut(small.select("e.a", "e.b").filter("a <> b").distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def classes(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, fp (signed) and component_id of every row."""
    rows = stored(fingerprints(docs))
    return with_classes(rows, labels_of(rows, bits))


def labels_of(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """fp, copies, root (its class's least fingerprint, as the links count) and component_id of every fingerprint."""
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")))
    roots = components(links(fps, bits))
    linked = fps.join(roots, fps.fp == roots.node).select("fp", "root", "least")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "root").select(F.col("fp").alias("fp_"), "root", "component_id")
    # A null component_id of a linked class means that no row of it has an id, and then ``least`` is null as well.
    return fps.join(linked, fps.fp == linked.fp_, "left").select("fp", "copies", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id"))


def with_classes(rows: DataFrame, by_fp: DataFrame, share: int = HOT_SHARE) -> DataFrame:
    """doc_id, fp and component_id of every row, where ``by_fp`` gives copies and component_id of each fingerprint.

    Fingerprints of over 1 / ``share`` of all rows number fewer than ``share``, so they are broadcast;
    only rows of the other fingerprints are brought together by a shuffle.
    """
    by_fp = cut(by_fp)
    total = by_fp.agg(F.sum("copies")).first()[0] or 0
    is_hot = F.col("copies") * share > F.lit(total)
    hot = F.broadcast(by_fp.filter(is_hot).select("fp", "component_id"))
    rare = by_fp.filter(~is_hot).select("fp", "component_id")
    common = rows.join(hot, "fp").select("doc_id", "fp", "component_id")
    others = rows.join(hot, "fp", "left_anti").join(rare, "fp").select("doc_id", "fp", "component_id")
    return common.unionByName(others)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, fingerprint (16 hex digits) and component_id of every row."""
    return classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def with_fingerprints(docs: DataFrame, name: str) -> DataFrame:
    """The rows, with all their columns, and their fingerprints (signed) as another."""

    def run(batches):
        for batch in batches:
            text = pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index("text"))], names=["text"])
            fps = [fingerprints_of(t).view(np.int64) for _, t in text_chunks([text], 1_000_000)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0, np.int64), *fps]))], names=[*batch.schema.names, name])
        give_back()

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def representatives(docs: DataFrame) -> DataFrame:
    """One row, with all its columns, of each class: the row with the least doc_id, the first by its content if several have it.

    A class whose rows all have a null doc_id keeps one of them.
    """
    rows = stored(fingerprints(docs))
    by_fp = cut(labels_of(rows))
    own = with_classes(rows, by_fp).select(F.col("doc_id").alias("id_"), "component_id")
    keep = own.filter(F.col("id_") == F.col("component_id")).select("id_").distinct()
    number = F.col("doc_id").cast("bigint")
    chosen = docs.join(keep, number == F.col("id_"), "left_semi")
    repeated = cut(rows.groupBy(F.col("doc_id").alias("again_")).count().filter("count > 1 or again_ is null").select("again_"))
    if not repeated.limit(1).count():
        return chosen
    # Rows without an id of their own are told apart by their class: one id may be the least of several classes.
    others = docs.join(repeated, number == F.col("again_"), "left_semi").unionByName(docs.filter(number.isNull()))
    classed = by_fp.select(F.col("fp").alias("fp_of_row_"), F.col("root").alias("class_of_row_"), F.col("component_id").alias("least_of_class_"))
    others = with_fingerprints(others, "fp_of_row_").join(classed, "fp_of_row_").filter(number.eqNullSafe(F.col("least_of_class_")))
    rank = F.row_number().over(Window.partitionBy("class_of_row_").orderBy(F.xxhash64("text"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]))
    several = others.withColumn("rank_in_class_", rank).filter("rank_in_class_ = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
    return chosen.join(repeated, number == F.col("again_"), "left_anti").unionByName(several)
