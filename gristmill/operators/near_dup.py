"""Near duplicates in arrival order: MinHash signatures, banded buckets owned by their first claimant, greedy anchors."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from gristmill.sources.tables import dropped, shuffles_dropped, stored

BANDS, ROWS = 28, 4
SIMILAR = 0.80


SHINGLE = 5
_WORD = re.compile(r"\w+")
_DRAW = np.random.default_rng(0xC0FFEE)
_FACTORS = _DRAW.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_TERMS = _DRAW.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def lanes(text: str | None) -> list[int] | None:
    """The least value of each multiply-add hash over the five-word shingles; none for a text without words."""
    w = _WORD.findall((text or "").lower())
    if not w:
        return None
    own = {" ".join(w[i : i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))}
    h = np.array([xxhash.xxh64_intdigest(s) for s in own], np.uint64)
    low = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for a in range(0, len(h), 4096):
            low = np.minimum(low, ((h[a : a + 4096, None] * _FACTORS + _TERMS) >> np.uint64(1)).min(0))
    return low.astype(np.int64).tolist()


# Native higher-order functions would work out the shingles anew for each lane.
@F.pandas_udf(ArrayType(LongType()))
def signature(texts: pd.Series) -> pd.Series:
    return pd.Series([lanes(t) for t in texts])


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", generation: str | None = None) -> DataFrame:
    """doc_id, gen (whose signatures never meet another generation's) and sig of the texts that have a word."""
    gen = F.col(generation).cast("string") if generation else F.lit("")
    return docs.select(F.col(key).alias("doc_id"), F.coalesce(gen, F.lit("")).alias("gen"), signature(F.col(text)).alias("sig")).filter("sig is not null")


def similarity(a, b):
    """Share of equal lanes; zero for signatures of different lengths."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(F.size(a) == F.size(b), same / F.size(a)).otherwise(0.0)


def signed(docs: DataFrame, key: str = "doc_id", text: str = "text", generation: str | None = None) -> DataFrame:
    """Stored signatures: doc_id, gen, sig, 128 bits (d1, d2) by which equal signatures of a generation are known, and the keys of the bands.

    Only these short forms meet in exchanges; a signature is read again where two are compared.
    """
    own = signatures(docs, key, text, generation)
    return stored(own.withColumns({"d1": F.xxhash64("gen", "sig"), "d2": F.xxhash64(F.lit("copy"), "gen", "sig"), "keys": band_keys()}))


def probe(asked: DataFrame, docs: DataFrame, clustered: DataFrame, key: str = "doc_id", text: str = "text", sigs: DataFrame | None = None) -> DataFrame:
    """doc_id, cluster and is_duplicate of texts that are only looked up: the anchors of ``clustered`` stay as they are.

    A bucket belongs to the least anchor that has it; of similar owners the one of the first band counts. No owner: cluster is null.
    ``sigs`` are the stored signatures of ``docs``, if they are there already.
    """
    sigs = signed(docs, key, text) if sigs is None else sigs
    anchors = clustered.filter(~F.col("is_duplicate")).select("doc_id")
    own = signed(asked, key, text)
    with shuffles_dropped(sigs.sparkSession):
        owners = band_rows(sigs.select("doc_id", "d1", "d2", "keys").join(anchors, "doc_id", "left_semi")).groupBy("band", "key").agg(F.min(F.struct("doc_id", "d1", "d2")).alias("owner"))
        # The owners that a text meets, each once, with the first band; then their signatures.
        met = stored(band_rows(own).join(owners, ["band", "key"]).groupBy("doc_id", "d1", "d2", "owner").agg(F.min("band").alias("band")))
    theirs = sigs.select(F.struct("doc_id", "d1", "d2").alias("owner"), F.col("sig").alias("sig_"))
    met = met.join(own.select("doc_id", "d1", "d2", "sig"), ["doc_id", "d1", "d2"]).join(theirs, "owner").filter(similarity(F.col("sig"), F.col("sig_")) >= SIMILAR)
    best = met.groupBy("doc_id").agg(F.min(F.struct("band", F.col("owner.doc_id").alias("cluster"))).alias("best"))
    return own.select("doc_id").join(best, "doc_id", "left").select("doc_id", F.col("best.cluster").alias("cluster"), F.col("best").isNotNull().alias("is_duplicate"))


def band_keys():
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(F.col("gen"), b, F.slice(F.col("sig"), b * ROWS + 1, ROWS)))


def band_rows(sigs: DataFrame) -> DataFrame:
    return sigs.select("doc_id", *(c for c in ("d1", "d2") if c in sigs.columns), F.posexplode("keys").alias("band", "key"))


def parts(bands: DataFrame) -> DataFrame:
    """doc_id and part: documents that share buckets, directly or through others, have one part (least id)."""
    own = bands.select("doc_id", "band", "key")
    # Counted with partial sums first, so that no task holds the rows of a bucket that much of the corpus shares.
    own = stored(own.join(own.groupBy("band", "key").count().filter("count > 1").drop("count"), ["band", "key"], "left_semi"))
    label = stored(own.select("doc_id").distinct().withColumn("part", F.col("doc_id")))
    while True:  # labels only fall, so they come to rest
        # The least label of a document's buckets, and the label of the document it names: paths halve, so long chains take few rounds.
        bucket = own.join(label, "doc_id").groupBy("band", "key").agg(F.min("part").alias("low"))
        step = stored(own.join(bucket, ["band", "key"]).groupBy("doc_id").agg(F.min("low").alias("part")))
        onward = step.select(F.col("doc_id").alias("part"), F.col("part").alias("next"))
        after = stored(step.join(onward, "part").select("doc_id", F.least("part", "next").alias("part")))
        moved = after.alias("s").join(label.alias("l"), "doc_id").filter("s.part <> l.part").limit(1).count()
        dropped(step)
        dropped(label)
        label = after
        if not moved:
            dropped(own)
            return label


def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
    """The order-dependent clustering of one part, whose buckets no other part touches."""
    owner: dict[tuple[int, int], int] = {}
    anchor: dict[int, tuple] = {}
    out = []
    for doc, sig in zip(pdf.doc_id, pdf.sig, strict=True):
        keys = [(b, tuple(sig[b * ROWS : (b + 1) * ROWS])) for b in range(BANDS)]
        near = next((c for c in dict.fromkeys(owner[k] for k in keys if k in owner) if sum(x == y for x, y in zip(sig, anchor[c], strict=True)) >= SIMILAR * len(sig)), None)
        if near is None:
            anchor[doc] = tuple(sig)
            for k in keys:
                owner.setdefault(k, doc)
        out.append((doc, doc if near is None else near, near is not None))
    return pd.DataFrame(out, columns=["doc_id", "cluster", "is_duplicate"])


def owned_everywhere(docs: DataFrame, key: str = "doc_id", text: str = "text", generation: str | None = None) -> DataFrame:
    """doc_id and is_duplicate by the older rule: all of a document's bands were seen before, in whatever documents; in order of id."""
    rows = band_rows(signatures(docs, key, text, generation).withColumn("keys", band_keys())).select("doc_id", "band", "key")
    first = rows.groupBy("band", "key").agg(F.min("doc_id").alias("first"))
    seen = rows.join(first, ["band", "key"]).groupBy("doc_id").agg(F.count_if(F.col("first") < F.col("doc_id")).alias("n"))
    return seen.select("doc_id", (F.col("n") == BANDS).alias("is_duplicate"))


def clusters(docs: DataFrame, key: str = "doc_id", text: str = "text", generation: str | None = None, sigs: DataFrame | None = None) -> DataFrame:
    """doc_id, cluster (its anchor's id) and is_duplicate; documents arrive in order of id, each generation on its own.

    Documents without any shared bucket are their own anchors and never reach the sequential step; exact copies of a
    signature follow their first arrival, so a part holds distinct signatures only. ``sigs`` as in ``probe``.
    """
    sigs = signed(docs, key, text, generation) if sigs is None else sigs
    same = ["gen", "d1", "d2"]
    with shuffles_dropped(sigs.sparkSession):
        firsts = stored(sigs.groupBy(*same).agg(F.min("doc_id").alias("doc_id")))
        part = parts(band_rows(sigs.select("doc_id", *same, "keys").join(firsts, ["doc_id", *same], "left_semi")))
        members = sigs.select("doc_id", *same, "sig").join(firsts.join(part, "doc_id"), ["doc_id", *same])
        done = stored(members.groupBy("part").applyInPandas(lambda p: greedy(p.drop_duplicates(same).sort_values("doc_id")), "doc_id bigint, cluster bigint, is_duplicate boolean"))
    by_sig = firsts.join(done, "doc_id", "left").select(*same, F.coalesce("cluster", "doc_id").alias("cluster"))
    return sigs.select("doc_id", *same).join(by_sig, same).select("doc_id", "cluster", (F.col("doc_id") != F.col("cluster")).alias("is_duplicate"))


def exact_copies(docs: DataFrame) -> DataFrame:
    return docs.groupBy(F.sha2("text", 256).alias("sha")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc")).filter("copies > 1")
