"""Clusters, probes, generations and the older rule against the sequential rules, over whole tables."""

import pandas as pd
import pytest

from gristmill.operators import near_dup
from gristmill.plans import corpus, registry

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def signed():
    d = pd.read_parquet(f"{SF}/documents.parquet").dropna(subset=["doc_id"]).sort_values("doc_id")
    return [(int(i), s) for i, t in zip(d.doc_id, d.text, strict=True) if (s := near_dup.lanes(t))]


def sequential(signed):
    owner, anchor, out = {}, {}, {}
    for doc, sig in signed:
        bands = [(b, tuple(sig[4 * b : 4 * b + 4])) for b in range(28)]
        near = [owner[k] for k in bands if k in owner and sum(x == y for x, y in zip(sig, anchor[owner[k]], strict=True)) / 112 >= 0.8]
        out[doc] = near[0] if near else doc
        if not near:
            anchor[doc] = sig
            for k in bands:
                owner.setdefault(k, doc)
    return out, owner, anchor


def test_clusters_equal_sequential_rule(spark, signed):
    got = registry.near_duplicates(spark, SF).collect()
    want, *_ = sequential(signed)
    assert {r.doc_id: r.cluster for r in got} == want and all(r.is_duplicate == (r.cluster != r.doc_id) for r in got)
    assert len(set(want.values())) < len(want)


def test_generations_never_meet(spark, signed):
    want = {}
    for g in (0, 1):
        want |= sequential([(i, s) for i, s in signed if i % 2 == g])[0]
    assert {r.doc_id: r.cluster for r in corpus.generations(spark, SF).collect()} == want


def test_older_rule(spark, signed):
    seen, want = set(), {}
    for doc, sig in signed:
        bands = {(b, tuple(sig[4 * b : 4 * b + 4])) for b in range(28)}
        want[doc] = bands <= seen
        seen |= bands
    assert {r.doc_id: r.is_duplicate for r in corpus.QUERIES["near_dup_older_rule"](spark, SF).collect()} == want and any(want.values())


def test_probe_changes_nothing(spark, signed):
    _, owner, anchor = sequential(signed)
    d = pd.read_parquet(f"{SF}/documents.parquet").dropna(subset=["doc_id"])
    want = {}
    for i, t in zip(d.doc_id, d.text, strict=True):
        if i % 2 == 0 and (sig := near_dup.lanes((t or "") + " coda")):
            keys = [(b, tuple(sig[4 * b : 4 * b + 4])) for b in range(28)]
            want[int(i)] = next((owner[k] for k in keys if k in owner and sum(x == y for x, y in zip(sig, anchor[owner[k]], strict=True)) / 112 >= 0.8), None)
    assert {r.doc_id: r.cluster for r in corpus.probes(spark, SF).collect()} == want


def test_band_rows_carry_no_signature(spark):
    """28 rows a document, each with its signature, filled the disks; odd and repeated texts keep their clusters."""
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, ""), (4, None), (5, "z"), (6, "Z")], "doc_id bigint, text string")
    sigs = near_dup.signed(docs)
    assert near_dup.band_rows(sigs).columns == ["doc_id", "d1", "d2", "band", "key"]
    got = near_dup.clusters(docs, sigs=sigs)
    assert {r.doc_id: r.cluster for r in got.collect()} == {1: 1, 2: 1, 5: 5, 6: 5}
    asked = spark.createDataFrame([(1, "A b c d e f g"), (1, "other words"), (9, "z"), (10, "q")], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.cluster) for r in near_dup.probe(asked, docs, got, sigs=sigs).filter("is_duplicate").collect()) == [(1, 1), (1, 1), (9, 5)]
