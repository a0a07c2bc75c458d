"""Whole jobs: rules that hold for every row, word and n-gram, against literal rows and brute force."""

import zlib
from collections import Counter

import numpy as np
import pandas as pd

from gristmill.llm import decontaminate, ngram_automaton, pii_skipchain, simhash_dedup


def test_language_model_has_every_ngram(docs, docs_pdf):
    """Scores equal those of one automaton with all bigrams and trigrams, singletons and rare words included."""
    texts = [[*("" if pd.isna(t) else t).encode().lower().split(), b""] for t in docs_pdf.text]
    learn = [not pd.isna(i) and zlib.crc32(str(int(i)).encode()) % 5 != 1 for i in docs_pdf.doc_id]
    c = [Counter(tuple(t[i : i + n]) for t, on in zip(texts, learn, strict=True) if on for i in range(len(t) - n + 1)) for n in (1, 2, 3)]
    number = {w: k for k, (w,) in enumerate(sorted(c[0]), 1)}
    base, total = len(number) + 1, sum(c[0].values())
    counts = np.array([0, *(c[0][w,] for w in number)], float)
    low = np.log10((counts + 0.5) / (total + 0.5 * (len(number) + 1)))
    pairs = {number[a] * base + number[b]: x for (a, b), x in c[1].items()}
    triples = {(number[a] * base + number[b]) * base + number[d]: x for (a, b, d), x in c[2].items()}
    model = ngram_automaton.BackoffAutomaton(len(number), low, pairs, triples, counts)
    codes = [[number.get(w, 0) for w in t] for t in texts]
    want = sorted((len(t), model.traverse(t, low[t].tolist())) for t in codes)
    have = sorted(zip(*(ngram_automaton.score(docs).toPandas()[k] for k in ("n_tokens", "score")), strict=True))
    assert [a for a, _ in have] == [a for a, _ in want]
    assert np.allclose([b for _, b in have], [b for _, b in want], rtol=1e-6)


def test_representatives_of_rows_without_own_id(spark):
    """Each class keeps one row, also if ids are null or shared between classes; one with an id goes first."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 60)) for _ in range(30)]
    rows = [(None, t) for t in texts[:20]] + [(None, t) for t in texts[:5]] + [(3, texts[0])] + [(7, t) for t in texts[20:]] + [(8, texts[20])]
    got = [tuple(r) for r in simhash_dedup.representatives(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    want = {(3, texts[0])} | {(None, t) for t in texts[1:20]} | {(7, t) for t in texts[20:]}
    assert len(got) == len(want) and set(got) == want


def test_skip_chain_judges_every_document():
    """Two equal words that no base pattern knows are judged alike, whatever stands elsewhere."""
    field = pii_skipchain.SkipChain()
    field.w[0, 4], field.skip[4, 4] = 1.0, 3.0
    text = "call 5550100200 today, or else 5550100200 please"
    for more in ("", " and mail a@b.org", " and mail a@b.org then A@b.org, or a@c"):
        base, every = field.spans(text + more)
        assert not base["phone"] and [s for s in every["phone"] if s[1] <= len(text)] == [(5, 15), (31, 41)]


def test_benchmark_passage_with_one_weighted_word(spark):
    """Copies of a passage of common words and one rare one are found in longer texts, also if the rare word is altered."""
    rng = np.random.default_rng(3)
    pool = [f"common{i}" for i in range(60)]
    some = lambda k: [pool[i] for i in rng.permutation(60)[:k]]
    item = [*some(35), "seldom"]
    odd = lambda i, k: [f"odd{i}x{j}" for j in range(k)]
    rows = [(i, " ".join(some(50))) for i in range(300)]
    rows += [(1000 + i, " ".join([*odd(i, 12 + i % 5), *item[: 35 if i % 2 else 36], *odd(-i, 14)])) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    assert sorted(r.doc_id for r in decontaminate.leaks(docs, bench).collect()) == [1000 + i for i in range(12)]


def test_pipeline_on_odd_rows(spark, docs, docs_pdf, no_docs, tmp_path):
    """Null, empty, blank, repeated and long texts, null ids and clashing columns; the last stage packs what the others keep."""
    import corpus_pipeline

    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    for name, table in (("odd", docs), ("none", no_docs)):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        bench.write.parquet(str(tmp_path / name / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    own = spark.read.parquet(str(tmp_path / "odd" / "documents.parquet"))
    kept = own
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.count()
        kept = stage(spark, kept, str(tmp_path / "odd")).checkpoint()
        assert kept.columns == own.columns and kept.count() <= before, name
    got = corpus_pipeline.run(spark, str(tmp_path / "odd")).toPandas()
    number = lambda ids: sorted(-1 if pd.isna(i) else int(i) for i in ids)
    assert number(got.doc_id[got.piece == 0]) == number(r.doc_id for r in kept.select("doc_id").collect())
    ids = set(number(got.doc_id))
    assert not ids & {900001, 900002, 900003, 900004} and {-1, 900006, 900007} <= ids
    assert (got.doc_id[got.piece == 0] == 900005).sum() <= 1
