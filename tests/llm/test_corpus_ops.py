"""Packing, search, language model, near duplicates, decontamination and the pipeline against brute force."""

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

from gristmill.llm import decontaminate, mih_search, ngram_automaton, packing, simhash_dedup

SF = "/root/testdata/sf0.001"
_SPACE = " \t\n\r\x0b\x0c"


def words_of(text):
    import re

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def test_token_ids_equal_tokenizer(docs_pdf):
    """Every character below U+0250 alone and in context, random strings of hard parts, and the table's texts."""
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, ids = Tokenizer.from_file(path), packing.TokenIds(path, words=5000)
    every = [chr(c) for c in range(0x250)]
    rng = np.random.default_rng(1)
    parts = ["'", "'s", "'re", "'ll", "'S", "'VE", "'d", "'m", "'t", " ", "\n", "\t", "a", "B", "re", "l", "e", "s", "5", "--", "_", ".", "é", "Ɖ", "ß", "×", "÷", "ª", "²", "Ǆ", "İ", "…", "漢", "<|endoftext|>", "\x00", "\x1c", "\x85", "\xa0"]
    texts = ["Ɖevi Ɛya Ɔ", "Ɗan Ɓauna ya tafi Ƙasar", "it's we'll 'tis 1234 3.14 a<|endoftext|>b", "ΣΣ İx _a_ --%%%!! '' 's", "".join(every), ""]
    texts += every + [f"a{c}b" for c in every] + [f" {c}'s{c}" for c in every] + [f"1{c}{c}'" for c in every]
    texts += ["".join(parts[i] for i in rng.integers(0, len(parts), n)) for n in rng.integers(0, 25, 10_000)]
    texts += docs_pdf.text.fillna("").tolist()
    for a in range(0, len(texts), 700):
        for t, got in zip(texts[a : a + 700], ids.encode(texts[a : a + 700]), strict=True):
            assert np.frombuffer(got, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t


def test_packing(docs, docs_pdf, no_docs):
    got = packing.pack(docs, group_pieces=60).toPandas()
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, t in zip(docs_pdf.doc_id, docs_pdf.text.fillna(""), strict=True):
        ids = np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for p, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            want[(None if pd.isna(i) else int(i), p, a, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((None if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()) == want
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset == g.length.cumsum() - g.length).all() and g.length.sum() <= 2048
    assert got.sequence_id.nunique() <= np.ceil(got.length.sum() / 2048) * 1.03 + 1
    assert packing.pack(no_docs).count() == 0


def test_local_search_empties_bins():
    rng = np.random.default_rng(0)
    for _ in range(20):
        lengths = rng.integers(1, 100, 60).tolist()
        start = [[i] for i in range(60)]
        bins = packing.local_search(start, lengths, 100)
        assert sorted(i for b in bins for i in b) == list(range(60)) and max(sum(lengths[i] for i in b) for b in bins) <= 100
        assert len(bins) <= len(packing.best_fit(lengths, 100)) + 2
        rest = packing.local_search(bins, lengths, 100, None)
        assert sorted(i for b in rest for i in b) == list(range(60)) and len(rest) <= len(bins)


def brute_nearest(pdf, k=10, every=100):
    x = {i: np.array(v, float) for i, v in zip(pdf.vec_id, pdf.embedding, strict=True)}
    out = {}
    for q in sorted(i for i in x if i % every == 0):
        d = sorted((float(np.sqrt(((x[i] - x[q]) ** 2).sum())), i) for i in x if i != q)
        out[q] = d[:k]
    return out


def test_nearest_neighbours(spark):
    big = SF.replace("0.001", "0.1")
    pdf = pd.read_parquet(f"{big}/embeddings.parquet")
    got = mih_search.nearest(spark.read.parquet(f"{big}/embeddings.parquet"), every=20).toPandas()
    want = brute_nearest(pdf, every=20)
    hits = sum(len(set(g.vec_id) & {i for _, i in want[q]}) for q, g in got.groupby("query_id"))
    assert hits / sum(map(len, want.values())) >= 0.9
    x = {i: np.array(v, float) for i, v in zip(pdf.vec_id, pdf.embedding, strict=True)}
    for r in got.itertuples():
        assert abs(r.score - np.linalg.norm(x[r.query_id] - x[r.vec_id])) < 1e-12


def test_odd_vectors(spark):
    rows = [(i, [float(i % 7), 1.0, 2.0], "x") for i in range(40)] + [(100, None, "x"), (101, [0.0, 0.0, 0.0], "x"), (102, [float("nan"), 1.0, 1.0], "x"), (103, [1.0, None, 1.0], "x"), (104, [float("inf"), 1.0, 2.0], "x"), (None, [1.0, 1.0, 1.0], "x"), (105, [1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string")
    got = mih_search.nearest(df, every=20).toPandas().sort_values(["query_id", "rank"])
    assert got.vec_id[got.query_id == 0].tolist() == [7, 14, 21, 28, 35, 1, 8, 15, 22, 29] and set(got.query_id) == {0, 20}
    assert mih_search.nearest(df.limit(0)).count() == 0
    few = mih_search.nearest(df.filter("vec_id < 3")).toPandas()
    assert few.vec_id.tolist() == [1, 2]


def test_repeated_ids_and_equal_vectors(spark):
    """One id with two vectors is searched by the lesser one; equal vectors rank by id; exact repeats count once."""
    rows = [(0, [5.0, 1.0]), (0, [1.0, 1.0]), *[(i, [1.0, 1.0]) for i in range(1, 40)], *[(3, [1.0, 1.0])] * 5, *[(200 + i, [9.0, 9.0 + i]) for i in range(3)], (100, [9.0, 9.0])]
    got = mih_search.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).toPandas().sort_values(["query_id", "rank"])
    assert set(got.query_id) == {0, 100, 200} and got.vec_id[got.query_id == 0].tolist() == list(range(1, 11))
    assert got.vec_id[got.query_id == 100].tolist()[:3] == [200, 201, 202] and got.score[got.query_id == 100].tolist()[:3] == [0, 1, 2]


def probed(codes, words, asked, radius):
    """Pairs that the parts of all substrings give, and the pairs that were looked at."""
    found, looked = [], 0
    for j in range(len(codes.subs)):
        prefix = codes.prefix(codes.value(words, j), j)
        for p in np.unique(prefix).tolist():
            at = np.flatnonzero(prefix == p)
            index = mih_search.PartIndex(codes, j << 40 | p, words[at], at, None)
            for who, pos, _ in index.pairs(asked, radius, np.full(len(asked), -1)):
                found += zip(who.tolist(), index.ids[pos].tolist(), strict=True)
            looked += index.looked
    return found, looked


def test_probes_find_every_code_once():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 40))
    codes = mih_search.Codes(x[:500], np.arange(500), 3_000_000)
    words = codes.encode(x)
    for r in (0, 5, 9, 20, 33, 80):
        radius = np.array([r, r, max(0, r - 1)])
        found, _ = probed(codes, words, words[:3], radius)
        h = np.bitwise_count(words[None] ^ words[:3, None]).sum(2)
        assert sorted(found) == sorted(zip(*(v.tolist() for v in np.nonzero(h <= radius[:, None])), strict=True))


def test_few_codes_are_looked_at_in_clustered_data():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(200, 64))
    x = centres[rng.integers(0, 200, 50_000)] + rng.normal(size=(50_000, 64)) * 0.3
    codes = mih_search.Codes(x[:8192], np.arange(8192), 50_000)
    words, asked = codes.encode(x), np.arange(0, 50_000, 500)
    found, looked = probed(codes, words, words[asked], codes.radius(words[asked], asked))
    near = set(found)
    caught = []
    for i, q in enumerate(asked.tolist()):
        far = ((x - x[q]) ** 2).sum(1)
        far[q] = np.inf
        caught += [(i, j) in near for j in np.argpartition(far, 10)[:10].tolist()]
    assert looked < 0.2 * len(x) * len(asked) and np.mean(caught) >= 0.9


def test_language_model(docs, docs_pdf, no_docs, monkeypatch):
    got = ngram_automaton.score(docs).toPandas()
    c = Counter()
    for i, t in zip(docs_pdf.doc_id, docs_pdf.text.fillna(""), strict=True):
        if not pd.isna(i) and zlib.crc32(str(int(i)).encode()) % 5 != 1:
            c.update([*words_of(t), None])
    n, v = sum(c.values()), len(c)
    want = []
    for i, t in zip(docs_pdf.doc_id, docs_pdf.text.fillna(""), strict=True):
        tokens = [*words_of(t), None]
        want.append((-1 if pd.isna(i) else int(i), len(tokens), sum(c[w] > 0 for w in tokens), sum(np.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)))
    have = sorted(zip(got.doc_id.fillna(-1).astype(int), got.n_tokens, got.n_known, got.base_score, strict=True))
    assert len(have) == len(want) and set(got.train_tokens) == {n}
    for a, b in zip(have, sorted(want), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 * abs(b[3])
    assert got.score.sum() > got.base_score.sum()
    assert ngram_automaton.score(no_docs).count() == 0


def test_automaton_is_normalised_and_equals_backoff():
    counts = np.array([1, 50, 30, 20, 10], float)
    v = 8
    n = counts[1:].sum()
    low = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
    pairs = {1 * 5 + 2: 20, 1 * 5 + 3: 10, 2 * 5 + 1: 12, 3 * 5 + 1: 9}
    triples = {(1 * 5 + 2) * 5 + 1: 8, (2 * 5 + 1) * 5 + 3: 5}
    a = ngram_automaton.BackoffAutomaton(4, low, pairs, triples, counts)
    rest = 1 - sum(10.0 ** low[1:])
    for context in ([], [1], [2], [4], [1, 2], [2, 1], [3, 1], [4, 2]):
        own = [low[w] for w in context]
        before = a.traverse(context, own)
        total = sum(10.0 ** (a.traverse([*context, w], [*own, low[w]]) - before) for w in range(1, 5))
        total += 10.0 ** (a.traverse([*context, 0], [*own, np.log10(rest)]) - before)
        assert abs(total - 1) < 1e-9


def brute_fingerprint(text):
    w = words_of(text)
    if not w:
        return 0
    sh = [" ".join(w)] if len(w) < 4 else [" ".join(w[i : i + 4]) for i in range(len(w) - 3)]
    h = [xxhash.xxh64_intdigest(s.encode("utf-8"), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(ids, fps, bits=4):
    n = len(ids)
    label = list(range(n))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                label[find(i)] = find(j)
    out = {}
    for i in range(n):
        out.setdefault(find(i), []).append(ids[i])
    low = {r: min((x for x in m if x is not None), default=None) for r, m in out.items()}
    return [low[find(i)] for i in range(n)]


def test_simhash(docs, docs_pdf, no_docs):
    got = simhash_dedup.digest(docs).toPandas()
    ids = [None if pd.isna(i) else int(i) for i in docs_pdf.doc_id]
    fps = [brute_fingerprint(t) for t in docs_pdf.text.fillna("")]
    want = Counter((i, f"{f:016x}", c) for i, f, c in zip(ids, fps, brute_classes(ids, fps), strict=True))
    clean = lambda x: None if pd.isna(x) else int(x)
    assert Counter((clean(r.doc_id), r.fingerprint, clean(r.component_id)) for r in got.itertuples()) == want
    assert simhash_dedup.digest(no_docs).count() == 0
    kept = simhash_dedup.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(-1 if x is None else x for x in (r.doc_id for r in kept.select("doc_id").collect())) == sorted({-1 if c[2] is None else c[2] for c in want})


def test_links_of_dense_groups(spark, monkeypatch):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    near = [base]
    for k in range(1, 7):
        y = base[:100].copy()
        for _ in range(k):
            y ^= np.uint64(1) << rng.integers(0, 64, 100, dtype=np.uint64)
        near.append(y)
    near.append(np.array([base[0] ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for i in range(40) for j in range(i)], np.uint64))
    x = np.unique(np.concatenate(near))
    a, b = np.nonzero(np.triu(np.bitwise_count(x[:, None] ^ x[None]) <= 4, 1))
    want = simhash_dedup._labels(a, b, len(x))
    fps = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp bigint")
    for bucket in (20_000, 50):  # the second deals buckets over several tasks
        monkeypatch.setattr(simhash_dedup, "BUCKET", bucket)
        roots = {r.node: r.root for r in simhash_dedup.components(simhash_dedup.links(fps)).collect()}
        label = [roots.get(int(v), int(v)) for v in x.view(np.int64)]
        assert len(set(zip(label, want.tolist(), strict=True))) == len(set(label)) == len(set(want.tolist()))


def test_thresholds_cover_the_distance():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 500, dtype=np.uint64)
    bits = np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    for n in (10, 10_000, 10_000_000):
        _, parts = simhash_dedup.plan(n, (bits.T @ bits) * n / 500, x)
        assert sum(t + 1 for _, t in parts) == 5
        used = [b for own, _ in parts for b in own]
        assert len(used) == len(set(used))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_decontamination(spark, docs, docs_pdf, no_docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    rng = np.random.default_rng(4)
    item = items[max(items, key=lambda i: len(items[i]))].split()
    para = [w if rng.random() > 0.15 else "zzz" + w for w in item]
    clean = docs_pdf.text[1].split()
    planted = spark.createDataFrame([(700001, " ".join([*clean[:50], *item, *clean[50:]])), (700002, " ".join([*clean[:41], *para, *clean[41:]])), (700003, " ".join(clean + item[:6]))], "doc_id bigint, text string")
    both = docs.select("doc_id", "text").unionByName(planted)
    got = decontaminate.leaks(both, bench).toPandas()
    flagged = set(got.doc_id.dropna().astype(int))
    want = {int(r.doc_id) for r in docs_pdf.dropna(subset=["doc_id", "text"]).itertuples() if any(" ".join(t.lower().split()) in " ".join(r.text.lower().split()) for t in items.values())}
    assert want <= flagged and {700001, 700002} <= flagged and 700003 not in flagged
    assert flagged - want - {700001, 700002} == set()
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(docs_pdf) - docs_pdf.doc_id.isin(want).sum()
    assert decontaminate.leaks(no_docs, bench).count() == 0 and decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_common_benchmark_passage_is_found(spark):
    """A passage that most documents hold has frequent words only; it is found all the same, and clean documents stay."""
    leak = "seven brass lanterns hung above the quiet canal while the miller counted his sacks of rye twice over"
    rows = [(i, f"{leak} tail{i}") for i in range(60)] + [(100 + i, f"plain words number {i} about nothing in particular today") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, leak)], "item_id bigint, text string")
    assert sorted(r.doc_id for r in decontaminate.leaks(docs, bench).collect()) == list(range(60))
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == list(range(100, 110))


def test_subsequence_length():
    rng = np.random.default_rng(5)
    idf = np.ones(decontaminate.TERMS, np.float32)
    v = np.zeros((decontaminate.TERMS, decontaminate.RANK), np.float32)
    for _ in range(30):
        a, b = rng.integers(0, 6, 20).tolist(), rng.integers(0, 6, 50).tolist()
        r = decontaminate.Retrieval([], idf, v)
        r.passages, r.answers = [a], [set(a)]
        r.masks = [{t: sum(1 << i for i, x in enumerate(a) if x == t) for t in a}]
        got = r.judge(0, b)
        n = lcs(a, b)
        assert (got is None and n < 0.75 * len(a)) or (got is not None and got[0] == n)


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF).toPandas()
    d = pd.read_parquet(f"{SF}/documents.parquet")
    assert set(out.doc_id) <= set(d.doc_id) and len(out) > 0.7 * len(d)
    texts = d.set_index("doc_id").text
    items = pd.read_parquet(f"{SF}/benchmark.parquet").text
    flat = {i: " ".join(t.split()) for i, t in texts[list(set(out.doc_id))].items()}
    assert not any(" ".join(x.split()) in t for t in flat.values() for x in items)
    ids = [int(i) for i in texts.index]
    fps = [brute_fingerprint(t) for t in texts]
    assert not set(out.doc_id) - set(brute_classes(ids, fps))


def test_latent_space_covers_all_documents(spark):
    """Directions that only one overlong text has are in the space, as the best one has them; the order of rows is of no matter."""
    from gristmill.llm import decontaminate as D

    rng = np.random.default_rng(1)
    topics = [[f"w{t}x{i}" for i in range(30)] for t in range(12)]
    texts = [" ".join(rng.choice(topics[k % 11], 200)) for k in range(60)] + [" ".join(rng.choice(topics[11], 64_000))]
    assert len(texts[-1]) > 262_144
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    items = [" ".join(rng.choice(topics[k], 20)) for k in range(3)]
    df, n = D.frequencies(docs)
    idf = np.ones(D.TERMS, np.float32)
    v = D.latent_spaces(docs, items, [idf], n)[0]
    assert np.allclose(v.T @ v, np.eye(D.RANK), atol=1e-4)
    cols = np.unique(D.Words().of([texts[-1]])[0] % D.TERMS)
    own = np.zeros(D.TERMS)
    own[cols] = 1 / np.sqrt(len(cols))
    assert np.linalg.norm(own @ v) > 0.9
    again = D.latent_spaces(docs.orderBy("text").repartition(3), items, [idf], n)[0]
    assert np.array_equal(v, again)


def test_gram_product_against_dense_matrices():
    """A'(AX) of both weightings equals that of dense matrices, and sums are the same whatever the chunks and their order."""
    from gristmill.llm import decontaminate as D

    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.3, n) % 5000) for n in (1, 40, 64, 65, 500, 0, 900)] + ["solo solo solo"]
    idfs = [np.where(rng.random(D.TERMS) < 0.3, 0, rng.uniform(0.5, 12, D.TERMS)).astype(np.float32)]
    idfs.append(np.where(rng.random(D.TERMS) < 0.1, 4, idfs[0]).astype(np.float32))
    x = D._start()
    weighed, got = D._weighed(idfs, x), np.zeros((D.TERMS, 2 * x.shape[1]))
    D._gram_product(*D.Words().of(texts), idfs, weighed, got)
    again = np.zeros(got.shape)
    for t in texts[::-1]:
        D._gram_product(*D.Words().of([t]), idfs, weighed, again)
    assert np.array_equal(got, again)
    for k, idf in enumerate(idfs):
        rows = []
        for t in texts:
            ids = D.Words().of([t])[0] % D.TERMS
            rows += [np.bincount(np.unique(ids[a : a + 64]), minlength=D.TERMS) * idf for a in range(0, len(ids), 64)]
        a = np.array([r / max(np.linalg.norm(r), 1e-9) for r in rows])
        want = a.T @ (a @ x)
        own = idf[:, None] * got[:, k * x.shape[1] : (k + 1) * x.shape[1]] / D.UNITS
        assert np.linalg.norm(own - want) < 1e-3 * np.linalg.norm(want)


def test_gram_product_costs_no_more_than_a_few_times_the_hashing():
    """All dimensions of both weightings are added a row at a time: by one after another it took about 18 times the hashing of the words, for each weighting."""
    import time

    from gristmill.llm import decontaminate as D

    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 20_000, 500)) for _ in range(300)]
    idfs = [np.full(D.TERMS, 5, np.float32), np.full(D.TERMS, 6, np.float32)]
    weighed, into = D._weighed(idfs, D._start()), np.zeros((D.TERMS, 2 * (D.RANK + D.MORE)))
    words, hashing, adding = D.Words(), [], []
    for _ in range(4):
        a = time.thread_time()
        own = words.of(texts)
        b = time.thread_time()
        D._gram_product(*own, idfs, weighed, into)
        hashing.append(b - a)
        adding.append(time.thread_time() - b)
    assert min(adding) < 15 * min(hashing)
