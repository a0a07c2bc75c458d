"""Learned models: held-out accuracy and defined results for odd rows."""

import time
import zlib

import numpy as np
import pandas as pd

from gristmill.llm import lang_id, quality_cnn, toxicity_crf
from gristmill.llm.common import WordTable, lockstep

SF = "/root/testdata/sf0.01"


def crc(x, mod):
    return zlib.crc32(str(x).encode()) % mod


def test_quality(spark, docs, labels, docs_pdf, no_docs, no_labels):
    got = quality_cnn.score(docs, labels, per_class=60).toPandas()
    assert len(got) == len(docs_pdf) and got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    own = got[got.doc_id.notna()]
    assert (own.held_out == own.doc_id.map(lambda x: crc(int(x), 3) == 1)).all() and not got[got.doc_id.isna()].held_out.any()
    assert quality_cnn.score(no_docs, labels, per_class=5).count() == 0
    assert (quality_cnn.score(docs, no_labels).toPandas().score == 0.5).all()


def test_quality_held_out():
    d = pd.read_parquet(f"{SF}/documents.parquet").merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    rest = d.doc_id.map(lambda x: crc(x, 3))
    train, test = d[rest != 1], d[rest == 1]
    net = quality_cnn.ByteCNN().fit(list(zip(train.text, train.quality, strict=True)), train.quality.mean())
    p = net.score(test.text.tolist()) >= 0.5
    assert (p == (test.quality == 1)).mean() > 0.9
    long = "".join(test.text)[:200_000]
    rows, steps, counts = quality_cnn.rows_of([long])
    assert counts[0] * 512 >= len(long.encode()) and len(rows) == len(steps) == counts[0]


def test_gradient_is_right():
    net = quality_cnn.ByteCNN(seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts, y, w = ["hello world " * 60, "abc", "x!" * 700], np.array([1.0, 0, 1]), np.ones(3)

    def loss():
        z = net.logits(texts).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    grad = net.gradient(texts, y, w)
    for name in ("w3", "w2", "b1", "w1"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        old = net.p[name][at]
        net.p[name][at] = old + 1e-3
        up = loss()
        net.p[name][at] = old - 1e-3
        down = loss()
        net.p[name][at] = old
        assert abs((up - down) / 2e-3 - grad[name][at]) < 0.05 * abs(grad[name][at]) + 1e-3


def test_language(docs, docs_pdf, no_docs):
    got = lang_id.identify(docs).toPandas()
    assert len(got) == len(docs_pdf) and got.score.between(0, 1).all()
    by_id = got.set_index("doc_id").lang_pred
    for i in (900001, 900002, 900003, 900004):
        assert by_id[i] == "und"
    truth = docs_pdf.drop_duplicates("doc_id").set_index("doc_id").lang
    own = got[got.held_out & (got.doc_id < 900000)]
    assert (own.lang_pred.values == truth[own.doc_id].values).mean() > 0.9
    assert lang_id.identify(no_docs).count() == 0
    kept = lang_id.recognised(docs)
    assert kept.columns == docs.columns and kept.count() == (got.lang_pred != "und").sum()


def brute_viterbi(scores, prior, switch):
    best = [(prior[k] + scores[0][k], [k]) for k in range(len(prior))]
    for s in scores[1:]:
        best = [max(((best[j][0] - (switch if j != k else 0) + s[k], [*best[j][1], k]) for j in range(len(s))), key=lambda x: x[0]) for k in range(len(s))]
    return max(b[0] for b in best)


def test_viterbi_is_best_path():
    rng = np.random.default_rng(0)
    model = lang_id.LanguageModel([], {})
    model.langs, model.prior = ["a", "b", "c"], np.log([0.5, 0.3, 0.2])
    lengths = np.array([7, 0, 1, 12])
    scores = rng.normal(0, 6, (20, 3)).astype(np.float32)
    path = model.paths(scores, lengths)
    at = 0
    for n in lengths:
        own, p = scores[at : at + n].astype(float), path[at : at + n]
        at += n
        if n:
            value = model.prior[p[0]] + own[range(n), p].sum() - lang_id.SWITCH * (p[1:] != p[:-1]).sum()
            assert abs(value - brute_viterbi(own, model.prior, lang_id.SWITCH)) < 1e-4


def test_mixed_language_spans():
    d = pd.read_parquet(f"{SF}/documents.parquet")
    model = lang_id.LanguageModel(list(zip(d.text, d.lang, strict=True)), {"en": 0.25, "de": 0.25, "fr": 0.25, "es": 0.25})
    who = lang_id.Identifier(model)
    a, b = d[d.lang == "de"].text.iloc[0][:300], d[d.lang == "fr"].text.iloc[0][:300]
    spans = who.spans(a + " " + b)
    assert [x for *_, x in spans] == ["de", "fr"] and abs(spans[1][0] - 301) < 30
    assert lang_id.script_of("я") == "Cyrillic" and lang_id.script_of("漢") == "Han" and lang_id.script_of("é") == "Latin"


def brute_marginals(u, a):
    n = len(u)
    weight = np.zeros((n, 2))
    for m in range(1 << n):
        s = [m >> i & 1 for i in range(n)]
        w = np.exp(sum(u[i] for i in range(n) if s[i]) + sum(a[s[i], s[i + 1]] for i in range(n - 1)))
        for i in range(n):
            weight[i, s[i]] += w
    return np.log(weight[:, 1] / weight[:, 0])


def test_forward_backward():
    rng = np.random.default_rng(1)
    a, lengths = rng.normal(size=(2, 2)), np.array([5, 0, 8, 1])
    u = rng.normal(0, 2, 14)
    logit = toxicity_crf.marginal_logits(u, lengths, a)[2]
    at = 0
    for n in lengths:
        if n:
            assert np.allclose(logit[at : at + n], brute_marginals(u[at : at + n], a))
        at += n


def test_toxicity(docs, labels, docs_pdf, no_docs, no_labels):
    got = toxicity_crf.score(docs, labels, spans=True).toPandas()
    assert len(got) == len(docs_pdf) and got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert toxicity_crf.score(no_docs, labels).count() == 0
    assert (toxicity_crf.score(docs, no_labels).toPandas().score == 0).all()


def test_toxicity_held_out():
    d = pd.read_parquet(f"{SF}/documents.parquet").merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    rest = d.doc_id.map(lambda x: crc(x, 5))
    train, test = d[rest != 0], d[rest == 0]
    tagger = toxicity_crf.Tagger(toxicity_crf.ToxicField().fit(list(zip(train.text, train.toxic, strict=True)), train.toxic.mean()))
    s, lengths, logit = tagger.tag(test.text.tolist())
    assert ((s >= 0.5) == (test.toxic == 1)).mean() > 0.93
    (spans,) = tagger.spans(["Erste idiot moron the"], *tagger.tag(["Erste idiot moron the"])[1:])
    assert spans == [{"start": 6, "end": 17}]


def test_lockstep_and_word_table():
    order, active = lockstep(np.array([2, 0, 3]))
    assert order.tolist() == [2, 0, 1] and active.tolist() == [2, 2, 1]
    table = WordTable(lambda ws: np.array([len(w) for w in ws]), words=3)
    for tokens in (["a", "bb", "a"], ["ccc", "dddd"], ["bb", "eeeee"]):
        at = table.look_up(tokens)
        assert table.rows[at].tolist() == [len(t) for t in tokens]

def test_long_documents_alone(monkeypatch):
    """The few longest documents are gone through one by one, with the same results as side by side."""
    from gristmill.llm import common

    rng = np.random.default_rng(6)
    a, lengths = rng.normal(size=(2, 2)), np.array([700, 3, 0, 400, 90, 1, 800])
    u, scores = rng.normal(0, 2, lengths.sum()), rng.normal(0, 6, (lengths.sum(), 3)).astype(np.float32)
    model = lang_id.LanguageModel([], {})
    model.langs, model.prior = ["a", "b", "c"], np.log([0.5, 0.3, 0.2])
    got = [*toxicity_crf.marginal_logits(u, lengths, a), model.paths(scores, lengths)]
    monkeypatch.setattr(common, "FEW", 0)
    for x, y in zip(got, [*toxicity_crf.marginal_logits(u, lengths, a), model.paths(scores, lengths)], strict=True):
        assert np.allclose(x, y)


def test_one_long_text_takes_no_longer():
    began = time.time()
    words = np.random.default_rng(0).normal(0, 2, 400_000)
    toxicity_crf.marginal_logits(words, np.array([400_000]), np.zeros((2, 2)))
    model = lang_id.LanguageModel([], {})
    model.langs, model.prior = ["a", "b"], np.log([0.5, 0.5])
    model.paths(words.reshape(-1, 2).astype(np.float32), np.array([200_000]))
    assert time.time() - began < 6


def plain_network(net, text):
    """The network read plainly: every window of every chunk of the bytes in turn."""
    p = {k: v.astype(float) for k, v in net.p.items()}
    raw = list(text.encode())
    n = max(1, -(-len(raw) // 512))
    byte = lambda i: p["emb"][raw[i] if i < len(raw) else 0]
    w = np.concatenate([p["w1"][:, :24], p["w1"][:, 24:]])
    hidden = []
    for c in range(max(1, n - 1)):
        top = np.zeros(24)
        for step in range(c * 128, (c + (2 if n > 1 else 1)) * 128):
            if step * 4 < len(raw):
                top = np.maximum(top, np.concatenate([byte(step * 4 + i) for i in range(8)]) @ w + p["b1"])
        hidden.append(np.maximum(top @ p["w2"] + p["b2"], 0))
    return float(np.concatenate([np.max(hidden, 0), np.mean(hidden, 0)]) @ p["w3"] + p["b3"][0])


def test_network_equals_plain_reading():
    net = quality_cnn.ByteCNN(seed=3)
    texts = ["", "a", "hello world " * 50, "Ünïcode \\u6f22\\u5b57 " * 90, "x" * 512, "yz" * 700]
    assert np.allclose(net.logits(texts), [plain_network(net, t) for t in texts], atol=1e-4)
